"""Quality rules against a plain definition."""

import math
import re

import xxhash
from conftest_llm import ODD

from llm import quality

SEED = 42


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _n_grams(words, buckets):
    hashes = [xxhash.xxh64_intdigest(w.encode(), SEED) for w in words]
    pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), SEED))
             for a, b in zip(hashes, hashes[1:])]
    return [_signed(h) % buckets for h in hashes + pairs]


def _plain(docs, trusted, buckets=quality.BUCKETS):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in docs]
    grams = [_n_grams(w, buckets) for w in words]
    raw, good = [1] * buckets, [1] * buckets
    for (doc_id, _), own in zip(docs, grams):
        for b in own:
            raw[b] += 1
            good[b] += doc_id in trusted
    if sum(good) == buckets:
        good = [r / sum(raw) * sum(good) for r in raw]
    out = []
    for (doc_id, text), w, own in zip(docs, words, grams):
        seen, covered = {}, set()
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i:i + 8]), []).append(i)
        for places in seen.values():
            if len(places) > 1:
                covered.update(i + k for i in places for k in range(8))
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        score = sum(math.log(good[b] / sum(good)) - math.log(raw[b] / sum(raw)) for b in own) / len(own) if own else None
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        out.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
                    len(covered), failed, not failed and (score or 0) >= quality.LEAST_SCORE, round(score or 0, 9)))
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept,
                    round(r.score or 0, 9)) for r in df.collect()), key=repr)


LABELS = "doc_id long, quality int, text string"
REPEATS = [(20, "a b c d e f g h " * 6), (21, "x " + "p q r s t u v w y z " * 2 + "k " * 30), (22, "line one\nline one\n \n \nline two"),
           (23, " ".join(f"w{k}" for k in range(40)) + " " + " ".join(f"w{k}" for k in range(3, 12))),
           (24, "&&& ### good|text <b> " * 3 + "\n" * 5 + "$%*")]


def test_odd_rows(make_docs, spark):
    docs = [d for d in ODD + REPEATS]
    labels = spark.createDataFrame([(23, 1, "x"), (23, 1, "x"), (12, 0, None), (None, 1, None), (7, None, None), (99, 1, "")], LABELS)
    assert _got(quality.rules(make_docs(docs), labels)) == _plain(docs, {23})
    assert _got(quality.rules(make_docs(docs), labels.where("false"))) == _plain(docs, set())
    assert quality.rules(make_docs([]), labels).collect() == []


def test_query_equals_plain_definition(spark, small):
    from llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").collect()}
    assert _got(QUERIES["op1_quality_rules"](spark, small)) == _plain(docs, trusted)


def test_labels_are_met(spark):
    from llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op1_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0 and not r.base_failed]
    assert sum(r.kept for r in good) / len(good) > 0.97 and sum(r.kept for r in bad) / len(bad) < 0.1
