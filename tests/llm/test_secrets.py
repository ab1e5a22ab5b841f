"""Secret spans: the patterns against a plain scanner, the method on planted strings."""

import hashlib
import random
import re

from conftest_llm import ODD

from llm import secrets

WORDS = "account balance request handler session update value return index customer order total parse buffer".split()


def _plain_base(text):
    """The patterns read one position at a time."""
    found = []
    names = ["password", "passwd", "secret", "token", "apikey", "api_key"]
    body = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    at = 0
    while at < len(text):
        name = next((n for n in names if low.startswith(n, at)), None)
        end = None
        if name:
            k = at + len(name)
            k += text[k: k + 1] in ('"', "'") and k < len(text)
            while text[k: k + 1] == " ":
                k += 1
            if text[k: k + 1] in (":", "=") and k < len(text):
                k += 1
                while text[k: k + 1] == " ":
                    k += 1
                k += text[k: k + 1] in ('"', "'") and k < len(text)
                stop = k
                while stop < len(text) and text[stop] in body:
                    stop += 1
                if stop > k:
                    end = stop
                    if stop - k >= 6:
                        found.append((at, 0, stop))
        at = end or at + 1
    for kind, start_pattern, alphabet, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20), (2, "", "0123456789abcdef", 24)):
        at = 0
        while at < len(text):
            stop = at + len(start_pattern)
            if text.startswith(start_pattern, at):
                while stop < len(text) and text[stop] in alphabet:
                    stop += 1
                if stop > at + len(start_pattern):
                    if stop - at >= least:
                        found.append((at, kind, stop))
                    at = stop
                    continue
            at += 1
    return sorted(found)


def test_patterns_equal_the_plain_scanner():
    rng = random.Random(1)
    bits = ["password", "PassWd", "secret", "Token", "api_key", "apiKEY", "toKen", "ſecret", '"', "'", " ", "  ", ":", "=", "abcdef", "x=y",
            "AKIA", "AKIAAKIA", "ABCDEF0123456789", "0123456789abcdef", "deadbeef", "\n", "é", "日本", ".", "-", "short", "token=token=abc"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        assert secrets.base_spans(text) == _plain_base(text), repr(text)


def _random_key(rng, n):
    return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))


def _code(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_planted_keys_are_reported_and_names_are_not(make_docs):
    rng = random.Random(2)
    rows, wanted = [], {}
    for doc_id in range(60):
        before, after = _code(rng, 40), _code(rng, 40)
        key = _random_key(rng, rng.choice([24, 32, 40]))
        rows.append((doc_id, f"{before}\nAuthorization: Bearer {key}\n{after}"))
        start = len(f"{before}\nAuthorization: Bearer ")
        wanted[doc_id] = (start, start + len(key))
    for doc_id in range(100, 160):
        name = "_".join(rng.choice(WORDS) for _ in range(4))
        rows.append((doc_id, f"{_code(rng, 30)}\nAuthorization: Bearer {name}\npassword_{name} {name}Handler2\n{_code(rng, 30)}"))
    for doc_id in range(200, 230):  # random, but in no sensitive context
        rows.append((doc_id, f"{_code(rng, 60)} build {_random_key(rng, 40)} {_code(rng, 60)}"))
    got = {r.doc_id: r for r in secrets.secrets(make_docs(rows)).collect()}
    for doc_id, (start, end) in wanted.items():
        spans = [tuple(map(int, s.split(":")[1:])) for s in got[doc_id].spans.split(",") if s.startswith("novel")]
        assert any(s <= start and end <= e for s, e in spans), rows[doc_id]
    assert all(got[d].spans == "" and got[d].n_novel == 0 for d in got if d >= 100)


def test_marginal_bytes_of_names_are_few():
    novelty = secrets.Novelty(" ".join(WORDS * 3).encode())
    around = _code(random.Random(5), 40)
    assert novelty.marginal(around, "customer_balance_request_total") < 0.5 * len("customer_balance_request_total")
    key = _random_key(random.Random(6), 40)
    assert novelty.marginal(around, key) >= secrets.NOVEL_SHARE * 40
    assert novelty.marginal(f"{around} {key}", key) < 10  # what stands around is no news
    assert secrets.Novelty(b"").marginal("", key) > 0


def test_odd_rows(make_docs, spark):
    rows = [*ODD, (20, "token = " + "Ab1" * 40_000), (21, 'x' * 50_000 + ' api_key: "abcdef"'), (22, "token:" * 3000)]
    got = secrets.secrets(make_docs(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((d is None, d or 0) for d, _ in rows)
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(_plain_base(text or ""))
    for r in got:
        bases = texts[r.doc_id]
        assert r.base_sha256 in [hashlib.sha256(secrets.written(b).encode()).hexdigest() for b in bases]
        assert len([s for s in r.spans.split(",") if s and not s.startswith("novel")]) == r.n_assign + r.n_access + r.n_hex
    scanned = secrets.scan(make_docs(rows), b"")
    assert scanned.columns[: len(make_docs([]).columns)] == make_docs([]).columns
    assert secrets.secrets(make_docs([])).collect() == []


def test_query_keeps_every_base_span_of_a_table(spark):
    from llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op13_secret_spans"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        base = _plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(secrets.written(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, k, _ in base) for kind in range(3)]
        assert set(secrets.written(base).split(",")) <= set(r.spans.split(","))
        for span in filter(None, r.spans.split(",")):
            kind, start, end = span.split(":")
            assert re.fullmatch(r"[\x21-\x7e ]+", texts[r.doc_id][int(start): int(end)])
