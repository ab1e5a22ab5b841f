"""Dual-tree search against scores of all pairs, written plainly."""

import math
import random
import re
from collections import Counter

import numpy as np
from conftest_llm import ODD
from pyspark.sql import types as T

from llm import lexical

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("rank", T.StringType()), T.StructField("doc_id", T.StringType())])
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _plain(docs, items, best=10):
    own = [(doc_id, Counter(_terms(text))) for doc_id, text in docs]
    own = [(doc_id, c, sum(c.values())) for doc_id, c in own if c]
    n_docs, n_terms = len(own), sum(n for *_, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c, n in own:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(_terms(text)) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort()
        out += [(item_id, rank + 1, doc_id, -score) for rank, (score, _, doc_id) in enumerate(scores[:best])]
    return sorted(out, key=repr)


def _items(spark, items):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)


def _corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["Étude", "日本", "ß", "don't", "A1"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, " ".join(rng.choices(words, weights, k=rng.randrange(60)))) for k in range(n)]
    return docs, rng


def test_search_equals_all_pairs(make_docs, spark, rows):
    docs, rng = _corpus(1, 700)
    docs += [(doc_id + 5000, text) for doc_id, text in docs[:150]] + [*ODD]  # ties, nulls, repeated rows
    items = [(k, " ".join(rng.choice(docs)[1].split()[:20]) if docs else "") for k in range(90)]
    items += [(90, None), (91, ""), (92, "?!"), (93, "nowhere"), (None, "w1 w2"), (3, "w5 W5 w5 日本"), (3, "w5 W5 w5 日本"), (94, "one word x")]
    items = [(i, t) for i, t in items]
    got = rows(lexical.search(make_docs(docs), _items(spark, items)))
    assert got == _plain(docs, items)


def test_blocks_and_small_nodes_change_nothing(make_docs, spark, rows, monkeypatch):
    for name, value in (("BLOCK_ITEMS", 7), ("SLICE_DOCS", 64), ("SEED_SHARE", 5), ("PIECE", 16)):
        monkeypatch.setattr(lexical, name, value)
    docs, rng = _corpus(2, 300)
    items = [(k, " ".join(rng.sample([f"w{j}" for j in range(400)], 12))) for k in range(20)]
    assert rows(lexical.search(make_docs(docs), _items(spark, items), 4)) == _plain(docs, items, 4)


def test_empty_tables(make_docs, spark):
    items = _items(spark, [(1, "one")])
    found = lexical.search(make_docs([]), items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []
    assert lexical.search(make_docs([(1, None), (2, "!")]), items).collect() == []
    assert lexical.search(make_docs([(1, "one")]), _items(spark, [])).collect() == []


def test_most_pairs_are_left_out():
    """Nodes below the kth scores go as a whole, and the best of all pairs stay."""
    rng = np.random.default_rng(3)
    n_docs, n_terms, n_items = 8192, 2000, 40
    starts = np.arange(n_docs + 1) * 12
    # topics: a document takes its terms from one of 100 ranges
    topic = rng.integers(0, 100, n_docs)
    terms = np.concatenate([t * 20 + rng.permutation(20)[:12] for t in topic])
    counts = rng.integers(1, 5, len(terms))
    weights = np.array([(t * 20 + k, i, 1000 + 7 * k) for i, t in enumerate(rng.integers(0, 100, n_items)) for k in range(8)])
    lengths = np.full(n_docs, 60)
    model = lexical.Model(n_docs, int(lengths.sum()), np.arange(n_terms), weights, np.arange(n_items), list(range(n_items)), 10)
    tree = lexical.DualTree(model, np.zeros(n_items, np.int64))
    for at in range(0, n_docs, 4096):
        part = slice(starts[at], starts[at + 4096])
        tree.add(list(range(at, at + 4096)), lengths[at: at + 4096], starts[: 4097], terms[part], counts[part])
    dense = np.zeros((n_terms, n_items), np.int64)
    dense[weights[:, 0], weights[:, 1]] = weights[:, 2]
    impact = lexical.impacts(counts, np.repeat(lengths, 12), n_docs, model.n_terms)
    scores = np.add.reduceat(impact[:, None] * dense[terms], starts[:-1])
    for item in range(n_items):
        want = sorted((-s, d) for d, s in enumerate(scores[:, item].tolist()) if s > 0)[:10]
        assert sorted((-s, -d) for s, _, d in tree.heaps[item]) == want
    assert tree.scored < tree.pairs / 10


def test_query_equals_all_pairs_on_a_table(spark, small, rows):
    from llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(QUERIES["op11_dual_tree_search"](spark, small)) == _plain(docs, items)
