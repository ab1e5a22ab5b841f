"""The similarity join against all pairs."""

import math
import random

import numpy as np
import pytest
from conftest_llm import ODD

from llm import jaccard
from llm.components import components


def _sets(docs, size=5):
    out = []
    for _, text in docs:
        words = (text or "").encode().lower().split()
        width = min(size, len(words))
        out.append({tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if width else set())
    return out


def _plain(docs, percent=75):
    """(doc_id, set size, component) by comparing all pairs; null ids link with nothing."""
    sets, parent = _sets(docs), {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for k, s in enumerate(sets):
        for shingle in s:
            index.setdefault(shingle, []).append(k)
    pairs = {(i, j) for own in index.values() for x, i in enumerate(own) for j in own[x + 1:]}
    for i, j in pairs:
        a, b = docs[i][0], docs[j][0]
        both = len(sets[i] & sets[j])
        if a is not None and b is not None and both * 100 >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return [(d, len(s), None if d is None else root(d)) for (d, _), s in zip(docs, sets)]


def _got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_odd_rows(make_docs):
    assert _got(jaccard.join(make_docs(ODD))) == sorted(_plain(ODD), key=repr)
    assert jaccard.join(make_docs([])).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_copies_equal_all_pairs(make_docs, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    docs = []
    for family in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 30, 120]))]
        if family % 3 == 0:
            base += passage
        for _ in range(rng.randint(1, 14)):
            text = list(base)
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = rng.choice(words)
            docs.append((len(docs) * 7 % 1009, " ".join(text)))
    docs += [(5000 + k, docs[3][1]) for k in range(30)]
    assert _got(jaccard.join(make_docs(docs))) == sorted(_plain(docs), key=repr)


def test_member_that_does_not_link_with_its_head(make_docs):
    rng = random.Random(3)
    shared, one, two = ([f"{name}{rng.randrange(10 ** 9)}" for _ in range(size)] for name, size in (("s", 160), ("x", 30), ("y", 30)))
    docs = [(1, shared + one), (2, shared + one + two), (3, shared + two)]
    # the ends are common, so 1 and 3 have their prefix in what they share, and are one group with head 1
    docs += [(100 + k, shared[-4:] + (one if k % 2 else two)) for k in range(40)]
    docs = [(d, " ".join(words)) for d, words in docs]
    sets = _sets(docs)
    assert len(sets[0]) == len(sets[2]) and len(sets[0] & sets[2]) / len(sets[0] | sets[2]) < 0.75 <= len(sets[1] & sets[2]) / len(sets[1] | sets[2])
    assert _got(jaccard.join(make_docs(docs))) == sorted(_plain(docs), key=repr)


def test_query_equals_all_pairs(spark, small):
    from llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = _plain(docs)
    assert len({c for _, _, c in want}) < len(docs)
    assert _got(QUERIES["op8_ngram_jaccard"](spark, small)) == sorted(want, key=repr)


def test_prefix_length_is_enough():
    for n in range(1, 500):
        for percent in (50, 75, 90, 100):
            least = -(-percent * n // 100)
            assert jaccard.prefix_length(n, percent) == n - least + 1


def test_samples_of_pairs_that_link_pass():
    """The bound is that of a binomial tail, and sets just at the threshold are above it."""
    for percent in (50, 75, 90):
        bound, t = jaccard.least_agreeing(percent), percent / 100
        for used in (0, 1, 8, 40, 48, 64):
            tail = [sum(math.comb(used, k) * t ** k * (1 - t) ** (used - k) for k in range(n)) for n in range(used + 1)]
            assert tail[bound[used]] < jaccard.SAMPLE_LOSS and (bound[used] == used or tail[bound[used] + 1] >= jaccard.SAMPLE_LOSS)
        rng = np.random.default_rng(8)
        both = 3 * percent
        for _ in range(100):
            shared = rng.integers(0, 1 << 63, both, dtype=np.uint64) * np.uint64(2)
            own = rng.integers(0, 1 << 63, (2, (300 - both) // 2), dtype=np.uint64) * np.uint64(2)
            x, y = (np.frombuffer(jaccard.sample(np.unique(np.concatenate([shared, o]))), np.uint8) for o in own)
            assert ((x == y) & (x > 0)).sum() >= bound[((x > 0) | (y > 0)).sum()]
    assert jaccard.least_agreeing(75)[0] == 0 and jaccard.sample(np.zeros(0, np.uint64)) == bytes(jaccard.BINS)


def _around_the_threshold(rng, n):
    """Copies of one text that differ so much that many link with some of the others only, or with none."""
    words = [f"w{k}" for k in range(3000)]
    base = [rng.choice(words) for _ in range(80)]
    docs = []
    for doc_id in range(n):
        text = list(base)
        for _ in range(rng.randrange(5)):
            text[rng.randrange(len(text))] = rng.choice(words)
        docs.append((doc_id, " ".join(text)))
    return docs


@pytest.mark.parametrize("percent, paired", [(50, 2), (75, 2), (75, 64), (90, 2)])
def test_one_large_group_around_the_threshold(make_docs, monkeypatch, percent, paired):
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 1500)
    docs = _around_the_threshold(random.Random(percent), 220) + [(1000 + k, f"other words {k} " * k) for k in range(20)]
    assert _got(jaccard.join(make_docs(docs), percent)) == sorted(_plain(docs, percent), key=repr)


def test_rows_of_a_crowd_grow_with_its_classes(make_docs, monkeypatch):
    """Twice the classes of a long list give about twice the rows, not four times."""
    sizes = []
    crowds, between = jaccard._crowds, jaccard._between

    def counted(build):
        def run(*args):
            df = build(*args)
            sizes.append(df.count())
            return df

        return run

    monkeypatch.setattr(jaccard, "_crowds", counted(crowds))
    monkeypatch.setattr(jaccard, "_between", counted(between))
    for n in (150, 300):
        jaccard.join(make_docs(_around_the_threshold(random.Random(1), n)))
    pairs_small, rows_small, pairs_large, rows_large = sizes
    assert 0 < rows_large <= 3 * rows_small and pairs_large <= 64 * 300


def test_blocks_join_each_component_once():
    block = jaccard.Block(75)
    sets = [np.arange(100) + k for k in (0, 1, 2, 500)]
    for rep, own in enumerate(sets):
        block.add(rep, rep // 2 * 2, own)  # 0 and 1 are one component, 2 and 3 another
    assert block.meet(9, 9, np.arange(100) + 1) == [0, 2]
    assert block.meet(8, 2, np.arange(100)) == [] and block.meet(7, 7, np.arange(900, 1000)) == []


def test_order_puts_common_shingles_last():
    shingles = np.unique(np.arange(100, dtype=np.uint64) * np.uint64(7919))
    classes = np.zeros(1 << 10, np.uint8)
    classes[int(shingles[0]) & 1023] = 9
    assert jaccard.ordered(shingles, classes)[-1] == shingles[0]


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(200, 330)] + [(7, k) for k in range(1000, 1100)] + [(5, 5), (None, 3), (9, 8), (8, 9)]
    rng = random.Random(4)
    links += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
