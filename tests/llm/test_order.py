"""Shards and mixes against plain definitions."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from conftest_llm import ODD
from pyspark.sql import functions as F

from llm import mixing, sharding


def _hash(key, shard):
    """Spark's xxhash64(long key, int shard); a null key leaves the seed."""
    seed = 42
    if key is not None:
        seed = xxhash.xxh64_intdigest((key % (1 << 64)).to_bytes(8, "little"), seed)
    return xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), seed)


def _shard(key, weights):
    return min((-math.log(((_hash(key, s) >> 11) + 0.5) / (1 << 53)) / w, s) for s, w in enumerate(weights) if w > 0)[1]


def test_shards_of_odd_rows(make_docs):
    got = sharding.shards(make_docs(ODD), [1.0, 2.0, 0.0, 1.0]).collect()
    assert len(got) == len(ODD)
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", _shard(d, [1, 2, 0, 1]),
                    _shard(d, [1, 2, 0, 1, 1])) for d, t in ODD)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shards(make_docs([]), [1.0]).collect() == []


def test_query_shards(spark, small):
    from llm.queries import QUERIES

    got = QUERIES["op4_rendezvous_shards"](spark, small).collect()
    for r in got:
        assert r.shard == _shard(r.doc_id, [1.0] * 16)
        assert r.grown_shard in (r.shard, 16) and r.grown_shard == _shard(r.doc_id, [1.0] * 17)
    assert sorted(set(r.shard for r in got)) == list(range(16))


def test_weights_rule_the_share(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    counts = {r.shard: r["count"] for r in sharding.shards(rows, [1.0, 3.0], 2.0).groupBy("shard").count().collect()}
    assert abs(counts[1] / 20000 - 0.75) < 0.02
    moved = sharding.shards(rows, [1.0, 3.0], 2.0).where("shard <> grown_shard").count()
    assert abs(moved / 20000 - 1 / 3) < 0.02


def _plain_schedule(parts):
    """Earliest deadline first over one period, slot by slot."""
    period, had, picks = sum(parts), [0] * len(parts), []
    for t in range(period):
        ready = [(-(-(h + 1) * period // w), s) for s, (h, w) in enumerate(zip(had, parts)) if h * period // w <= t]
        _, s = min(ready)
        had[s] += 1
        picks.append(s)
    return [[t for t, p in enumerate(picks) if p == s] for s in range(len(parts))]


@pytest.mark.parametrize("parts", [[1], [20, 10, 10, 10, 50], [1, 1, 1], [97, 1, 1, 1], [7, 11, 13, 29, 3, 37]])
def test_period_is_earliest_deadline_first_and_keeps_to_the_weights(spark, parts):
    slots = spark.range(1).select(mixing.period_slots(parts)).collect()[0][0]
    assert slots == _plain_schedule(parts)
    period = sum(parts)
    for w, own in zip(parts, slots):
        assert len(own) == w
        for j, slot in enumerate(own):
            assert j * period // w <= slot < -(-(j + 1) * period // w)
        for t in range(period + 1):
            assert abs(sum(s < t for s in own) - w * t / period) < 1


def test_whole_parts():
    assert mixing.whole_parts({"a": 1, "b": 1, "c": 1}, 100) == {"a": 34, "b": 33, "c": 33}
    assert mixing.whole_parts({"a": 0.001, "b": 1.0}, 10) == {"a": 1, "b": 9}
    assert sum(mixing.whole_parts({str(k): 1 + k for k in range(50)}, 60).values()) == 60
    with pytest.raises(ValueError):
        mixing.whole_parts({"a": 0.0}, 10)


def _plain_mix(docs, weights, block_rows, period):
    weights = dict(weights)
    weights.setdefault("other", min(weights.values()))
    parts = mixing.whole_parts(weights, period)
    names = sorted(parts)
    slots = _plain_schedule([parts[n] for n in names])
    queues = defaultdict(list)
    for doc_id, source in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        queues[source if source in parts and source != "other" else "other"].append((doc_id, source))
    out = []
    for name, queue in queues.items():
        for n, (doc_id, source) in enumerate(queue):
            j, w = n // block_rows, parts[name]
            out.append((j // w * period + slots[names.index(name)][j % w], n % block_rows, doc_id, source, name, j))
    return [(doc_id, source, name, j, place, slot, k) for k, (slot, place, doc_id, source, name, j) in enumerate(sorted(out, key=lambda r: r[:2]))]


def _rows_of(df):
    return [(r.doc_id, r.source, r.stream, r.block, r.block_offset, r.slot, r.position) for r in df.orderBy("position").collect()]


def test_mix_of_odd_sources(make_docs):
    docs = [(k, "t", s) for k, s in enumerate(["a"] * 30 + ["b"] * 7 + [None] * 5 + ["it's"] * 4 + ["c"] * 9)] + [(None, None, "a")]
    got = _rows_of(mixing.positions(make_docs(docs), {"a": 0.5, "b": 0.3, "it's": 0.2}, 2, 10))
    assert got == _plain_mix([(d, s) for d, _, s in docs], {"a": 0.5, "b": 0.3, "it's": 0.2}, 2, 10)
    assert mixing.positions(make_docs([]), {"a": 1.0}, 2).collect() == []


def test_query_mix(spark, small):
    from llm import queries

    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source").collect()]
    got = _rows_of(queries.QUERIES["op5_pfair_mix"](spark, small))
    assert got == _plain_mix(docs, queries.MIX, queries.MIX_BLOCK_ROWS, 100)


def test_mixed_rows_come_in_order_with_their_columns(make_docs):
    docs = make_docs([(k, f"t{k}", "ab"[k % 2]) for k in range(40)])
    out = mixing.mixed(docs, {"a": 0.5, "b": 0.5}, 2)
    assert out.columns == docs.columns
    want = [r[0] for r in _plain_mix([(k, "ab"[k % 2]) for k in range(40)], {"a": 0.5, "b": 0.5}, 2, 100)]
    assert [r.doc_id for r in out.collect()] == want


def test_query_mix_equals_its_sql(spark, small):
    from compare import differences, open_oracle

    from llm import queries

    name = "op5_pfair_mix"
    assert differences(queries.QUERIES[name], queries.ORACLE_SQL[name], spark, small, open_oracle(small)) is None
