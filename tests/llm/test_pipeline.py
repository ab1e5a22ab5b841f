"""The stages of the pipeline against plain definitions, each on what its predecessor kept."""

import base64
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from conftest_llm import ODD
from test_jaccard import _plain as plain_components
from test_order import _plain_mix

import corpus_pipeline
from llm import chunks, queries, toxicity

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """The result of every stage on the small tables, stored and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], small).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def _rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_columns_stay_until_the_last_stage(stored):
    for df in stored[1:-1]:
        assert df.dtypes == stored[0].dtypes


def test_toxic_documents_go(spark, small, stored):
    model = toxicity.fit(stored[0], spark.read.parquet(f"{small}/labels.parquet"))
    counter = toxicity.Counter(model.numbers)
    want = Counter()
    for r in stored[0].collect():
        index, counts = counter.count(r.text)
        if model.expected((model.weights[index] * toxicity.value(counts)).sum() if len(index) else 0.0) < queries.TOXIC_FROM:
            want[(r.doc_id, r.text)] += 1
    assert _rows(stored[1]) == want and sum(want.values()) < stored[0].count()


def test_one_of_each_group_stays(stored):
    docs = [(r.doc_id, r.text) for r in stored[1].collect()]
    least = {d: c for d, _, c in plain_components(docs)}
    assert _rows(stored[2]) == Counter((d, t) for d, t in docs if least[d] == d)


def test_repeated_passages_go(stored):
    docs = sorted((r.doc_id, r.text) for r in stored[2].collect())
    owner = {}
    want = Counter()
    for doc_id, text in docs:
        digests = chunks.chunks(text.encode())[1]
        for digest in digests:
            owner.setdefault(digest, doc_id)
        kept = chunks.cut_text(text, {d: owner[d] for d in digests if d and owner[d] < doc_id}, chunks.LEAST_WORDS)[0]
        if kept == text or kept.split():
            want[(doc_id, kept)] += 1
    assert _rows(stored[3]) == want
    assert all(r.n_chars == len(r.text) for r in stored[3].collect())


def test_mix_keeps_all_rows_in_order(stored):
    docs = [(r.doc_id, r.source) for r in stored[3].collect()]
    assert _rows(stored[4]) == _rows(stored[3])
    want = [r[0] for r in _plain_mix(docs, queries.MIX, queries.MIX_BLOCK_ROWS, 100)]
    assert [r.doc_id for r in stored[4].collect()] == want


def test_mix_stays_when_stored_in_many_files(spark, small, stored, tmp_path):
    docs = [(r.doc_id, r.source) for r in stored[3].collect()]
    want = [r[0] for r in _plain_mix(docs, queries.MIX, queries.MIX_BLOCK_ROWS, 100)]
    mixed = corpus_pipeline.mix_sources(spark, stored[3], small)
    # files of very different sizes, of one task and of several
    for name, df, most in (("one", mixed.coalesce(1), 7), ("some", mixed.coalesce(3), 11)):
        df.write.option("maxRecordsPerFile", most).parquet(f"{tmp_path}/{name}")
        read = spark.read.parquet(f"{tmp_path}/{name}")
        got = corpus_pipeline.encode(spark, read, small).orderBy("position").collect()
        assert [r.position for r in got] == list(range(len(want)))
        assert [r.doc_id for r in got] == want
    got = corpus_pipeline.run(spark, small).orderBy("position").collect()
    assert [r.doc_id for r in got] == want


def test_ids_equal_the_library_and_decode(stored):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stored[4].collect()}
    rows = stored[5].collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(ids) and r.round_trip


def test_run_gives_what_the_stages_give(spark, small, stored):
    got = Counter((r.doc_id, bytes(r.ids)) for r in corpus_pipeline.run(spark, small).collect())
    assert got == Counter((r.doc_id, bytes(r.ids)) for r in stored[5].collect())


def test_odd_rows_pass(spark, make_docs, tmp_path):
    labels = [(k, 1, k % 2) for k in range(30, 60)]
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    docs = make_docs(ODD + [(k, "vile horrid stuff" if k % 2 else "kind gentle things") for k in range(30, 60)])
    for name, stage in corpus_pipeline.STAGES:
        # the fit needs labelled documents; the other stages take an empty table too
        if name != "toxicity":
            assert stage(spark, make_docs([]).select(*docs.columns), str(tmp_path)).count() == 0
        docs.write.parquet(str(tmp_path / name))
        docs = stage(spark, spark.read.parquet(str(tmp_path / name)), str(tmp_path))
    found = Counter(r.doc_id for r in docs.collect())
    assert found[None] == 2  # rows without an id are never judged as copies
    assert found[5] == 1 and found[6] == 0  # a repeated row and a copy
    assert found[31] == 0 and found[30] == 1 and found[32] == 0
    assert {1, 2, 3, 4, 7, 8, 9, 10, 11, 12} <= set(found)


CLASHING = ["slot", "block", "stream", "block_offset", "release", "deadline", "position", "removed_bytes", "n_chunks", "n_repeated_chunks",
            "first_doc_ids", "severity", "grade", "toxic", "component_id", "n_shingles", "owners", "digest", "__doc", "__owners", "__least",
            "__rows", "__file", "__row", "__task", "__carried", "n_tokens", "ids"]


def test_columns_of_any_name_pass_all_stages(spark, small):
    """A caller's column comes out as it went in, whatever helpers call their own."""
    texts = [(k, f"some words of text {k} " * 6, f"src{k % 3}") for k in range(12)] + [(20, None, None), (None, "no id", "src0")]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{name} long" for name in CLASHING)
    docs = spark.createDataFrame([(*row, *range(700, 700 + len(CLASHING))) for row in texts], schema)
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialise(stage(spark, out, small), "test")
        assert out.columns == docs.columns and out.count() > 0
        for row in out.collect():
            assert list(row)[3:] == list(range(700, 700 + len(CLASHING)))
    assert corpus_pipeline.encode(spark, out, small).count() == out.count()


def test_empty_documents_and_labels_pass(spark, small, tmp_path):
    docs, labels = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "labels"))
    for name, pair in (("no-docs", (docs.limit(0), labels)), ("no-labels", (docs.limit(30), labels.limit(0)))):
        for table, df in zip(("documents", "labels"), pair):
            df.coalesce(1).write.parquet(f"{tmp_path}/{name}/{table}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/no-docs").collect() == []
    out = corpus_pipeline.run(spark, f"{tmp_path}/no-labels")
    assert 0 < out.count() <= 30
    assert queries.QUERIES["op7_toxic_severity"](spark, f"{tmp_path}/no-docs").collect() == []
