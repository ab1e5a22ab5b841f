"""Severity by ordinal regression: held-out accuracy, ordered thresholds, odd rows."""

import math
from collections import Counter

import numpy as np
from conftest_llm import ODD
from pyspark.sql import functions as F

from llm import toxicity


def test_cumulative_links_recover_an_ordered_model():
    rng = np.random.default_rng(3)
    weights = np.array([2.0, -1.0, 0.0, 1.0])
    index = [np.flatnonzero(rng.random(4) < 0.5) for _ in range(4000)]
    noise = rng.logistic(size=4000)
    grades = np.searchsorted([-0.5, 1.0, 2.5], [weights[i].sum() for i in index] + noise)
    got, thresholds = toxicity.fit_cumulative(index, [np.ones(len(i)) for i in index], grades, 4, 4)
    assert np.abs(got - weights).max() < 0.35 and np.abs(thresholds - [-0.5, 1.0, 2.5]).max() < 0.3
    assert (np.diff(thresholds) > 0).all()


def test_held_out_documents_are_told_apart(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.hash("doc_id"), F.lit(3)) == 0
    model = toxicity.fit(docs, labels.where(~held))
    assert (np.diff(model.thresholds) > 0).all()
    scored = toxicity.score(docs.select("doc_id", "text").join(labels.where(held).select("doc_id", F.col("toxic").alias("truth")), "doc_id"), model)
    rows = scored.collect()
    toxic, clean = ([r.toxic for r in rows if r.truth == t] for t in (1, 0))
    # some labels are noise: toxic ones without a toxic word, and the reverse
    assert len(rows) > 1000 and sum(toxic) / len(toxic) > 0.9 and sum(clean) / len(clean) < 0.01
    assert all(0 <= r.severity <= 3 for r in rows)
    graded = {g: np.mean([r.severity for r in rows if r.grade == g]) for g in {r.grade for r in rows}}
    assert [graded[g] for g in sorted(graded)] == sorted(graded.values())


def test_odd_rows_score_as_clean(make_docs, spark):
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(20, 60)] + [(1, None, None)], "doc_id long, toxic int, text string")
    docs = make_docs([(k, "awful dreadful words" if k % 2 else "kind gentle words") for k in range(20, 60)])
    model = toxicity.fit(docs, labels)
    out = toxicity.score(make_docs(ODD + [(90, "Awful, dreadful!")]), model)
    assert out.schema["severity"].dataType.simpleString() == "double"
    found = {(r.doc_id, r.toxic) for r in out.collect()}
    assert {d for d, t in found if t} == {90}
    assert toxicity.score(make_docs([]), model).collect() == []
    for one_kind in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.limit(0)):
        scored = toxicity.score(docs, toxicity.fit(docs, one_kind)).collect()
        assert len(scored) == 40 and {(r.grade, r.toxic) for r in scored} == {(0, False)} and max(r.severity for r in scored) < 1e-9
    assert toxicity.fit(make_docs([]), labels).numbers == {}


def test_query_equals_a_plain_fold(spark, small):
    """Features, grades and scores of the whole table, counted plainly; only the solver is shared."""
    from llm.queries import QUERIES

    docs = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    truth = {}
    for doc_id, toxic in spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "toxic").collect():
        if doc_id in docs and toxic is not None:
            truth[doc_id] = max(toxic, truth.get(doc_id, 0))
    assert 0 < len(truth) < toxicity.MOST_ROWS

    def named(text):
        for word in text.lower().split():
            word = word.strip(toxicity.ENDS)
            yield from ([word] if word else [])
            yield from (word[:n] + "^" for n in (4, 5, 6) if len(word) > n)

    n = [sum(t == kind for t in truth.values()) for kind in (0, 1)]
    seen = [Counter(f for d, t in truth.items() if t == kind for f in set(named(docs[d]))) for kind in (0, 1)]
    chosen = []
    for f in seen[0] | seen[1]:
        ratio = ((seen[1][f] + 0.5) / (n[1] + 1)) / ((seen[0][f] + 0.5) / (n[0] + 1))
        evidence = seen[1][f] * math.log(ratio)
        if evidence >= toxicity.LEAST_EVIDENCE + 2 * math.log(sum(n)) and ratio >= 3:
            chosen.append((-evidence, f, ratio))
    chosen = sorted(chosen)[: toxicity.MOST_FEATURES]
    number = {f: k for k, (_, f, _) in enumerate(chosen)}
    assert chosen

    def vector(text):
        counts = sorted(Counter(number[f] for f in named(text) if f in number).items())
        return np.array([k for k, _ in counts], int), np.array([1 + math.log(c) for _, c in counts]), dict(counts)

    markers = {number[f] for _, f, ratio in chosen if ratio >= 10 and not f.endswith("^")}
    fold = [(vector(docs[d]), truth[d]) for d in sorted(truth)]
    marked = [sum(c for k, c in v[2].items() if k in markers) for v, _ in fold]
    grades = np.array([0 if not t else 1 + (m >= 3) + (m >= 8) for (_, t), m in zip(fold, marked)])
    weights, thresholds = toxicity.fit_cumulative([v[0] for v, _ in fold], [v[1] for v, _ in fold], grades, len(number), 4)
    got = {r.doc_id: r for r in QUERIES["op7_toxic_severity"](spark, small).collect()}
    assert set(got) == set(docs)
    for doc_id, text in docs.items():
        index, values, _ = vector(text or "")
        severity = sum(1 - 1 / (1 + math.exp(-(t - float(weights[index] @ values if len(index) else 0)))) for t in thresholds)
        assert abs(got[doc_id].severity - severity) < 1e-6 and got[doc_id].toxic == (severity >= toxicity.REJECT)
