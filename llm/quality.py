"""Quality rules: surface counts, and a log-likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words are hashed into ``buckets`` counters,
once over the trusted documents and once over all.  A document's score is the
mean, over its n-grams, of ln(p_trusted / p_raw) with add-one smoothing; it
is kept when the score reaches ``least_score`` and the surface rules pass.

Everything is DataFrame functions.  The texts are read twice and never
shuffled: n-gram counts are reduced in each task to the buckets, and the
``buckets`` log-ratios come back as a literal array.  Trusted documents are
those with a quality label of 1, at most ``most_trusted`` of them (those with
the least hash of their id), so the list of ids that is broadcast is bounded;
the raw counts cover every document.

Null text has no words and fails.  Rows are judged one by one, whatever their
``doc_id``.  Without any trusted document all ratios are 0 and the surface
rules alone decide.  An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from llm.common import documents, need

BUCKETS, MOST_TRUSTED, LEAST_SCORE = 1 << 14, 20_000, -0.05
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 20, 30, 8
SPACE_CLASS = r"[\x20\x09-\x0D]"


def with_hashes(docs: DataFrame) -> DataFrame:
    """Adds ``hashes`` of the words and ``pairs`` of neighbouring words, in text order."""
    # ends first, so that only an empty text gives an empty word
    trimmed = F.regexp_replace(F.coalesce("text", F.lit("")), rf"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE_CLASS}+"))
    return docs.withColumn("hashes", F.transform(words, lambda w: F.xxhash64(w))).withColumn(
        "pairs", F.expr(
            "if(size(hashes) > 1, transform(sequence(1, size(hashes) - 1), i -> xxhash64(hashes[i - 1], hashes[i])),"
            " cast(array() as array<bigint>))"))


def _n_grams(buckets: int) -> Column:
    """Buckets of all words and of all pairs; one word has no pair."""
    return F.expr(f"transform(concat(hashes, pairs), h -> cast(pmod(h, {buckets}) as int))")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, most_trusted: int = MOST_TRUSTED) -> list[float]:
    """ln(p_trusted / p_raw) of each bucket."""
    trusted = (
        need(labels, doc_id="long", quality="int").where("quality = 1 and doc_id is not null").select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_trusted).withColumn("trusted", F.lit(1))
    )
    counted = (
        with_hashes(documents(docs).join(F.broadcast(trusted), "doc_id", "left"))
        .select(F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode(_n_grams(buckets)).alias("bucket"))
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("trusted"))
        .collect()  # at most one row per bucket
    )
    raw, good = [1] * buckets, [1] * buckets
    for row in counted:
        raw[row.bucket] += row.raw
        good[row.bucket] += row.trusted
    all_raw, all_good = sum(raw), sum(good)
    if all_good == buckets:
        return [0.0] * buckets
    return [math.log(g / all_good) - math.log(r / all_raw) for g, r in zip(good, raw)]


def _repeated_words() -> Column:
    """Words in windows of WINDOW words that occur twice or more in the text.

    A window is known by the hash of its pairs.  Most texts repeat none; for
    others windows are sorted by hash and place, and the places of repeated
    ones, in order, cover WINDOW words each less the overlap with the next.
    """
    hashed = "xxhash64(" + ", ".join(f"pairs[i + {k}]" for k in range(0, WINDOW, 2)) + ")"
    return F.expr(f"""
        if(size(hashes) <= {WINDOW}, 0, transform(
            array(transform(sequence(0, size(hashes) - {WINDOW}), i -> {hashed})),
            w -> if(size(array_distinct(w)) = size(w), 0, transform(
                array(sort_array(transform(w, (h, i) -> named_struct('h', h, 'i', i)))),
                s -> transform(
                    array(sort_array(transform(filter(sequence(0, size(s) - 1),
                        k -> (k > 0 and s[k].h = s[greatest(k - 1, 0)].h)
                          or (k < size(s) - 1 and s[k].h = s[least(k + 1, size(s) - 1)].h)), k -> s[k].i))),
                    p -> aggregate(sequence(0, size(p) - 1), 0, (n, k) ->
                        n + if(k = size(p) - 1, {WINDOW}, least({WINDOW}, p[least(k + 1, size(p) - 1)] - p[k]))))[0])[0]))[0])
    """).cast("long")


def judge(docs: DataFrame, ratios: list[float], least_score: float = LEAST_SCORE) -> DataFrame:
    """doc_id, the surface counts, score, base_failed and kept of every row."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = with_hashes(documents(docs))
    counts = rows.select(
        "doc_id",
        F.size("hashes").cast("long").alias("n_words"),
        (F.length(text) - F.regexp_count(text, F.lit(SPACE_CLASS))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
        _repeated_words().alias("n_repeat_words"),
        F.aggregate(_n_grams(len(ratios)), F.lit(0.0), lambda total, b: total + F.get(table, b)).alias("total"),
    )
    n_grams = F.col("n_words") + F.greatest(F.col("n_words") - 1, F.lit(0))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.when(n_grams > 0, F.col("total") / n_grams).alias("score"), failed.alias("base_failed"),
    ).withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) >= least_score))


def rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, most_trusted: int = MOST_TRUSTED,
          least_score: float = LEAST_SCORE) -> DataFrame:
    return judge(docs, log_ratios(docs, labels, buckets, most_trusted), least_score)
