"""From raw documents to token ids: toxic documents go, near copies and repeated passages go, sources are mixed, texts encoded.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; its result is
stored before the next one reads it.  All but the last give the columns of
``docs``; the last gives each row's position in the mix, as readers of stored
files do not keep their order.  Columns of ``docs`` may have any name and
stay as they are.  Rows with null ids or texts pass every stage, and an empty
table gives empty results; without labels of both kinds no document is toxic.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from llm import bpe, chunks, jaccard, mixing, toxicity
from llm.common import carry, materialise, restore, table
from llm.queries import MIX, MIX_BLOCK_ROWS, TOXIC_FROM


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an expected severity below TOXIC_FROM."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(carry(docs, "doc_id", "text"), model, TOXIC_FROM).where(~F.col("toxic"))
    return restore(scored, docs.columns, "doc_id", "text")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each component; of rows equal in id and text, one."""
    found = materialise(jaccard.join(docs), "near-copies").where("doc_id is not null")
    marks = (
        found.groupBy(F.col("doc_id").alias("__doc"))
        .agg(F.min("component_id").alias("__least"), F.count("*").alias("__rows"))
        .where("__least <> __doc or __rows > 1")
    )
    rows = carry(docs, "doc_id", "text")
    marked = rows.join(marks, F.col("doc_id").cast("long") == F.col("__doc"), "left").where(
        F.col("__doc").isNull() | (F.col("__least") == F.col("__doc")))
    once = marked.where("__rows is null").select(*rows.columns)
    repeated = marked.where("__rows > 1").select(*rows.columns)
    return restore(once.union(repeated.dropDuplicates(["doc_id", "text"])), docs.columns, "doc_id", "text")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; a document of nothing else goes."""
    cut = chunks.dedup(carry(docs, "doc_id", "text")).where((F.col("removed_bytes") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    cut = restore(cut, docs.columns, "doc_id", "text")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix to target weights."""
    return mixing.mixed(docs, MIX, MIX_BLOCK_ROWS)


def positioned(docs: DataFrame) -> DataFrame:
    """doc_id, source, text and the gapless ``position`` of each row in the order in which ``docs`` was written.

    Spark names the files by number of the task and, in a task, of the file;
    readers take them by size.  Rows that are not from Parquet files are
    stored first.
    """
    rows = docs.select("doc_id", "source", "text")
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    try:
        placed = rows.select("*", *place)
    except AnalysisException:
        placed = materialise(rows, "mix").select("*", *place)
    number = [F.regexp_extract("__file", pattern, 1).cast("long") for pattern in (r".*/part-(\d+)", r".*-c(\d+)\.")]
    before = Window.orderBy("__task", "__part", "__file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = (
        placed.groupBy("__file").agg(F.count("*").alias("__size"))
        .withColumn("__task", number[0]).withColumn("__part", number[1])
        .select("__file", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    )
    return placed.join(F.broadcast(files), "__file").select(
        "doc_id", "source", "text", (F.col("__before") + F.col("__row")).alias("position"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, position in the mix, packed ids, n_tokens, and whether the ids decode to the text."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode_checked(positioned(docs), ranks, public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: Several stages (regression, rolling hashes, merges) are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
