"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text; where it hits a mask before white
space, a chunk ends (in text without white space: at a character).  Cuts so
depend on the bytes just before them, and after an insertion the chunks soon
agree again.  A chunk is known by the digest of its stripped bytes, and
belongs to the least ``doc_id`` that has it, at its first place there.

Single chunks are a few words, which texts share by chance.  A passage goes
only where chunks that belong elsewhere stand in a run of ``least_words``
words or more, or of ``least_chars`` characters that are not white space, as
some text has none; then the whole run goes.

Null or empty text has no chunk.  Rows without a ``doc_id`` stay whole and
own no chunk.  Rows with the same ``doc_id`` count as one document.  Texts of
any length are cut whole.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from llm.common import LONG, SLICE, STRING, documents, field, with_columns

#: Random numbers of the bytes, the same in every run.
GEAR = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 32, 256, dtype=np.uint32)
#: A chunk may end at few word ends while it is short, at every second one later, so few chunks grow long.
WORD_MASK, LATE_MASK = np.uint32(7 << 20), np.uint32(1 << 20)
LATE_BYTES = 24
CHAR_MASK = np.uint32(31 << 20)  # a 32nd of the characters
LEAST_BYTES, MOST_BYTES = 8, 256
LEAST_WORDS, LEAST_CHARS = 20, 120

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def cuts(body: bytes) -> list[int]:
    """Where the chunks of ``body`` start, and its length."""
    size = len(body)
    if not size:
        return [0]
    raw = np.frombuffer(body, np.uint8)
    rolled = GEAR[raw]
    for width in (1, 2, 4, 8, 16):  # the hash of the last 32 bytes, by doubling
        more = rolled.copy()
        more[width:] += rolled[:-width] << np.uint32(width)
        rolled = more
    space = _IS_SPACE[raw]
    # a cut at i looks at the bytes before i
    words = np.flatnonzero(space[1:] & ~space[:-1] & ((rolled[:-1] & LATE_MASK) == 0)) + 1
    early = (rolled[words - 1] & WORD_MASK) == 0
    starts = [0]
    at = 0
    characters = None
    for cut, soon in zip([*words.tolist(), size], [*early.tolist(), True]):
        if not soon and cut - at < LATE_BYTES:
            continue
        while cut - at > MOST_BYTES:  # no word end: cut inside
            if characters is None:
                whole = (raw[1:] & 0xC0) != 0x80
                characters = np.flatnonzero(whole & ((rolled[:-1] & CHAR_MASK) == 0)) + 1
            k = np.searchsorted(characters, at + LEAST_BYTES)
            inner = int(characters[k]) if k < len(characters) else cut
            if inner - at > MOST_BYTES:
                inner = at + MOST_BYTES
                while raw[inner] & 0xC0 == 0x80:
                    inner -= 1
            if inner >= cut:
                break
            starts.append(inner)
            at = inner
        if cut - at >= LEAST_BYTES and cut < size:
            starts.append(cut)
            at = cut
    return [*starts, size]


def chunks(body: bytes) -> tuple[list[int], list[int]]:
    """Cuts, and the signed 64-bit digest of each chunk; 0 for white space alone."""
    from xxhash import xxh3_64_intdigest

    at = cuts(body)
    digests = []
    for start, stop in zip(at, at[1:]):
        piece = body[start:stop].strip()
        value = xxh3_64_intdigest(piece) if piece else 0
        digests.append(value - (1 << 64) if value >> 63 else value)
    return at, digests


def chunk_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): each digest of a document once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                ids, found = [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if text and doc_id is not None:
                        own = set(chunks(text.encode())[1]) - {0}
                        ids.append(np.full(len(own), doc_id, np.int64))
                        found.append(np.fromiter(own, np.int64, len(own)))
                if ids:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(ids)), pa.array(np.concatenate(found))], names=["doc_id", "digest"])

    return documents(docs).mapInArrow(run, StructType([field("doc_id", LONG), field("digest", LONG)]))


def foreign_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, owners): for documents with chunks that belong to others, map of digest to owner.

    The digests are reduced on the map side to the least and greatest
    document, so a chunk that very many documents share is one row per task.
    Only digests of two documents or more are joined back; the join has one
    row per digest on that side, and Spark splits a hot digest's other side.
    """
    rows = chunk_rows(docs)
    shared = (
        rows.groupBy("digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .where("owner < last").select("digest", "owner")
    )
    return (
        rows.join(shared.hint("shuffle_hash"), "digest").where("doc_id > owner")
        .groupBy("doc_id").agg(F.collect_list(F.struct("digest", "owner")).alias("owners"))
    )


def cut_text(text: str, owners: dict[int, int], least_words: int,
             least_chars: int = LEAST_CHARS) -> tuple[str, int, int, list[tuple[int, int]], list[int]]:
    """Kept text, number of chunks, chunks seen before, removed byte spans and the owners of these."""
    body = text.encode()
    at, digests = chunks(body)
    seen: set[int] = set()
    spans, lenders, repeated, run = [], set(), 0, []

    def close() -> None:
        if not run:
            return
        words = body[at[run[0]]: at[run[-1] + 1]].split()
        if len(words) >= least_words or len(b"".join(words).decode()) >= least_chars:
            spans.append((at[run[0]], at[run[-1] + 1]))
            lenders.update(owners[digests[k]] for k in run if digests[k] in owners)

    for k, digest in enumerate(digests):
        if digest and (digest in owners or digest in seen):
            repeated += 1
            run.append(k)
        else:
            close()
            run = []
        seen.add(digest)
    close()
    kept, last = [], 0
    for start, stop in spans:
        kept.append(body[last:start])
        last = stop
    kept.append(body[last:])
    return b"".join(kept).decode() if spans else text, len(digests), repeated, spans, sorted(lenders)


def dedup(docs: DataFrame, least_words: int = LEAST_WORDS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``.

    New columns: n_chunks, n_repeated_chunks, removed_bytes, first_doc_ids
    (the documents that keep the removed passages; a document's own id where
    it repeats itself is not listed).  Columns of these names are replaced.
    """
    added = [field("n_chunks", LONG), field("n_repeated_chunks", LONG), field("removed_bytes", LONG),
             field("first_doc_ids", ArrayType(LONG))]
    schema = with_columns(docs.schema, added)
    names = [f.name for f in schema.fields if f.name not in {a.name for a in added}]
    owners = foreign_chunks(docs).select(F.col("doc_id").alias("__doc"), F.col("owners").alias("__owners"))
    joined = docs.select(*(f"`{n}`" for n in names)).join(
        owners, F.col("doc_id").cast("long") == F.col("__doc"), "left").drop("__doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                texts, rest = [], []
                for doc_id, text, own in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(),
                                             part.column("__owners").to_pylist()):
                    known = {pair["digest"]: pair["owner"] for pair in own or ()}
                    if text and doc_id is not None:
                        text, count, repeated, spans, lenders = cut_text(text, known, least_words, least_chars)
                        rest.append((count, repeated, sum(b - a for a, b in spans), lenders))
                    else:
                        rest.append((0, 0, 0, []))
                    texts.append(text)
                columns = [pa.array(texts, pa.string()) if n == "text" else part.column(n) for n in names]
                columns += [pa.array([r[k] for r in rest], pa.int64()) for k in range(3)]
                columns.append(pa.array([r[3] for r in rest], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names + [a.name for a in added])

    return joined.mapInArrow(run, schema)
