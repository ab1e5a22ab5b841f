"""Token ids in files: frequency-ranked, in bytes of variable length.

Ids are replaced by their rank in the corpus, the most frequent id first, so
that most take one byte.  A file holds, for consecutive documents in ascending
``doc_id`` order: the document ids, their token counts, control bytes (the
byte length less one of four ranks, two bits each) and, apart from these, the
data bytes.  Readers find lengths by a table of 256 control bytes and gather
all values with numpy.

Each text is encoded once, and its ids are stored; counting, ranking and
writing read these.  Special tokens that stand in a text get their ids, as the
library gives them.

Null text counts as empty, so the document has the end id alone.  Null
``doc_id`` comes first; all such rows lie in one range of the order.  Rows with the same ``doc_id`` are all written, in any
order.  An empty table gives no file and no row.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from llm.common import LONG, SLICE, STRING, documents, field, materialise, scratch_path

MAGIC = b"FRB1"
#: Tokens after which a task starts its next file; a longer document has a file of its own.
FILE_TOKENS = 2_000_000
#: Parts, and pieces, in each of two generations that a Python worker remembers.
CACHE_PARTS, CACHE_PIECES = 100_000, 800_000

#: Byte lengths of the four values that a control byte describes.
LENGTHS = np.array([[(c >> shift & 3) + 1 for shift in (0, 2, 4, 6)] for c in range(256)], np.int64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype(np.uint32)
    sizes = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = sizes - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(4):
        has = sizes > k
        data[starts[has] + k] = values[has] >> np.uint32(8 * k)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` values: lengths by table lookup, then one gather per byte position."""
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    source = np.frombuffer(data, np.uint8)
    starts = np.cumsum(sizes) - sizes
    values = np.zeros(count, np.uint32)
    for k in range(4):
        has = np.flatnonzero(sizes > k)
        values[has] |= source[starts[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


class Packed:
    """Values packed as they come, some at a time; whole control bytes but for the last."""

    SOME = 1 << 17

    def __init__(self) -> None:
        self.control, self.data, self.waiting, self.size = bytearray(), bytearray(), [], 0
        self.unpacked = 0

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.size += len(values)
        self.unpacked += len(values)
        if self.unpacked >= self.SOME:
            self._pack(4)

    def _pack(self, multiple: int) -> None:
        values = np.concatenate([*self.waiting, np.zeros(0, np.uint32)])
        whole = len(values) - len(values) % multiple
        for start in range(0, whole, self.SOME):
            control, data = pack(values[start: min(whole, start + self.SOME)])
            self.control += control
            self.data += data
        self.waiting = [values[whole:]]
        self.unpacked = len(values) - whole

    def file(self, ids: list[int | None], counts: list[int]) -> bytes:
        self._pack(1)
        head = struct.pack("<4sQQQQ", MAGIC, len(ids), self.size, len(self.control), len(self.data))
        known = np.array([value is not None for value in ids], np.uint8)
        return b"".join([head, np.array([value or 0 for value in ids], "<i8").tobytes(), known.tobytes(),
                         np.array(counts, "<u8").tobytes(), self.control, self.data])


def unpack_some(control: bytes, data: bytes, count: int, some: int = 1 << 17) -> np.ndarray:
    """As ``unpack``, with the work arrays of ``some`` values only (a multiple of four)."""
    out, at = np.zeros(count, np.uint32), 0
    for start in range(0, count, some):
        n = min(some, count - start)
        codes = control[start // 4: (start + n + 3) // 4]
        size = int(LENGTHS[np.frombuffer(codes, np.uint8)].ravel()[:n].sum())
        out[start: start + n] = unpack(codes, data[at: at + size], n)
        at += size
    return out


def read_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, token counts and ranks of one file."""
    magic, n, tokens, controls, size = struct.unpack_from("<4sQQQQ", content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = struct.calcsize("<4sQQQQ")
    ids = np.frombuffer(content, "<i8", n, at)
    known = np.frombuffer(content, np.uint8, n, at + 8 * n)
    counts = np.frombuffer(content, "<u8", n, at + 9 * n).astype(np.int64)
    at += 17 * n
    ranks = unpack_some(content[at: at + controls], content[at + controls: at + controls + size], tokens)
    return [int(i) if k else None for i, k in zip(ids, known)], counts, ranks


def byte_signs() -> list[str]:
    """The sign that stands for each byte in vocabularies of bytes: itself where it can be seen, else the next one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(0x100 + hidden.index(b)) for b in range(256)]


class Memory(dict):
    """Values of two generations of keys: what is still asked for comes along when the older one is dropped."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most, self.older = most, {}

    def unknown(self, keys: set[str]) -> set[str]:
        """The keys that have no value yet."""
        new = keys.difference(self)
        back = new.intersection(self.older)
        self.update((key, self.older[key]) for key in back)
        return new - back

    def turn(self) -> None:
        """Starts a new generation if this one is full; only between texts."""
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()


class Pieces(Memory):
    """A memory that asks ``learn`` for a key when the key is first looked up."""

    def __init__(self, most: int, learn: Callable[[str], bytes]) -> None:
        super().__init__(most)
        self.learn = learn

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.learn(key)
        self[key] = found
        return found


class Words:
    """Ids of texts by the tokenizers library; remembers words.

    The vocabulary drops white space and never joins what stands on both
    sides of a space.  Text of ASCII, composed Latin letters and common signs is
    cut by the vocabulary's own pattern, and the library's model encodes each
    new piece.  Of other texts, ASCII between spaces is; the parts beside it are encoded by the whole library, new ones together with a mark between
    them, as one call costs much more than one word; the mark's last character
    ends no other part's bytes.  Text with a special token, or with the mark,
    is the library's altogether.
    """

    MARK, TOGETHER, CHARS = "\ue000", 2_000, 1 << 20
    #: Letters that lower case keeps among them and that are composed already; signs that are no letters, numbers or spaces.
    LATIN, SIGNS = "À-ÖØ-öø-įı-ſ", "¡-©«-¬®-±´¶-¸»¿\u2010-\u2027\u2030-\u205e€"
    SIMPLE = re.compile(rf"[\x00-\x7f{LATIN}{SIGNS}]*")
    #: The pattern of the vocabulary, on lower case.
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-įı-ſ]+|[0-9]|[^ \t\n\v\f\ra-z0-9ß-öø-įı-ſ]+")

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self.parts, self.pieces = Memory(CACHE_PARTS), Pieces(CACHE_PIECES, self._piece)
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.whole = [self.MARK, *(token.content for token in self.tokenizer.get_added_tokens_decoder().values())]
        self.mark = self._ids(self.MARK)
        self.bytes = byte_signs()
        self.by_pieces = True
        self.by_pieces = self._cuts_as_pieces()

    @classmethod
    def of_worker(cls, definition: str) -> Words:
        """The words that this Python worker has learned in earlier tasks, of the same vocabulary.

        A task's own module state does not outlive it, so they are kept where
        the worker finds them again.
        """
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_words_of_worker", {})
        if definition not in kept:
            kept.clear()
            kept[definition] = cls(definition)
        return kept[definition]

    def _cuts_as_pieces(self) -> bool:
        """Whether the vocabulary is one whose ASCII text may be cut by PIECES: tried on every pair of characters."""
        signs = [chr(c) for c in range(1, 0x7F)]
        tried = [f"A{a}{b}z" for a in signs for b in signs] + ["it's", "x'll", "'re1", "Don'T", "..'s", "a\nb"]
        others = [chr(c) for c in range(0x80, 0x2100) if self.SIMPLE.fullmatch(chr(c))]
        tried += [f"{a}{c}{c}{b}" for c in others for a, b in (("a", "b"), ("é", "."), ("1", "É"), ("'", "s"), (" ", "-"))]
        whole = self.tokenizer.encode_batch_fast(tried, add_special_tokens=False)
        return self.encode(tried, 0) == [np.array([*found.ids, 0], self.kind).tobytes() for found in whole]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _piece(self, piece: str) -> bytes:
        if not piece.isprintable():
            return self._ids(piece).tobytes()
        signs = piece if piece.isascii() else "".join([self.bytes[b] for b in piece.encode()])
        return array("H" if self.kind == "<u2" else "I", [token.id for token in self.model.tokenize(signs)]).tobytes()

    def _learn_parts(self, parts: list[str]) -> None:
        for start in range(0, len(parts), self.TOGETHER):
            some = parts[start: start + self.TOGETHER]
            ids = self._ids(f" {self.MARK} ".join(some))
            hit = np.ones(max(0, len(ids) - len(self.mark) + 1), bool)
            for k, value in enumerate(self.mark):
                hit &= ids[k: k + len(hit)] == value
            ends = [*np.flatnonzero(hit).tolist(), len(ids)]
            if len(ends) != len(some):
                raise ValueError("the vocabulary does not keep the mark apart")
            at = 0
            for part, end in zip(some, ends):
                self.parts[part] = ids[at:end].tobytes()
                at = end + len(self.mark)

    def _runs(self, text: str) -> list[tuple[Memory, list[str]]]:
        """Pieces and parts of a text in order, each run with the memory that knows it."""
        cut = self.PIECES.findall
        if self.by_pieces and (text.isascii() or self.SIMPLE.fullmatch(text)):
            return [(self.pieces, cut(text.lower()))]
        words = text.split(" ")
        if not self.by_pieces:
            return [(self.parts, words)]
        return [(self.pieces, cut(" ".join(run).lower())) if plain else (self.parts, list(run))
                for plain, run in groupby(words, str.isascii)]

    def _some(self, texts: list[str]) -> list[bytes]:
        cut = [None if any(token in text for token in self.whole) else self._runs(text) for text in texts]
        self.pieces.turn()
        self.parts.turn()
        asked = set().union(*(keys for runs in cut for memory, keys in runs or () if memory is self.parts))
        self._learn_parts(list(self.parts.unknown(asked)))
        return [self._ids(text).tobytes() if runs is None else b"".join([b"".join(map(memory.__getitem__, keys)) for memory, keys in runs])
                for text, runs in zip(texts, cut)]

    def encode(self, texts: list[str | None], end: int) -> list[bytes]:
        """Packed ids (of ``kind``) of each text, with the end id; CHARS characters or so are held as words at once."""
        last = np.array([end], self.kind).tobytes()
        found: list[list[bytes]] = [[] for _ in texts]
        some, owners, size = [], [], 0

        def flush() -> None:
            for owner, packed in zip(owners, self._some(some)):
                found[owner].append(packed)

        for owner, text in enumerate(texts):
            start, text = 0, text or ""
            while start < len(text):
                stop = text.find(" ", start + self.CHARS) if len(text) - start > self.CHARS else len(text)
                stop = len(text) if stop < 0 else stop
                some.append(text[start:stop] if start or stop < len(text) else text)
                owners.append(owner)
                size += stop - start
                start = stop
                if size >= self.CHARS:
                    flush()
                    some, owners, size = [], [], 0
        flush()
        return [b"".join([*packed, last]) for packed in found]


def tokenised(docs: DataFrame, definition: str, end: int) -> DataFrame:
    """doc_id and packed ids of every row, stored: each text is encoded once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words.of_worker(definition)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words.encode(part.column(1).to_pylist(), end), pa.binary())], names=["doc_id", "ids"])

    path = scratch_path(docs.sparkSession, "token-ids")
    documents(docs).mapInArrow(run, "doc_id long, ids binary").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema("doc_id long, ids binary").parquet(path)


def token_counts(stored: DataFrame, kind: str) -> DataFrame:
    """(id, n) over all documents: each task adds up its own, then tasks are summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            packed = batch.column(0)
            if len(packed):
                # the values of a batch lie one after another
                ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset: packed.offset + len(packed) + 1]
                found = np.bincount(np.frombuffer(packed.buffers()[2], np.uint8)[ends[0]: ends[-1]].view(kind))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    return stored.select("ids").mapInArrow(run, StructType([field("id", LONG), field("n", LONG)])).groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, definition: str, end: int, folder: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the token files of ``docs`` below ``folder``; gives the manifest.

    A repeated or lost task writes files of other names, and only those of
    the attempt that Spark accepts get into the manifest.  The rank table has
    at most one row per id of the vocabulary and is stored beside the files.
    ``folder`` may be any address that pyarrow can open.
    """
    spark = docs.sparkSession
    kind = Words(definition).kind
    width = np.dtype(kind).itemsize
    stored = tokenised(docs, definition, end)
    counted = token_counts(stored, kind).orderBy(F.desc("n"), "id").collect()  # one row per vocabulary id
    order = np.array([row.id for row in counted], np.int64)
    rank_of = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    spark.createDataFrame([(int(i), k) for k, i in enumerate(order)], "id long, rank long").coalesce(1).write.parquet(f"{folder}/ranks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")
        task, number = TaskContext.get().partitionId(), 0
        ids, counts, packed = [], [], Packed()

        def flush() -> pa.RecordBatch:
            name = f"part-{task:06d}-{number:06d}-{uuid.uuid4().hex}.ids"
            files.create_dir(f"{root}/files", recursive=True)
            with files.open_output_stream(f"{root}/files/{name}") as out:
                out.write(packed.file(ids, counts))
            row = {"name": [name], "task": [task], "number": [number], "n_docs": [len(ids)], "n_tokens": [packed.size]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema(
                [("name", pa.string()), *((k, pa.int64()) for k in ("task", "number", "n_docs", "n_tokens"))]))

        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.column(1)[row].as_buffer()
                if ids and packed.size + own.size // width > file_tokens:
                    yield flush()
                    number, ids, counts, packed = number + 1, [], [], Packed()
                ids.append(batch.column(0)[row].as_py())
                counts.append(own.size // width)
                packed.add(rank_of[np.frombuffer(own, kind)])
        if ids:
            yield flush()

    schema = StructType([field("name", STRING), *(field(k, LONG) for k in ("task", "number", "n_docs", "n_tokens"))])
    ordered = stored.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return materialise(ordered.mapInArrow(run, schema), "token-manifest")


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the ids of each document, from the files that the manifest names."""
    table = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()  # one row per vocabulary id
    id_of = np.array([row.id for row in table], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                name = batch.column(0)[row].as_py().rpartition("/")[2]
                doc_ids, counts, ranks = read_file(batch.column(1)[row].as_buffer().to_pybytes())
                ids = id_of[ranks].astype("<u4")
                ends = np.cumsum(counts)
                for start in range(0, len(doc_ids), 4 * SLICE):
                    some = slice(start, start + 4 * SLICE)
                    pieces = [ids[e - c: e].tobytes() for e, c in zip(ends[some], counts[some])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * len(pieces), pa.string()), pa.array(doc_ids[some], pa.int64()),
                        pa.array(ends[some] - counts[some]), pa.array(counts[some]), pa.array(pieces, pa.binary()),
                    ], names=["name", "doc_id", "start", "n_tokens", "ids"])

    schema = "name string, doc_id long, start long, n_tokens long, ids binary"
    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    ).option("recursiveFileLookup", True).load(f"{folder}/files").select("path", "content")
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = manifest.select("name", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("_base"))
    return files.mapInArrow(run, schema).join(starts, "name").select(
        "doc_id", (F.col("start") + F.col("_base")).alias("start"), "n_tokens", "ids")


def digests(docs: DataFrame, definition: str, end: int = 1, folder: str | None = None) -> DataFrame:
    """Writes the files, reads them back and gives doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    manifest = write(docs, definition, end, folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(spark, folder, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


