"""Files of any size, read by the executors in blocks: digest, bytes and records in one pass.

Spark lists the files and spreads them over tasks by size; the task opens the
file by its address and holds one block of it. A digest is serial, so a file
is one task's work; many files are many tasks'. Where pyarrow does not know
the store of an address, Spark itself reads the content, below 2 GB a file.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 1 << 20
#: Marks of CSV text that are Python objects at one time.
MARKS = 1 << 14

_QUOTE, _COMMA, _LINE, _RETURN = 34, 44, 10, 13
# a byte of CSV text stands at a field's start, in plain or quoted text, or after a quote in quoted text
_START, _PLAIN, _QUOTED, _CLOSED = range(4)


def _pairs(block: np.ndarray, marks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Place and byte of every mark, a bounded number of them at a time."""
    for start in range(0, len(marks), MARKS):
        some = marks[start:start + MARKS]
        yield from zip(some.tolist(), block[some].tolist())


class CsvRecords:
    """Logical records of CSV text that comes in blocks, the header among them.

    A line break inside quotes ends no record, and a quote counts only where a
    field begins. The last record may lack its line break.
    """

    def __init__(self) -> None:
        self.count, self.state, self.after_return, self.unfinished = 0, _START, False, False

    def add(self, block: np.ndarray) -> None:
        if not len(block):
            return
        is_line, is_return = block == _LINE, block == _RETURN
        if self.state in (_START, _PLAIN) and not (block == _QUOTE).any():
            pairs = int((is_line[1:] & is_return[:-1]).sum()) + bool(is_line[0] and self.after_return)
            self.count += int(is_line.sum()) + int(is_return.sum()) - pairs
            ended = is_line[-1] or is_return[-1]
            self.state = _START if ended or block[-1] == _COMMA else _PLAIN
        else:
            ended = self._slowly(block, np.flatnonzero(is_line | is_return | (block == _QUOTE) | (block == _COMMA)))
        self.after_return = bool(is_return[-1])
        self.unfinished = not ended

    def _slowly(self, block: np.ndarray, marks: np.ndarray) -> bool:
        state, last = self.state, -1
        after_return = self.after_return
        for at, byte in _pairs(block, marks):
            if at > last + 1:  # other bytes before the mark
                state, after_return = _QUOTED if state == _QUOTED else _PLAIN, False
            if byte == _QUOTE:
                state = {_START: _QUOTED, _PLAIN: _PLAIN, _QUOTED: _CLOSED, _CLOSED: _QUOTED}[state]
            elif state != _QUOTED:
                if byte == _COMMA:
                    state = _START
                else:
                    self.count += not (byte == _LINE and after_return)
                    state = _START
            after_return = byte == _RETURN and state == _START
            last = at
        if last < len(block) - 1:
            state = _QUOTED if state == _QUOTED else _PLAIN
        self.state = state
        return last == len(block) - 1 and state == _START and block[last] != _COMMA

    def total(self) -> int:
        return self.count + self.unfinished


def listed(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of the files at or below ``path``; no content is read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .load(path).select("path", "length")
    )


def _known_store(path: str) -> bool:
    from pyarrow import fs

    if "://" not in path:
        return True
    try:
        fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        return False
    return True


def digests(
    spark: SparkSession, path: str, glob: str = "*", copy_to: str | None = None, block_bytes: int = BLOCK_BYTES,
    with_records: bool = True,
) -> DataFrame:
    """Path, name, bytes, SHA-256 and logical CSV records of every file; with ``copy_to`` each is copied there under its name.

    A repeated task writes the same bytes again. Files that are copied need
    different names. Without ``with_records`` their number is null: files that
    are no CSV have none, and Spark counts the rows of its own.
    """
    by_address = _known_store(path)
    source = listed(spark, path, glob) if by_address else (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .load(path).select("path", "length", "content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import quote

        from pyarrow import fs

        def store(address: str):
            if "://" in address and not address.startswith("file:"):
                return fs.FileSystem.from_uri(quote(address, safe="/:?=&@%"))
            return fs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")

        def blocks(batch: pa.RecordBatch, row: int, address: str):
            if by_address:
                files, name = store(address)
                with files.open_input_stream(name) as stream:
                    while block := stream.read(block_bytes):
                        yield block
            else:
                content = batch.column(2)[row].as_buffer()
                for start in range(0, content.size, block_bytes):
                    yield content.slice(start, min(block_bytes, content.size - start)).to_pybytes()

        for batch in batches:
            for row in range(batch.num_rows):
                address = batch.column(0)[row].as_py()
                name = address.rpartition("/")[2]
                digest, size, records, out = hashlib.sha256(), 0, CsvRecords(), None
                if copy_to is not None:
                    files, target = store(f"{copy_to}/{name}")
                    files.create_dir(target.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(target)
                try:
                    for block in blocks(batch, row, address):
                        digest.update(block)
                        size += len(block)
                        if with_records:
                            records.add(np.frombuffer(block, np.uint8))
                        if out is not None:
                            out.write(block)
                finally:
                    if out is not None:
                        out.close()
                yield pa.RecordBatch.from_pydict({
                    "path": [address], "name": [name], "file_bytes": pa.array([size], pa.int64()),
                    "checksum_sha256": [digest.hexdigest()], "records": pa.array([records.total() if with_records else None], pa.int64())})

    return source.mapInArrow(run, "path string, name string, file_bytes long, checksum_sha256 string, records long")


def partition_totals() -> list[Column]:
    """Files, bytes and checksum of a group of ``digests`` rows.

    One file has its own SHA-256; several have that of their digests in order.
    """
    digest = F.col("checksum_sha256")
    return [
        F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("file_bytes"),
        F.when(F.count(F.lit(1)) == 1, F.max(digest)).when(
            F.count(F.lit(1)) > 1, F.sha2(F.array_join(F.array_sort(F.collect_list(digest)), "\n"), 256)).alias("checksum_sha256"),
    ]
