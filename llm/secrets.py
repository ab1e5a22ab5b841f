"""Secret scans: fixed patterns, and strings that a primed compressor cannot shorten.

The patterns find assignments, access keys and long hexadecimal strings.  The
method adds candidates that no pattern reports: strings of LEAST_CHARS or more
token characters near a sensitive word.  A candidate is measured by its
marginal bytes: how much longer the zstandard frame of its surroundings gets
when the candidate follows them.  The compressor is primed with the corpus's
most frequent identifiers, so names, words and what the code around repeats
cost a few bytes, while keys cost about as many as they are long.  Candidates
that cost at least NOVEL_SHARE of their length are reported as ``novel``.

The dictionary holds at most DICTIONARY_BYTES of identifiers, the most
frequent of all documents; their counts cover every document, added up in
tasks before they are shuffled.

Null text counts as empty and has no span.  Texts of any length are scanned
whole, and each row on its own, whatever its ``doc_id``.  An empty table gives
no rows.  Other columns may have any name.  Positions count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from llm.common import LONG, SLICE, STRING, apply_rows, documents, field, materialise

# fixed values: kinds in the order of equal starts, and their patterns
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

#: Words that make a context sensitive, not inside longer words.
SENSITIVE = re.compile(
    r"(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secrets?|tokens?|(?:api|access|private|secret|signing|encryption|account)[_ -]?keys?"
    r"|credentials?|authorization|bearer|client[_-]?secret|connection[_-]?string|webhook|session[_-]?id)(?![a-z])", re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]+")
#: Characters after a sensitive word in which a candidate begins, and of the surroundings on both sides.
REACH, AROUND = 80, 256
LEAST_CHARS, MOST_CHARS = 16, 4096
NOVEL_SHARE = 0.62
#: Bytes of the identifier dictionary; its identifiers' lengths and how often they occur at least.
DICTIONARY_BYTES, IDENTIFIER_CHARS, LEAST_COUNT = 1 << 16, (4, 20), 3
#: Different words that a task counts before it passes them on.
COUNTED_WORDS = 200_000

_IDENTIFIER = bytes(b if chr(b).isalnum() and b < 128 or b == 95 or b >= 128 else 32 for b in range(256))


def identifier_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the identifiers of all texts."""
    low, high = IDENTIFIER_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = [w for w in counts if low <= len(w) <= high and not w[:1].isdigit()]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([counts[w] for w in words], pa.int64())], names=["word", "n"])

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                for text in batch.column(0).slice(start, SLICE).to_pylist():
                    counts.update(text.encode().translate(_IDENTIFIER).split() if text else ())
                    if len(counts) >= COUNTED_WORDS:
                        yield flush()
                        counts.clear()
        yield flush()

    return documents(docs).select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def identifier_dictionary(docs: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """The most frequent identifiers, the most frequent last, as zstandard wants it."""
    most = size // (IDENTIFIER_CHARS[0] + 1)
    counts = materialise(identifier_counts(docs).where(F.col("n") >= LEAST_COUNT), "identifiers")
    # a histogram of the counts, in 64ths of a doubling, tells which words can be among the most frequent
    level = F.floor(F.log2("n") * 64)
    least, above = 0, 0
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # at most 64 * 64 rows
        least, above = row.level, above + row["count"]
        if above >= most:
            break
    rows = counts.where(level >= least).orderBy(F.desc("n"), "word").limit(most).collect()  # bounded by size
    words, used = [], 0
    for row in rows:
        used += len(row.word) + 1
        if used > size:
            break
        words.append(bytes(row.word))
    return b" ".join(reversed(words))


class Novelty:
    """Marginal bytes of a string after its surroundings, given the dictionary."""

    LEVEL = 6

    def __init__(self, dictionary: bytes) -> None:
        import zstandard

        options = {"level": self.LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        if len(dictionary) >= 8:
            primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=self.LEVEL)
            options["dict_data"] = primed
        self.compress = zstandard.ZstdCompressor(**options).compress

    def marginal(self, around: str, candidate: str) -> int:
        body = around.encode()
        return len(self.compress(body + b"\n" + candidate.encode())) - len(self.compress(body + b"\n"))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, in order."""
    found = []
    folded = text.lower()
    if "pass" in folded or "secret" in folded or "token" in folded or "api" in folded:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _plain(word: str) -> bool:
    """A word, number or dotted or dashed chain of such: no candidate."""
    parts = [part for part in re.split(r"[^A-Za-z0-9]+", word) if part]
    return all(part.isdigit() or part[1:] == part[1:].lower() and not any(c.isdigit() for c in part) or part.isupper() and part.isalpha()
               for part in parts)


def novel_spans(text: str, novelty: Novelty, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates in sensitive contexts that overlap no known span and do not compress."""
    found, done = [], 0
    for word in SENSITIVE.finditer(text):
        for match in CANDIDATE.finditer(text, max(word.end(), done)):
            start, end = match.span()
            if start > word.end() + REACH:
                break
            done = end
            if end - start < LEAST_CHARS or any(s < end and start < e for s, _, e in known) or _plain(match[0]):
                continue
            around = text[max(0, start - AROUND): start] + text[end: end + AROUND]
            # a very long string is measured in pieces
            cost = sum(novelty.marginal(around, text[at: min(end, at + MOST_CHARS)]) for at in range(start, end, MOST_CHARS))
            if cost >= NOVEL_SHARE * (end - start):
                found.append((start, 3, end))
    return found


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


ADDED = [*(field(name, LONG) for name in ("n_assign", "n_access", "n_hex")),
         field("base_sha256", STRING), field("spans", STRING), field("n_novel", LONG)]


def scan(docs: DataFrame, dictionary: bytes) -> DataFrame:
    """All columns of ``docs`` with counts, the digest of the base spans and all spans of ``text``."""
    def make():
        novelty = Novelty(dictionary)

        def compute(texts: list) -> list:
            rows = []
            for text in texts:
                base = base_spans(text) if text else []
                more = novel_spans(text, novelty, base) if text else []
                rows.append((*(sum(kind == k for _, kind, _ in base) for k in range(3)),
                             hashlib.sha256(written(base).encode()).hexdigest(), written(base + more), len(more)))
            return rows

        return compute

    return apply_rows(docs, ADDED, make)


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_novel of every row."""
    rows = documents(docs)
    return scan(rows, identifier_dictionary(rows)).drop("text")
