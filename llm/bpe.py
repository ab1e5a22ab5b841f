"""Byte-level BPE: encode texts by the ranks of a vocabulary, and decode ids.

A text is cut into words by the split pattern.  Each distinct word of a task
is encoded once: its bytes are a list of pieces, and merges are folded over
the list, the adjacent pair with the lowest rank first, until no pair has a
rank.  Decoding concatenates the binary pieces of the ids.

Null text counts as empty; an empty text has no ids.  Rows, null and repeated
``doc_id`` included, are encoded one by one and keep their other columns; a
column that has the name of a new one is replaced.  Words of any length are
encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, BooleanType, StringType

from llm.common import LONG, apply_rows, documents, field

#: The words remembered by a task; the memory then starts anew.
CACHE_WORDS = 200_000

_TWO_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a vocabulary file: base64 token and rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def fold_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: the leftmost pair of lowest rank is merged first."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 64:
        return _fold_long(word, ranks)
    none = 1 << 60
    get = ranks.get
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [get(word[i:i + 2], none) for i in range(len(word) - 1)]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        k = pairs.index(least)
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
        del pairs[k]
        if k:
            pairs[k - 1] = get(parts[k - 1] + parts[k], none)
        if k < len(pairs):
            pairs[k] = get(parts[k] + parts[k + 1], none)
    return [ranks[part] for part in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap of pairs: n log n for words of any length."""
    size = len(word)
    end = list(range(1, size + 1))  # where the piece that starts here ends
    before = list(range(-1, size - 1))  # where the piece before starts
    alive = [True] * size
    heap = [(rank, i, i + 2) for i in range(size - 1) if (rank := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start] if alive[start] else size
        if not alive[start] or middle >= size or end[middle] != stop:
            continue  # one of the two pieces has changed since
        alive[middle] = False
        end[start] = stop
        if stop < size:
            before[stop] = start
            if (rank := ranks.get(word[start:end[stop]])) is not None:
                heapq.heappush(heap, (rank, start, end[stop]))
        if before[start] >= 0 and (rank := ranks.get(word[before[start]:stop])) is not None:
            heapq.heappush(heap, (rank, before[start], stop))
    ids, start = [], 0
    while start < size:
        ids.append(ranks[word[start:end[start]]])
        start = end[start]
    return ids


class Encoder(dict):
    """Ids of a text as little-endian unsigned 32-bit integers; remembers the parts between spaces.

    A single space between other characters always starts a word, so a text
    may be cut before it and the parts encoded apart.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        super().__init__()
        self.ranks, self.words = ranks, regex.compile(pattern)

    def __missing__(self, part: str) -> bytes:
        ids: list[int] = []
        for word in self.words.findall(part):
            ids += fold_merges(word.encode(), self.ranks)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(part) <= 100:
            self[part] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _TWO_SPACES.search(text):
            parts = _CUT.split(text)
        else:
            first, *rest = text.split(" ")
            parts = [first, *[" " + part for part in rest]]
        return b"".join(map(self.__getitem__, parts))


def decoder(ranks: dict[bytes, int]) -> Callable[[bytes], bytes]:
    """From packed ids to bytes: the pieces of the ids, one after the other."""
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    piece = pieces.__getitem__
    return lambda packed: b"".join(map(piece, struct.unpack(f"<{len(packed) // 4}I", packed)))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the packed ids of each whole text in column ``ids``."""
    def make():
        encoder = Encoder(ranks, pattern)
        return lambda texts: ((encoder.encode(value),) for value in texts)

    return apply_rows(docs, [field(ids, BinaryType())], make, text)


def decode(docs: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of each row's ids in column ``decoded``."""
    def make():
        text = decoder(ranks)
        return lambda packed: ((text(value or b""),) for value in packed)

    return apply_rows(docs, [field(decoded, BinaryType())], make, ids)


def encode_checked(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ids, n_tokens and round_trip (whether the ids decode to the text), in one pass."""
    def make():
        encoder, text_of = Encoder(ranks, pattern), decoder(ranks)

        def rows(values):
            for value in values:
                packed = encoder.encode(value)
                yield packed, len(packed) // 4, text_of(packed) == (value or "").encode()

        return rows

    added = [field("ids", BinaryType()), field("n_tokens", LONG), field("round_trip", BooleanType())]
    return apply_rows(docs, added, make, text)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per document the number of ids and SHA-256 of ids and of the decoded bytes.

    One pass: ids are encoded, decoded and digested in the task that has them.
    """
    def make():
        encoder, text = Encoder(ranks, pattern), decoder(ranks)

        def rows(values):
            for value in values:
                packed = encoder.encode(value)
                yield len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(text(packed)).hexdigest()

        return rows

    added = [field("n_tokens", LONG), field("ids_sha256", StringType()), field("decoded_sha256", StringType())]
    return apply_rows(documents(docs), added, make, keep=["doc_id"])
