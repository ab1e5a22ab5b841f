"""Ranked lexical search: the best documents of each item, by an exact dual-tree search.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII;
only A-Z is lower-cased.  All scores are whole numbers: the weight of a term
by its document frequency, times its impact in a document by its count and the
document's length.

Items are the stated queries.  They are taken in blocks of at most BLOCK_ITEMS
items and, but for a longer item alone, BLOCK_TERMS terms, so what a task is
sent is bounded; each block reads all documents.  A first pass reduces each
document to the counts of the block's terms and is stored.  Counts of
documents, terms and document frequencies come from that table.

The search runs in tasks over slices of these vectors.  A slice is ordered by
the documents' rarest terms and has a hierarchy of nodes with the greatest
impact of each term below; the items have one with the greatest weight of each
term.  The product of two nodes bounds every score between them; where it is
below the weakest kth score among the node's items, the whole batch of pairs
is left out.  What remains is scored exactly.  The kth scores begin at those
of a share of the documents, found by the same search: they are lower bounds
of the true ones, so nothing is lost.  Tasks give their best k per item; a
window ranks them.

Null text, or text without terms, counts nowhere and is found by no item.
Items without terms have no rows.  Each row of either table is a document or
item of its own, whatever its id; null ids come last among equal scores.
Texts of any length are counted in pieces of bounded size.  Empty tables give
no rows.  Other columns may have any name.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from llm.common import LONG, SLICE, documents, field, materialise, need

BEST = 10
BLOCK_ITEMS, BLOCK_TERMS = 256, 16_384
#: Documents of a slice, and of the nodes of its hierarchy; items of the nodes of theirs.
SLICE_DOCS, DOC_NODES, ITEM_NODES = 4096, (256, 16), (64, 8)
#: One document in so many gives the first kth scores.
SEED_SHARE = 64
PIECE = 1 << 20

_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def term_lists(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time."""
    body = text.encode().translate(_TERMS) if text else b""
    start = 0
    while start < len(body):
        stop = body.find(b" ", start + PIECE)
        stop = len(body) if stop < 0 else stop
        yield body[start:stop].split()
        start = stop


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, number of terms, and the counts of the terms in ``vocabulary`` (by place) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: k for k, term in enumerate(vocabulary)}
        known = place.keys()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                sizes, terms, counts, ends = [], [], [], [0]
                for text in part.column(1).to_pylist():
                    n, found = 0, Counter()
                    for some in term_lists(text):
                        n += len(some)
                        found.update(filter(known.__contains__, some))
                    sizes.append(n)
                    terms.extend(map(place.__getitem__, found))
                    counts.extend(found.values())
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], names=["doc_id", "n", "terms", "counts"])

    schema = StructType([field("doc_id", LONG), field("n", LONG), field("terms", ArrayType(IntegerType())), field("counts", ArrayType(LONG))])
    return documents(docs).mapInArrow(run, schema)


@dataclass
class Block:
    """Items of one pass: their number in the whole table, id and terms."""

    items: list[tuple[int, int | None, set[bytes]]]

    def vocabulary(self) -> list[bytes]:
        return sorted(set(chain.from_iterable(terms for _, _, terms in self.items)))


def blocks(items: DataFrame) -> Iterator[Block]:
    """The items in order of their ids, a block at a time; the driver holds one block and a partition's rows."""
    here, terms = [], set()
    rows = need(items, item_id="long", text="string").orderBy("item_id", "text")
    for number, row in enumerate(rows.toLocalIterator()):
        own = set(chain.from_iterable(term_lists(row.text)))
        if not own:
            continue
        if here and (len(here) >= BLOCK_ITEMS or len(terms | own) > BLOCK_TERMS):
            yield Block(here)
            here, terms = [], set()
        here.append((number, row.item_id, own))
        terms |= own
    if here:
        yield Block(here)


@dataclass
class Model:
    """What a task needs to score: ``rank`` orders the vocabulary by falling weight."""

    n_docs: int
    n_terms: int
    rank: np.ndarray
    weights: np.ndarray  # rows (term by rank, item, weight)
    numbers: np.ndarray
    item_ids: list[int | None]
    best: int


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def fitted(block: Block, vocabulary: list[bytes], stored: DataFrame, n_docs: int, n_terms: int, best: int) -> Model:
    """Weights of the block's terms; at most one row per term of the block reaches the driver."""
    df = np.zeros(len(vocabulary), np.int64)
    for row in stored.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row.term] = row["count"]
    by_weight = np.lexsort((np.arange(len(df)), df))
    rank = np.empty(len(df), np.int64)
    rank[by_weight] = np.arange(len(df))
    place = {term: k for k, term in enumerate(vocabulary)}
    # items that share their rarest terms lie together
    items = sorted(block.items, key=lambda item: (sorted(int(rank[place[t]]) for t in item[2]), item[0]))
    weights = [(int(rank[place[term]]), column, weight(n_docs, int(df[place[term]])))
               for column, (_, _, terms) in enumerate(items) for term in terms]
    return Model(n_docs, n_terms, rank, np.array(weights, np.int64), np.array([i[0] for i in items], np.int64), [i[1] for i in items], best)


def impacts(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of each count of a term in a document of that length."""
    if int(lengths.max(initial=0)) * 90 * n_docs >= 1 << 63:
        m = np.array([10 + 90 * int(n) * n_docs // n_terms for n in lengths], np.int64)
    else:
        m = 10 + 90 * lengths * n_docs // n_terms
    return 1_000_000_000 * counts // (1000 * counts + 8 * m)


def maxima(owner: np.ndarray, term: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each owner's part, and the terms with their greatest values; owners are 0, 1, ..."""
    order = np.lexsort((term, owner))
    owner, term, value = owner[order], term[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])]))
    greatest = np.maximum.reduceat(value, new)
    starts = np.searchsorted(owner[new], np.arange(int(owner[-1]) + 2))
    return starts, term[new], greatest


class DualTree:
    """Exact search of slices of documents for all items of a model."""

    def __init__(self, model: Model, least: np.ndarray) -> None:
        self.model = model
        self.heaps: list[list] = [[] for _ in model.item_ids]
        self.kth = np.maximum(least, 1)  # a score of 0 is no find
        # item levels, greatest nodes first: weights of each node and the node of each child
        self.levels = []
        below = np.zeros((len(model.rank), len(model.item_ids)), np.int64)
        below[model.weights[:, 0], model.weights[:, 1]] = model.weights[:, 2]
        width = 1
        for size in reversed(ITEM_NODES):
            starts = np.arange(0, below.shape[1], size // width)
            above = np.maximum.reduceat(below, starts, axis=1)
            self.levels.insert(0, (below, np.arange(below.shape[1]) // (size // width)))
            below, width = above, size
        self.top = below
        self.weakest: list[np.ndarray] | None = None
        self.scored = self.pairs = 0

    def _weakest(self, level: int) -> np.ndarray:
        """The weakest kth score below each item node of a level; the scores have changed when it is None."""
        if self.weakest is None:
            self.weakest = [self.kth]
            for _, parent in reversed(self.levels):
                starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
                self.weakest.insert(0, np.minimum.reduceat(self.weakest[0], starts))
        return self.weakest[level]

    def add(self, doc_ids: list, lengths: np.ndarray, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        """Searches one slice of documents with at least one term each."""
        n = len(doc_ids)
        self.pairs += n * len(self.heaps)
        owner = np.repeat(np.arange(n), np.diff(starts))
        rank = self.model.rank[terms]
        value = impacts(counts, np.repeat(lengths, np.diff(starts)), self.model.n_docs, self.model.n_terms)
        in_order = np.lexsort((rank, owner))
        rank, value = rank[in_order], value[in_order]
        rarest = rank[starts[:-1]]
        second = rank[np.minimum(starts[:-1] + 1, starts[1:] - 1)]
        order = np.lexsort((second, rarest))
        position = np.empty(n, np.int64)
        position[order] = np.arange(n)
        place = position[owner]
        levels = [maxima(place // size, rank, value) for size in DOC_NODES] + [maxima(place, rank, value)]
        for node in range(len(levels[0][0]) - 1):
            self._visit(levels, 0, node, None, doc_ids, order)

    def _visit(self, levels: list, level: int, node: int, items: np.ndarray | None, doc_ids: list, order: np.ndarray) -> None:
        """One node of documents against the item nodes of its level in ``items`` (None: all)."""
        starts, terms, values = levels[level]
        part = slice(starts[node], starts[node + 1])
        weights = self.top if level == 0 else self.levels[level - 1][0]
        rows = weights[terms[part]] if items is None else weights[terms[part][:, None], items]
        bound = values[part] @ rows
        weakest = self._weakest(level)
        passed = np.flatnonzero(bound >= (weakest if items is None else weakest[items]))
        if not len(passed):
            return
        alive = passed if items is None else items[passed]
        if level == len(levels) - 1:
            self.scored += len(bound)
            doc_id = doc_ids[order[node]]
            for item, score in zip(alive.tolist(), bound[passed].tolist()):
                self._found(item, score, doc_id)
            return
        keep = np.zeros(weights.shape[1], bool)
        keep[alive] = True
        children = np.flatnonzero(keep[self.levels[level][1]])
        step = DOC_NODES[level] // DOC_NODES[level + 1] if level + 1 < len(DOC_NODES) else DOC_NODES[level]
        for child in range(node * step, min((node + 1) * step, len(levels[level + 1][0]) - 1)):
            self._visit(levels, level + 1, child, children, doc_ids, order)

    def _found(self, item: int, score: int, doc_id: int | None) -> None:
        heap, entry = self.heaps[item], (score, doc_id is not None, -(doc_id or 0))
        if len(heap) < self.model.best:
            heapq.heappush(heap, entry)
        else:
            heapq.heappushpop(heap, entry)
        if len(heap) == self.model.best:
            if heap[0][0] > self.kth[item]:
                self.kth[item], self.weakest = heap[0][0], None

    def result(self) -> pa.RecordBatch:
        rows = [(int(self.model.numbers[k]), self.model.item_ids[k], -least if known else None, score)
                for k, heap in enumerate(self.heaps) for score, known, least in heap]
        return pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in rows], pa.int64()) for k in range(4)], names=["number", "item_id", "doc_id", "score"])


def _searched(stored: DataFrame, model: Model, least: np.ndarray) -> DataFrame:
    """Each task's best documents of every item: number, item_id, doc_id, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = DualTree(model, least.copy())
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_DOCS):
                part = batch.slice(start, SLICE_DOCS)
                if part.num_rows:
                    sizes = np.concatenate([[0], np.cumsum(part.column(2).value_lengths().to_numpy())])
                    tree.add(part.column(0).to_pylist(), part.column(1).to_numpy(), sizes,
                             part.column(2).flatten().to_numpy().astype(np.int64), part.column(3).flatten().to_numpy())
        yield tree.result()

    return stored.where(F.size("terms") > 0).mapInArrow(run, "number long, item_id long, doc_id long, score long")


def _ranked(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of each item with a score above 0."""
    spark, result = docs.sparkSession, None
    totals = None
    for block in blocks(items):
        vocabulary = block.vocabulary()
        stored = materialise(vectors(docs, vocabulary), "term-vectors")
        if totals is None:
            totals = stored.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not totals.docs:
            break
        model = fitted(block, vocabulary, stored, totals.docs, totals.terms, best)
        none = np.zeros(len(model.item_ids), np.int64)
        seed = stored.where(F.pmod(F.xxhash64("doc_id"), F.lit(SEED_SHARE)) == 0)
        first = {row.number: row.score for row in  # at most one row per item of the block
                 _ranked(_searched(seed, model, none), best).where(F.col("rank") == best).select("number", "score").collect()}
        least = np.array([first.get(number, 0) for number in model.numbers.tolist()], np.int64)
        found = _ranked(_searched(stored, model, least), best)
        result = found if result is None else result.union(found)
    if result is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


#: The same rows as DuckDB SQL, on views ``documents`` and ``benchmark``.
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents),
words AS (
  SELECT row_id, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
lengths AS (SELECT row_id, doc_id, count(*)::BIGINT AS n FROM words GROUP BY ALL),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
items AS (SELECT row_number() OVER () AS number, item_id, text FROM benchmark),
asked AS (
  SELECT DISTINCT number, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items),
counts AS (SELECT row_id, term, count(*)::BIGINT AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, totals GROUP BY term, docs),
scores AS (
  SELECT number, item_id, doc_id, row_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (row_id), totals
  GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
