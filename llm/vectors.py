"""Near-duplicate vectors by product quantisation, exact in its results.

Unit vectors are assigned to coarse lists, and the residual to the list's
centre is coded by one of 256 codes in each of ``parts`` subspaces.  A query
looks up its distance to every member of a list in tables (asymmetric: the
query is not coded), keeps members whose table distance can lie within the
radius, and computes the cosine of these in double precision.

Nothing is lost on the way.  A vector within the radius of a query lies in a
list whose boundary is no further from the query than the radius, so these
lists are probed, all of them.  A member's table distance differs from its
true one by no more than its own coding error, which is stored and added.

Only vectors of equal, not null labels and equal length are compared.
Vectors that are null, zero, or hold null or non-finite numbers link with
nothing.  Equal vectors are searched once and counted by their number; they
link with each other.  Every input row gives a row; rows with null ``vec_id``
link with nothing and have a null component.  Rows with the same ``vec_id``
are one node.  An empty table gives no rows.

The codebooks are fitted on at most ``most_rows`` vectors, those with the least
hash; all vectors are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.common import materialise, need
from llm.components import components

LEAST_COSINE = 0.98
MOST_ROWS, LIST_ROWS, MOST_LISTS = 16_384, 4_096, 1_024
PARTS, CODES = 8, 256
#: Members of a list searched together, and queries that one task runs against them.
BLOCK, QUERIES = 8_192, 65_536
BATCH = 256


@dataclass(frozen=True)
class Codebook:
    centres: np.ndarray  # lists x width
    codes: list[np.ndarray]  # for each subspace: codes x its width
    edges: list[int]  # where the subspaces begin, and the width

    def pieces(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [vectors[:, a:b] for a, b in zip(self.edges, self.edges[1:])]

    def code(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the length of what they leave out."""
        chosen, left = [], np.zeros(len(residuals))
        for piece, book in zip(self.pieces(residuals), self.codes):
            best = nearest(piece, book)
            chosen.append(best.astype(np.uint8))
            left += ((piece - book[best]) ** 2).sum(axis=1)
        return np.stack(chosen, axis=1), np.sqrt(left)

    def tables(self, residuals: np.ndarray) -> list[np.ndarray]:
        """For each subspace the squared distances of the queries to all codes."""
        return [squared(piece, book) for piece, book in zip(self.pieces(residuals), self.codes)]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(axis=1)[:, None] - 2 * x @ y.T + (y ** 2).sum(axis=1)[None, :], 0)


def nearest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return squared(x, y).argmin(axis=1)


def means(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly picked points; empty clusters keep their centre."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(points, centres)
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        centres[size > 0] = total[size > 0] / size[size > 0][:, None]
    return centres


def fit(sample: np.ndarray, lists: int, parts: int = PARTS) -> Codebook:
    width = sample.shape[1]
    centres = means(sample, lists)
    residuals = sample - centres[nearest(sample, centres)]
    edges = np.unique(np.linspace(0, width, min(parts, width) + 1).astype(int)).tolist()
    return Codebook(centres, [means(residuals[:, a:b], CODES) for a, b in zip(edges, edges[1:])], edges)


def unit(vector: list | None, width: int) -> np.ndarray | None:
    """The vector at length 1, padded to ``width``; None if it has no direction."""
    if vector is None or any(x is None for x in vector):
        return None
    x = np.asarray(vector, float)
    if not len(x) or not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()
    out = np.zeros(width)
    out[: len(x)] = x / np.sqrt((x * x).sum())
    return out


def probes(vectors: np.ndarray, centres: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home list of each vector, and which lists may hold a vector within ``radius``.

    A neighbour of a vector v that lives in list c is on c's side of the plane
    between c and v's home h, so the plane is within the radius of v.
    """
    far = squared(vectors, centres)
    home = far.argmin(axis=1)
    apart = np.sqrt(squared(centres, centres))[home]
    excess = far - far[np.arange(len(far)), home][:, None]
    return home, excess <= 2 * apart * radius + 1e-9


def near_duplicates(vectors: DataFrame, least_cosine: float = LEAST_COSINE, most_rows: int = MOST_ROWS,
                    block: int = BLOCK, queries: int = QUERIES, list_rows: int = LIST_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = need(vectors, vec_id="long", label="long", embedding="array<double>")
    usable = rows.where("vec_id is not null and label is not null and embedding is not null")
    # equal vectors are one row; Spark reduces them in each task first
    same = materialise(
        usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    size = same.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    result = rows.join(_counts_and_components(same, size.n, size.width or 0, least_cosine, most_rows, block, queries,
                                                    list_rows),
                       ["label", "embedding"], "left")
    linked = F.col("vec_id").isNotNull() & F.col("rep").isNotNull()
    component = F.when(linked, F.coalesce("component", "rep")).otherwise(F.col("vec_id"))
    return result.select(
        "vec_id", F.when(linked, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _counts_and_components(same: DataFrame, n: int, width: int, least_cosine: float, most_rows: int,
                           block: int, queries: int, list_rows: int) -> DataFrame:
    """label, embedding, rep, copies, links and component of every vector that has a direction."""
    spark = same.sparkSession
    picked = same.orderBy(F.xxhash64("embedding"), "rep").limit(most_rows).select("embedding").collect() if width else []
    sample = [u for row in picked if (u := unit(row.embedding, width)) is not None]
    if not sample:
        return same.where("false").select("*", F.lit(0).cast("long").alias("links"), F.lit(None).cast("long").alias("component"))
    book = fit(np.stack(sample), max(1, min(MOST_LISTS, n // list_rows, len(sample) // 4)))
    radius = float(np.sqrt(max(0.0, 2 - 2 * least_cosine)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                label, rep, copies = (part.column(c).to_numpy() for c in (0, 2, 3))
                raw = part.column(1).to_pylist()
                found = [unit(v, width) for v in raw]
                good = np.array([u is not None for u in found], bool)
                lengths = np.array([len(v) for v in raw], np.int64)[good]
                if not good.any():
                    continue
                units = np.stack([u for u in found if u is not None])
                label, rep, copies = label[good], rep[good], copies[good]
                home, near = probes(units, book.centres, radius)
                codes, left = book.code(units - book.centres[home])
                q, where = np.nonzero(near)
                at = np.concatenate([np.arange(len(units)), q])
                list_of = np.concatenate([home, where])
                is_query = np.concatenate([np.zeros(len(units), bool), np.ones(len(q), bool)])
                yield pa.RecordBatch.from_pydict({
                    "label": pa.array(label[at]), "length": pa.array(lengths[at]), "list": pa.array(list_of.astype(np.int64)),
                    "query": pa.array(is_query), "rep": pa.array(rep[at]), "copies": pa.array(copies[at]),
                    "vector": pa.array([units[i].tobytes() for i in at], pa.binary()),
                    "codes": pa.array([None if is_q else codes[i].tobytes() for i, is_q in zip(at, is_query)], pa.binary()),
                    "error": pa.array(left[at]),
                })

    schema = ("label long, length long, list long, query boolean, rep long, copies long, vector binary, codes binary, error double")
    placed = same.select("label", "embedding", "rep", "copies").mapInArrow(assign, schema)
    key = ["label", "length", "list"]
    sizes = placed.groupBy(*key).agg(F.sum(F.when(F.col("query"), 0).otherwise(1)).alias("members"),
                                     F.sum(F.when(F.col("query"), 1).otherwise(0)).alias("asking")).where("members > 0")
    # a large list is cut into blocks of members and of queries; every query meets every block
    cut = sizes.select(*key, F.ceil(F.col("members") / block).cast("int").alias("blocks"),
                       F.ceil(F.col("asking") / queries).cast("int").alias("rounds"))
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("query"), F.col("rounds")).otherwise(F.col("blocks"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("query"), F.col("blocks")).otherwise(F.col("rounds")) - 1))
    dealt = placed.join(cut, key).select(*placed.columns, own.alias("own"), other.alias("other")).select(
        *placed.columns, F.when(F.col("query"), F.col("other")).otherwise(F.col("own")).alias("block"),
        F.when(F.col("query"), F.col("own")).otherwise(F.col("other")).alias("round"))
    group = [*key, "block", "round"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "a", "b"]
        current, members = None, None

        def rows(kind: str, a, b) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.string()), pa.array(a), pa.array(b)], names=names)

        def close() -> Iterator[pa.RecordBatch]:
            if members is not None and members.linked.any():
                moved = np.flatnonzero(members.parent != np.arange(len(members.parent)))
                yield rows("link", members.rep[moved], members.rep[members.parent[moved]])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1, 2, 9, 10)])
            asks = batch.column(3).to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0) | (asks[1:] != asks[:-1])) + 1
            for start, stop in zip([0, *turns], [*turns, batch.num_rows]):
                if stop == start:
                    continue
                here = tuple(keys[:, start])
                if here != current:
                    yield from close()
                    current, members = here, None
                part = batch.slice(start, stop - start)
                if not asks[start]:
                    members = Members.of(part, members)
                elif members is not None:
                    for at in range(0, part.num_rows, BATCH):
                        some = part.slice(at, BATCH)
                        asking = some.column(4).to_numpy()
                        vectors = np.frombuffer(b"".join(some.column(6).to_pylist())).reshape(some.num_rows, -1)
                        q, x = members.matches(vectors, asking, book, int(here[2]), radius, least_cosine)
                        if len(q):
                            yield rows("count", asking, np.bincount(q, members.copies[x], len(asking)).astype(np.int64))
                            first, roots = members.unite(q, x)
                            yield rows("link", asking[first], members.rep[roots])
        yield from close()

    found = materialise(
        dealt.repartition(*group).sortWithinPartitions(*group, "query").mapInArrow(search, "kind string, a long, b long"), "vector-links")
    counts = found.where("kind = 'count' and b > 0").groupBy(F.col("a").alias("_rep")).agg(F.sum("b").alias("links"))
    parts = components(found.where("kind = 'link'")).select(F.col("node").alias("_node"), "component")
    directed = placed.where("not query").select("label", F.col("rep").alias("_known")).distinct()
    return (
        same.join(directed.withColumnRenamed("label", "_label"), (F.col("rep") == F.col("_known")) & (F.col("label") == F.col("_label")))
        .join(counts, F.col("rep") == F.col("_rep"), "left").join(parts, F.col("rep") == F.col("_node"), "left")
        .select("label", "embedding", "rep", "copies", "links", "component"))


class Members:
    """The members of one block, and which of them are linked so far."""

    def __init__(self, rep, copies, vectors, codes, error) -> None:
        self.rep, self.copies, self.vectors, self.codes, self.error = rep, copies, vectors, codes, error
        self.parent, self.linked = np.arange(len(rep)), np.zeros(len(rep), bool)

    @classmethod
    def of(cls, part: pa.RecordBatch, before: Members | None) -> Members:
        n = part.num_rows
        own = [part.column(4).to_numpy(), part.column(5).to_numpy(),
               np.frombuffer(b"".join(part.column(6).to_pylist())).reshape(n, -1),
               np.frombuffer(b"".join(part.column(7).to_pylist()), np.uint8).reshape(n, -1), part.column(8).to_numpy()]
        if before is not None:  # the block's rows came in two batches
            own = [np.concatenate([old, new]) for old, new in zip(
                (before.rep, before.copies, before.vectors, before.codes, before.error), own)]
        return cls(*own)

    def matches(self, vectors: np.ndarray, asking: np.ndarray, book: Codebook, number: int, radius: float,
                least_cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, member) of the asked cosine, found by table distances and checked."""
        distance = np.zeros((len(vectors), len(self.rep)))
        for k, table in enumerate(book.tables(vectors - book.centres[number])):
            distance += table[:, self.codes[:, k]]
        q, x = np.nonzero(np.sqrt(distance) <= radius + self.error[None, :] + 1e-6)
        other = asking[q] != self.rep[x]
        q, x = q[other], x[other]
        hit = np.zeros(len(q), bool)
        for start in range(0, len(q), 65_536):
            some = slice(start, start + 65_536)
            hit[some] = np.einsum("ij,ij->i", vectors[q[some]], self.vectors[x[some]]) >= least_cosine
        return q[hit], x[hit]

    def unite(self, q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Puts all members that a query links under one root; gives queries and their roots."""
        self.linked[x] = True
        while True:
            roots = self.parent[x]
            low = np.full(q.max() + 1, len(self.parent))
            np.minimum.at(low, q, roots)
            differ = roots != low[q]
            if not differ.any():
                break
            np.minimum.at(self.parent, roots[differ], low[q][differ])
            while (jumped := self.parent[self.parent]).tolist() != self.parent.tolist():
                self.parent = jumped
        first, at = np.unique(q, return_index=True)
        return first, self.parent[x[at]]
