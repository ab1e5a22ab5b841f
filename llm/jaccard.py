"""Set similarity join of documents on word shingles, by grouped prefixes.

A document is the set of its distinct 5-word shingles (A-Z lower-cased; with
fewer words, the whole sequence).  Two documents link when their Jaccard
similarity is ``percent`` / 100 or more.

Shingles are ordered by how common they are, rare ones first.  Documents that
link share a shingle among the first n - ceil(t n) + 1 of the n of each.
Documents with the same prefix and size form one group, and only the group's
prefix is posted.  Group pairs that meet at a shingle must pass the size and
the position filter; their members are then verified on whole sets.

What keeps groups of many copies from all pairs: equal sets are one class
from the start, and classes that are connected already are not compared
again.  First each posting list meets a few centres, and of all centres a
document meets the few that look most alike are verified.  Then, with the
components that gives, the lists whose members lie in different components
meet in full.  Short lists give pairs.  Long ones give none: their classes are
gathered by the component that is most frequent in the list and compared in
blocks of whole sets, those outside the component against all, and a block
gives only links that join what its earlier ones have not.  So rows grow with
the classes and not with their pairs, and no link between different components
is left out.

Before whole sets are sent to a pair, BINS bins of each set are compared, each
with a byte of its least hash.  Of two sets of similarity s a bin that either
uses agrees with probability s, so pairs with fewer agreeing bins than
``least_agreeing`` allows are left out: for a pair that links this has a
probability below SAMPLE_LOSS, whatever ``percent`` and the number of used
bins, as a collision of hashes has.

Results: one row per row of the input with n_shingles and component_id, the
least doc_id that links reach.  Null text, or text without words, has the
empty set and links with nothing.  Rows with a null ``doc_id`` have a null
component_id and link with nothing.  Rows with the same ``doc_id`` are one
node.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructType

from llm.common import LONG, SLICE, documents, field, materialise
from llm.components import components

SHINGLE, PERCENT = 5, 75
#: Counters of the frequency sketch and bits of the candidate filter, whatever the input's size.
SKETCH_BITS, FILTER_BITS = 20, 24
#: Bins of the sample of a set, and how many look-alikes a document is first verified with, of how many centres a token has.
BINS, STAR_PAIRS, CENTRES = 64, 3, 8
#: A pair that links is left out by its sample with a probability below this.
SAMPLE_LOSS = 1e-12
#: Classes of a list, or of a group, that are compared as pairs; and shingles of a block of those of longer ones.
PAIRED, BLOCK_SHINGLES = 64, 200_000
CACHE_WORDS = 200_000
#: Characters of text that are hashed together.
TOGETHER = 1 << 19

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M2
    return h ^ (h >> np.uint64(29))


class Shingler(dict):
    """Distinct shingle hashes (sorted, unsigned 64 bits) of texts; remembers words."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        value = xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 100:
            self[word] = value
        return value

    def shingles(self, text: str | None, size: int = SHINGLE) -> np.ndarray:
        return np.unique(self._rolled([text], size)[0])

    def many(self, texts: list[str | None], size: int = SHINGLE) -> Iterator[np.ndarray]:
        """Shingle hashes of each text in order, with repeats; texts are hashed together, some at a time."""
        some, chars = [], 0
        for text in texts:
            some.append(text)
            chars += len(text or "")
            if chars >= TOGETHER:
                yield from self._rolled(some, size)
                some, chars = [], 0
        if some:
            yield from self._rolled(some, size)

    def _rolled(self, texts: list[str | None], size: int) -> list[np.ndarray]:
        # bytes.lower() and bytes.split() know ASCII only
        cut = [text.encode().lower().split() if text else [] for text in texts]
        ends = np.cumsum([0] + [len(words) for words in cut])
        hashes = np.fromiter((self[word] for words in cut for word in words), np.uint64, int(ends[-1]))
        rolled = self._fold(hashes, size) if len(hashes) >= size else hashes
        return [rolled[start: stop - size + 1] if stop - start >= size else self._fold(hashes[start:stop], stop - start)
                for start, stop in zip(ends[:-1].tolist(), ends[1:].tolist())]

    @staticmethod
    def _fold(hashes: np.ndarray, width: int) -> np.ndarray:
        if not width:
            return hashes
        found = np.full(len(hashes) - width + 1, width, np.uint64)
        for k in range(width):
            found = _mix((found ^ hashes[k: k + len(found)]) * _M1)
        return found


def _texts(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            yield tuple(part.column(c).to_pylist() for c in columns)


def common_classes(docs: DataFrame) -> np.ndarray:
    """For each sketch counter how common its shingles are, in quarters of a doubling.

    Every task counts the shingles of its documents into 2^SKETCH_BITS
    counters; tasks' counters are summed slice by slice in a stream.  The
    result, a byte per counter, is of fixed size.  It only decides the order
    of shingles, so collisions cost time and no result.
    """
    width = 1 << 12

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total, waiting, size = Shingler(), np.zeros(1 << SKETCH_BITS, np.uint32), [], 0

        def counted(found: list[np.ndarray]) -> np.ndarray:
            at = (np.concatenate([*found, np.zeros(0, np.uint64)]) & np.uint64(len(total) - 1)).astype(np.int64)
            return np.bincount(at, minlength=len(total)).astype(np.uint32)

        for (texts,) in _texts(batches, 0):
            for found in shingler.many(texts):
                waiting.append(found)
                size += len(found)
                if size >= len(total):
                    total += counted(waiting)
                    waiting, size = [], 0
        total += counted(waiting)
        for k in range(0, len(total), width):
            if total[k: k + width].any():
                yield pa.RecordBatch.from_pydict({"part": pa.array([k // width], pa.int64()), "counts": [total[k: k + width].tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for parts, counts in _texts(batches, 0, 1):
            for part, packed in zip(parts, counts):
                own = np.frombuffer(packed, np.uint32).astype(np.uint64)
                sums[part] = sums[part] + own if part in sums else own
        for part, own in sums.items():
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()),
                "counts": [np.minimum(4 * np.log2(own + 1.0), 255).astype(np.uint8).tobytes()]})

    schema = "part long, counts binary"
    rows = documents(docs).select("text").mapInArrow(count, schema).repartition("part").mapInArrow(add, schema).collect()
    classes = np.zeros(1 << SKETCH_BITS, np.uint8)
    for row in rows:
        classes[row.part * width: (row.part + 1) * width] = np.frombuffer(row["counts"], np.uint8)
    return classes


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


def ordered(shingles: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Rare ones first; ties by the hash, the same in all documents."""
    return shingles[np.argsort(classes[(shingles & np.uint64(len(classes) - 1)).astype(np.int64)], kind="stable")]


_BIN_STARTS = (np.arange(BINS, dtype=np.uint64) << np.uint64(58)).astype(np.uint64)


def sample(shingles: np.ndarray) -> bytes:
    """For each of BINS equal ranges of hashes a byte of its least one, and 0 if it has none."""
    at = np.searchsorted(shingles, _BIN_STARTS)
    ends = np.append(at[1:], len(shingles))
    out = np.zeros(BINS, np.uint8)
    has = at < ends
    out[has] = (shingles[at[has]] & np.uint64(0xFF)) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def signatures(docs: DataFrame, classes: np.ndarray, percent: int) -> DataFrame:
    """doc_id, n, the set's digest (k1, k2) and sample, the group's digest g and prefix of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest, xxh3_128_intdigest

        shingler = Shingler()
        for ids, texts in _texts(batches, 0, 1):
            rows, prefixes, samples = [], [], []
            for doc_id, found in zip(ids, map(np.unique, shingler.many(texts))):
                samples.append(sample(found))
                first = ordered(found, classes)[: prefix_length(len(found), percent)] if len(found) else found
                key = xxh3_128_intdigest(found.tobytes())
                rows.append((doc_id, len(found), _signed(key >> 64), _signed(key & (1 << 64) - 1),
                             _signed(xxh3_64_intdigest(first.tobytes(), len(found)))))
                prefixes.append(first.view(np.int64))
            ends = np.cumsum([0] + [len(p) for p in prefixes]).astype(np.int32)
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*prefixes, np.zeros(0, np.int64)]))))
            columns.append(pa.array(samples, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "k1", "k2", "g", "prefix", "sample"])

    fields = [field(name, LONG) for name in ("doc_id", "n", "k1", "k2", "g")]
    return documents(docs).mapInArrow(run, StructType([*fields, field("prefix", ArrayType(LONG)), field("sample", BinaryType())]))


def shared_postings(postings: DataFrame) -> DataFrame:
    """Postings whose token has two or more, found in a stream of sorted rows."""
    names = postings.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row so far, and whether it is known to share its token
        last, known = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column(0).to_numpy(zero_copy_only=False)
            same = token[1:] == token[:-1]
            keep = np.zeros(len(token), bool)
            keep[1:] |= same
            keep[:-1] |= same
            if last is not None and last.column(0)[0].as_py() == token[0]:
                keep[0] = True
                if not known:
                    yield last
            if keep[:-1].any():
                yield batch.slice(0, len(token) - 1).filter(pa.array(keep[:-1]))
            # the last row waits for the next batch unless its token is shared already
            last, known = batch.slice(len(token) - 1), bool(keep[-1])
            if known:
                yield last

    return postings.repartition("token").sortWithinPartitions("token").mapInArrow(run, postings.select(*names).schema)


def _passes(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Size and position filter of a pair that shares a token at places pa_ and pb."""
    bound = F.least(na - pa_, nb - pb)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (bound * (100 + percent) >= (na + nb) * percent)


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and whole shingle set of the documents in ``ids``, and of a few others.

    A bitmap of 2^FILTER_BITS bits of hashed ids picks the documents in the
    scan, so texts are not shuffled; the exact join follows on the sets.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    words = (
        ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .toArrow()  # at most 2^FILTER_BITS / 64 rows
    )
    bitmap = np.zeros((1 << FILTER_BITS) >> 6, np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            at = batch.column(2).to_numpy()
            chosen = batch.filter(pa.array((bitmap[at >> 6] >> (at & 63)) & 1 == 1))
            for keys, texts in _texts(iter([chosen]), 0, 1):
                found = [np.unique(hashes).view(np.int64) for hashes in shingler.many(texts)]
                ends = np.cumsum([0] + [len(f) for f in found]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))],
                    names=["doc_id", "shingles"])

    rows = documents(docs).where("doc_id is not null").withColumn("bit", bit)
    return rows.mapInArrow(run, StructType([field("doc_id", LONG), field("shingles", ArrayType(LONG))]))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are as similar as asked."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_sb"))
    both = F.size(F.array_intersect("_sa", "_sb"))
    return pairs.join(right, "b").join(left, "a").where(
        both * (100 + percent) >= (F.size("_sa") + F.size("_sb")) * percent).select("a", "b")


def _ids(*columns: DataFrame) -> DataFrame:
    """The distinct values of one-column tables as doc_id."""
    return reduce(DataFrame.union, (df.toDF("doc_id") for df in columns)).distinct()


def join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    classes = common_classes(docs)
    signed = materialise(signatures(docs, classes, percent), "signatures")
    real, rows = signed.where("n > 0 and doc_id is not null"), signed.drop("prefix", "sample")
    # equal sets are one class, classes of equal prefix and size one group; both named by their least doc_id
    sets = real.groupBy("k1", "k2", "n", "g").agg(F.min("doc_id").alias("rep"))
    heads = sets.groupBy("g", "n").agg(F.min("rep").alias("head"), F.count("*").alias("members"))
    members = materialise(sets.join(heads, ["g", "n"]).select("head", "rep", "members", "n"), "members")
    grouped = real.groupBy("g", "n").agg(F.min("doc_id").alias("head"), F.first("prefix").alias("prefix"))
    postings = grouped.select(F.posexplode("prefix").alias("pos", "token"), "n", "head").select(
        "token", "head", F.col("n").cast("int").alias("n"), "pos")
    shared = materialise(shared_postings(postings), "postings")
    samples = real.select("doc_id", "sample")

    inside = members.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b"))
    pairs = materialise(_stars(shared, samples, percent).union(inside), "pairs")
    made = materialise(shingle_sets(docs, _ids(pairs.select("a"), pairs.select("b"))), "sets")
    found = materialise(verified(pairs, made, percent), "links")
    labels = materialise(components(found), "labels")

    own, rows_apart = _apart(shared, members, labels)
    pairs = materialise(_alike(_between(rows_apart, own, percent), samples, percent).select("a", "b"), "pairs")
    crowds = materialise(_crowds(rows_apart, own), "crowds")
    made = materialise(shingle_sets(docs, _ids(pairs.select("a"), pairs.select("b"), crowds.select("rep"))), "sets")
    found = materialise(found.union(verified(pairs, made, percent)).union(_crowd_links(crowds, made, percent)), "links")
    labels = materialise(components(found), "labels")

    near = sets.select("k1", "k2", "n", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "k1", "k2", "n", F.coalesce("component", "rep").alias("component"))
    return rows.join(near, ["k1", "k2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _size_class(n: Column, percent: int) -> Column:
    """Sizes of one class pass the size filter with each other."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) * 1.0001).cast("int")


def least_agreeing(percent: int, loss: float = SAMPLE_LOSS) -> list[int]:
    """By the number of used bins, the agreeing ones below which two sets of that similarity lie with a probability under ``loss``."""
    t = percent / 100
    found = []
    for used in range(BINS + 1):
        below, least = 0.0, 0
        while least < used:
            below += math.comb(used, least) * t ** least * (1 - t) ** (used - least)
            if below >= loss:
                break
            least += 1
        found.append(least)
    return found


def _alike(pairs: DataFrame, samples: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose samples agree as often as a pair that links has to, with the number of agreeing bins."""
    both = pairs.join(samples.select(F.col("doc_id").alias("a"), F.col("sample").alias("_sa")), "a").join(
        samples.select(F.col("doc_id").alias("b"), F.col("sample").alias("_sb")), "b")
    bound = np.array(least_agreeing(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BINS) for k in (2, 3))
                used = ((x > 0) | (y > 0)).sum(axis=1)
                agree = ((x == y) & (x > 0)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(agree, pa.int64())],
                                                 names=["a", "b", "agree"]).filter(pa.array(agree >= bound[used]))

    # repeated ids have more than one sample: the pair may be kept twice
    return both.select("a", "b", "_sa", "_sb").mapInArrow(run, "a long, b long, agree long")


def _stars(shared: DataFrame, samples: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a posting with the centre of its token and size class: for every b the STAR_PAIRS most alike.

    Each token picks CENTRES of its own, so a document meets up to that many
    others for each shared token, however large its group.
    """
    rows = shared.withColumn("size_class", _size_class(F.col("n"), percent))
    key = ["token", "size_class"]
    picked = Window.partitionBy(*key).orderBy(F.xxhash64("head", "token"), "head")
    centres = rows.withColumn("place", F.row_number().over(picked)).where(F.col("place") <= CENTRES).select(
        *key, F.col("head").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"))
    met = (
        rows.join(centres, key).where(F.col("head") != F.col("a"))
        .where(_passes(F.col("na"), F.col("pa"), F.col("n"), F.col("pos"), percent))
        .select("a", F.col("head").alias("b")).distinct()
    )
    best = Window.partitionBy("b").orderBy(F.desc("agree"), "a")
    return _alike(met, samples, percent).withColumn("place", F.row_number().over(best)).where(F.col("place") <= STAR_PAIRS).select("a", "b")


def _apart(shared: DataFrame, members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes (head, rep, members, n, c) with their components, and the postings of tokens with more than one component.

    A posting has the least and greatest component (lo, hi) over all members
    of its group, as members need not have linked with their head, and how
    many classes its token has.
    """
    own = materialise(members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "head", "rep", "members", "n", F.coalesce("component", "rep").alias("c")), "classes")
    spans = own.where("members > 1 or c <> head").groupBy("head").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"), F.first("members").alias("members"))
    rows = shared.join(spans, "head", "left").withColumns({
        "lo": F.coalesce("lo", "head"), "hi": F.coalesce("hi", "head"), "members": F.coalesce("members", F.lit(1))})
    mixed = rows.groupBy("token").agg(
        F.min("lo").alias("least"), F.max("hi").alias("most"), F.sum("members").alias("classes")).where("least < most")
    return own, materialise(rows.join(mixed.select("token", "classes"), "token"), "apart")


def _between(rows: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """Every pair of classes of a short list, or of a small group, that may link and lies in different components."""
    short = rows.where(F.col("classes") <= PAIRED)
    left, right = (
        short.select("token", *(F.col(c).alias(f"{name}{side}") for c, name in
                                (("head", "h"), ("n", "n"), ("pos", "p"), ("lo", "lo"), ("hi", "hi"))))
        for side in "ab")
    heads = (
        left.join(right, "token")
        .where((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ha") < F.col("hb"))))
        .where("least(loa, lob) < greatest(hia, hib)")
        .where(_passes(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), percent))
        .select("ha", "hb").distinct()
    )
    one = own.select(F.col("head").alias("ha"), F.col("rep").alias("a"), F.col("c").alias("c1"))
    two = own.select(F.col("head").alias("hb"), F.col("rep").alias("b"), F.col("c").alias("c2"))
    across = heads.join(one, "ha").join(two, "hb").where("c1 <> c2").select("a", "b")
    many = own.where((F.col("members") > 1) & (F.col("members") <= PAIRED)).select("head", "rep", "c")
    inside = many.select("head", F.col("rep").alias("a"), F.col("c").alias("c1")).join(
        many.select("head", F.col("rep").alias("b"), F.col("c").alias("c2")), "head").where("a < b and c1 <> c2").select("a", "b")
    return across.union(inside).distinct()


def _crowds(rows: DataFrame, own: DataFrame) -> DataFrame:
    """Blocks of the classes of long lists and large groups: crowd, i, j, probe, rep, c.

    A crowd is what shares a long list with its most frequent component.  Its
    classes are dealt to blocks j by a hash, for BLOCK_SHINGLES shingles each;
    those outside the crowd's most frequent component are probes, dealt to
    parts i, and every part of the probes meets every block.
    """
    long = rows.where(F.col("classes") > PAIRED)
    most = F.struct("weight", F.negative("lo").alias("order"))
    hubs = long.groupBy("token", "lo").agg(F.sum("members").alias("weight")).groupBy("token").agg(
        F.negative(F.max(most)["order"]).alias("crowd"))
    lists = long.join(hubs, "token").select("crowd", "head").distinct().join(own, "head")
    groups = own.where(F.col("members") > PAIRED).join(
        own.groupBy("head").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("head"), "head", "left_semi")
    classes = lists.select("crowd", "rep", "n", "c").union(
        groups.select(F.col("head").alias("crowd"), "rep", "n", "c")).distinct()
    parts = classes.groupBy("crowd", "c").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")).groupBy("crowd").agg(
        F.max_by("c", F.struct("size", "c")).alias("main"), F.sum("shingles").alias("all"),
        (F.sum("shingles") - F.max_by("shingles", F.struct("size", "c"))).alias("outside")).where("outside > 0")
    dealt = classes.join(parts, "crowd").withColumns({
        "blocks": F.ceil(F.col("all") / BLOCK_SHINGLES).cast("int"),
        "parts": F.ceil(F.col("outside") / (8 * BLOCK_SHINGLES)).cast("int")})
    hashed = F.xxhash64("rep")
    population = dealt.select(
        "crowd", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.pmod(hashed, F.col("blocks")).cast("int").alias("j"),
        F.lit(0).alias("probe"), "rep", "c")
    probes = dealt.where("c <> main").select(
        "crowd", F.pmod(hashed, F.col("parts")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(1).alias("probe"), "rep", "c")
    return population.union(probes)


def _crowd_links(crowds: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between probes and blocks; of each block only those that join what was apart."""
    key = ["crowd", "i", "j"]
    rows = crowds.join(sets.withColumnRenamed("doc_id", "rep"), "rep").select(*key, "probe", "rep", "c", "shingles")
    ordered = rows.repartition(*key).sortWithinPartitions(*key, "probe")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block, probes = None, None, []

        def links() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in probes], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(6))))
            for row, (crowd, i, j, probe, rep, c) in enumerate(keys):
                if (crowd, i, j) != current:
                    current, block = (crowd, i, j), Block(percent)
                own = batch.column(6)[row].values.to_numpy(zero_copy_only=False)
                if probe:
                    probes.extend((rep, other) for other in block.meet(rep, c, own))
                else:
                    block.add(rep, c, own)
            if probes:
                yield links()
                probes = []

    return ordered.mapInArrow(run, "a long, b long")


class Block:
    """Whole sets of some classes, and what their components have been joined to."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.reps: list[int] = []
        self.components: list[int] = []
        self.sets: list[np.ndarray] = []
        self.tokens: np.ndarray | None = None
        self.joined: dict[int, int] = {}

    def add(self, rep: int, c: int, own: np.ndarray) -> None:
        self.reps.append(rep)
        self.components.append(c)
        self.sets.append(own)

    def _index(self) -> None:
        """Tokens in order, each with the class that has it."""
        self.sizes = np.array([len(own) for own in self.sets])
        tokens = np.concatenate([*self.sets, np.zeros(0, np.int64)])
        owner = np.repeat(np.arange(len(self.sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner = tokens[order], owner[order]
        self.sets = []

    def _root(self, c: int) -> int:
        while self.joined.get(c, c) != c:
            c = self.joined[c]
        return c

    def meet(self, rep: int, c: int, own: np.ndarray) -> list[int]:
        """Classes that link with this one and whose component has not been joined with its own; now they are."""
        if self.tokens is None:
            self._index()
        starts, stops = np.searchsorted(self.tokens, own), np.searchsorted(self.tokens, own, "right")
        shared = np.flatnonzero(stops > starts)
        places = [np.arange(a, b) for a, b in zip(starts[shared].tolist(), stops[shared].tolist())]
        if not places:
            return []
        both = np.bincount(self.owner[np.concatenate(places)], minlength=len(self.sizes))
        found = []
        for k in np.flatnonzero(both * (100 + self.percent) >= (self.sizes + len(own)) * self.percent).tolist():
            here, there = self._root(c), self._root(self.components[k])
            if here != there:
                self.joined[max(here, there)] = min(here, there)
                found.append(self.reps[k])
        return found
