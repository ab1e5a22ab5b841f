"""Conversation structure repair: damage, faults, and the cheapest edits by a run-length DP.

``damaged`` spoils a table of turns by a checksum of its keys, so a repair can
be tested at any size.  ``repair`` counts the faults of each conversation and
finds the cheapest edits that give role initials ``(s?(ua)+)?``.

A row is a symbol: its role (system, user, assistant, other) and whether it
must go, is truncated or is fine.  Four states say what has been built so far:
nothing, s, ...u, ...ua.  One symbol is a 4 x 4 min-plus matrix, which also
holds the inserts before the row.  Equal consecutive symbols are one run; a
run of n moves the cost to go by the matrices of the binary digits of n, whose
powers each worker computes once.  Each edit leads to one state only, so the
least letter that stays cheapest, row by row, gives the cheapest audit that
comes first.  Choices inside runs are unrolled by halves, and remembered by
(symbol, size, state, cost to go).

Equal rows of one turn travel as one row with a count, and rows are dealt by
ranges of (conversation, turn), so a conversation of very many rows is spread
over tasks.  A conversation that lies inside one task and fits a piece is
repaired there.  All others are stored in pieces of bounded size; one pass
then reads their runs, and after these their texts one piece at a time.  A
task so holds a few bytes per row of one conversation, as its audit does, and
never its texts.

Null roles and texts count as one space.  Null turns come first.  Rows of the
same turn come by role and text; equal ones after the first are duplicates.
Rows with a null ``conv_id`` are one conversation.  Texts of any length pass
whole.  A conversation without rows has zeros, an empty audit and the hash of
nothing.  An empty table gives no rows.  Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from llm.common import LONG, SLICE, SPACE, STRING, field, materialise, need

#: Rows and bytes of text of one stored piece of a conversation.
PIECE_ROWS, PIECE_BYTES = 1024, 1 << 22

# fixed values: edits and their costs
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
COST_TRUNCATED = 5
LEGAL = {"su", "ua", "au"}

# states: nothing yet, s, ...u, ...ua; the role that each waits for, and where that leads
STATES = range(4)
OWED_ROLE = ("user", "user", "assistant", "user")
OWED_STATE = (2, 2, 3, 2)
ACCEPTED = (0, 3)
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FINE, TRUNCATED, MUST_GO = range(3)
#: The symbol of a row that has to be deleted, whatever its role.
GONE = 8
NEVER = 1 << 60


def role_kind(role: str) -> int:
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1], OTHER)


def symbol(kind: int, fault: int) -> int:
    return GONE if fault == MUST_GO else 2 * kind + fault


def kept_state(state: int, kind: int) -> int | None:
    """The state after a kept row of that role, or None where it may not stand."""
    if kind == SYSTEM:
        return 1 if state == 0 else None
    wanted = ASSISTANT if state == 2 else USER
    return OWED_STATE[state] if kind == wanted else None


def choices(of: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of one row in ASCII order, without inserts."""
    found = [(DELETE, COST[DELETE], state)]
    if of != GONE:
        more = COST_TRUNCATED if of % 2 == TRUNCATED else 0
        after = kept_state(state, of // 2)
        if after is not None:
            found.append((KEEP, COST[KEEP] + more, after))
        found.append((REROLE, COST[REROLE] + more, OWED_STATE[state]))
    return found


Matrix = list[list[int]]


def product(a: Matrix, b: Matrix) -> Matrix:
    return [[min(a[p][r] + b[r][q] for r in STATES) for q in STATES] for p in STATES]


def applied(a: Matrix, after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(a[p][q] + after[q] for q in STATES) for p in STATES)


def _inserts() -> Matrix:
    cost = [[0 if p == q else NEVER for q in STATES] for p in STATES]
    for p in STATES:
        state, spent = p, 0
        for _ in STATES:
            state, spent = OWED_STATE[state], spent + COST[INSERT]
            cost[p][state] = min(cost[p][state], spent)
    return cost


class Repairer:
    """Cheapest edits of run-length coded symbols; keeps matrix powers and unrolled blocks."""

    REMEMBERED_POWER = 10  # blocks of up to 2^10 rows

    def __init__(self) -> None:
        self.inserts = _inserts()
        self.powers: dict[int, list[Matrix]] = {}
        self.blocks: dict[tuple, tuple[str, int]] = {}
        self.end = tuple(min(self.inserts[p][q] for q in ACCEPTED) for p in STATES)

    def power(self, of: int, k: int) -> Matrix:
        """The min-plus matrix of 2^k rows of a symbol."""
        known = self.powers.setdefault(of, [])
        if not known:
            one = [[NEVER] * 4 for _ in STATES]
            for p in STATES:
                for _, cost, q in choices(of, p):
                    one[p][q] = min(one[p][q], cost)
            known.append(product(self.inserts, one))
        while len(known) <= k:
            known.append(product(known[-1], known[-1]))
        return known[k]

    def before(self, of: int, n: int, after: tuple[int, ...]) -> tuple[int, ...]:
        """Cost to go before n rows of a symbol."""
        for k in range(n.bit_length()):
            if n >> k & 1:
                after = applied(self.power(of, k), after)
        return after

    def audit(self, runs: list[tuple[int, int]]) -> tuple[int, str]:
        """Cost and edits of the whole conversation."""
        to_go = [self.end]
        for of, n in reversed(runs):
            to_go.append(self.before(of, n, to_go[-1]))
        cost, state, parts = to_go.pop()[0], 0, []
        for of, n in runs:
            after = to_go.pop()
            # blocks from the largest down; what follows a block is the rest of the run
            for k in reversed(range(n.bit_length())):
                if n >> k & 1:
                    n -= 1 << k
                    done, state = self.block(of, k, state, self.before(of, n, after))
                    parts.append(done)
        while state not in ACCEPTED:
            parts.append(INSERT)
            state = OWED_STATE[state]
        return cost, "".join(parts)

    def block(self, of: int, k: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
        """The edits of 2^k rows of a symbol and the state that they lead to."""
        least = min(after)
        after = tuple(value - least for value in after)
        key = (of, k, state, after)
        if key in self.blocks:
            return self.blocks[key]
        if k:
            first, middle = self.block(of, k - 1, state, applied(self.power(of, k - 1), after))
            second, end = self.block(of, k - 1, middle, after)
            done = first + second, end
        else:
            done = self._row(of, state, after)
        if k <= self.REMEMBERED_POWER:
            self.blocks[key] = done
        return done

    def _row(self, of: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
        here, edits = applied(self.power(of, 0), after), ""
        while True:
            steps = [(edit, cost + after[q], q) for edit, cost, q in choices(of, state)]
            steps.append((INSERT, COST[INSERT] + here[OWED_STATE[state]], OWED_STATE[state]))
            edit, _, state = min(step for step in steps if step[1] == here[state])
            edits += edit
            if edit != INSERT:
                return edits, state


class Summary:
    """Counts of consecutive rows, and what a neighbour needs to add its own."""

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "n_turns", "low", "high", "first", "last")

    def __init__(self, *values) -> None:
        (self.blank, self.duplicate, self.truncated, self.illegal, self.n_turns,
         self.low, self.high, self.first, self.last) = values or (0, 0, 0, 0, 0, None, None, None, None)

    def values(self) -> tuple:
        return tuple(getattr(self, name) for name in self.FIELDS)

    def add(self, other: Summary) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal", "n_turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if self.last is not None and other.first is not None and self.last + other.first not in LEGAL:
            self.illegal += 1
        if self.high is not None and self.high == other.low:
            self.n_turns -= 1
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.n_turns


def add_run(runs: list[tuple[int, int]], of: int, n: int) -> None:
    if n:
        if runs and runs[-1][0] == of:
            n += runs.pop()[1]
        runs.append((of, n))


def read_rows(rows: Iterable[tuple]) -> tuple[Summary, list[tuple[int, int]]]:
    """Counts and runs of consecutive rows (turn, role, text, count, whether seen in an earlier turn)."""
    total, runs = Summary(), []
    for turn, role, text, count, seen in rows:
        if not count:
            continue
        body = text.strip(SPACE)
        fault = MUST_GO if not body or seen else FINE if body[-1] in ".!?" else TRUNCATED
        one = Summary(0, 0, 0, count - 1, int(turn is not None), turn, turn, role[:1], role[:1])
        if not body:
            one.blank = count
        else:
            one.duplicate = count - (not seen)
            one.truncated = int(fault == TRUNCATED)
        total.add(one)
        add_run(runs, symbol(role_kind(role), fault), 1)
        add_run(runs, GONE, count - 1)
    return total, runs


class Repaired:
    """Follows an audit along the rows and hashes what stays; holds no text."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.empty, self.digest = audit, 0, 0, True, hashlib.sha256()

    def _put(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def _owed(self, text: str) -> None:
        self._put(OWED_ROLE[self.state], text)
        self.state = OWED_STATE[self.state]

    def _inserts(self) -> None:
        while self.audit[self.at: self.at + 1] == INSERT:
            self._owed("")
            self.at += 1

    def rows(self, rows: Iterable[tuple[str, str, int]]) -> None:
        for role, text, count in rows:
            for _ in range(count):
                self._inserts()
                edit = self.audit[self.at]
                self.at += 1
                if edit == REROLE:
                    self._owed(text)
                elif edit == KEEP:
                    self._put(role, text)
                    self.state = kept_state(self.state, role_kind(role))

    def hexdigest(self) -> str:
        self._inserts()
        return self.digest.hexdigest()


RESULT = [field("conv_id", LONG), *(field(name, LONG) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
          field("audit", STRING), field("repaired_sha256", STRING)]
RESULT_ARROW = pa.schema([(f.name, pa.string() if f.dataType == STRING else pa.int64()) for f in RESULT])


def _result(conv_id: int | None, total: Summary, cost: int, audit: str, digest: str) -> tuple:
    return (conv_id, total.gaps(), total.blank, total.duplicate, total.truncated, total.illegal, cost, audit, digest)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row[k] for row in rows], schema.types[k]) for k in range(len(schema))], schema=schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the number of copies of each row; 0 copies of a dropped one.

    crc32 of ``conv_id:turn`` modulo 20 decides: 0 drops a row, 1 empties its
    text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    rows = need(conversations, conv_id="long", turn="long", role="string", text="string")
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    kind = F.col("_kind")
    return rows.withColumn("_kind", F.crc32(key) % 20).select(
        "conv_id", F.when(kind != 0, F.col("turn")).alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _with_seen(rows: DataFrame) -> DataFrame:
    """Distinct rows with their count, and whether an earlier turn has the same role and text.

    Both steps are reduced before they are shuffled, and nulls become flags,
    so that the join meets rows where the grouping has left them.
    """
    turn_key = ["no_conv", "conv_id", "no_turn", "turn"]
    plain = rows.select(
        F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv_id"),
        F.col("turn").isNotNull().alias("no_turn"), F.coalesce("turn", F.lit(0)).alias("turn"),  # false sorts first: null turns
        "role", "text", F.sha2("text", 256).alias("digest"), "copies")
    once = plain.groupBy(*turn_key, "role", "digest").agg(F.max("text").alias("text"), F.sum("copies").alias("copies"))
    narrow = plain.where("copies > 0").groupBy(*turn_key, "role", "digest").agg(F.lit(1).alias("one"))
    first = narrow.groupBy("no_conv", "conv_id", "role", "digest").agg(
        F.min(F.struct("no_turn", "turn")).alias("first"), F.count("*").alias("times")).where("times > 1")
    again = narrow.join(first, ["no_conv", "conv_id", "role", "digest"]).where(
        F.struct("no_turn", "turn") > F.col("first")).select(*turn_key, "role", "digest", F.lit(True).alias("seen"))
    return once.join(again, [*turn_key, "role", "digest"], "left").select(
        *turn_key, "role", "text", "copies", F.coalesce("seen", F.lit(False)).alias("seen"))


SUMMARY = [field(name, STRING if name in ("first", "last") else LONG) for name in Summary.FIELDS]
PIECES = StructType([
    *RESULT, field("at", LONG), *(field(f"_{f.name}", f.dataType) for f in SUMMARY),
    field("symbols", ArrayType(LONG)), field("lengths", ArrayType(LONG)),
    field("roles", ArrayType(STRING)), field("texts", ArrayType(STRING)), field("counts", ArrayType(LONG))])
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
PIECES_ARROW = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in PIECES.fields])


def pieces(rows: DataFrame) -> DataFrame:
    """Repaired conversations (``at`` is null), and pieces of those that lie in several tasks or are long."""
    order = [F.substring("role", 1, 16), F.substring("text", 1, 64)]
    key = ["no_conv", "conv_id", "no_turn", "turn"]
    dealt = rows.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order, "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer, task, number = Repairer(), TaskContext.get().partitionId(), 0
        out, here, size, started, current = [], [], 0, False, None
        first = True  # no other conversation has ended in this task

        def as_piece() -> tuple:
            nonlocal number
            total, runs = read_rows(here)
            number += 1
            return (current[1], *[None] * 8, (task << 33) + number, *total.values(), [r[0] for r in runs], [r[1] for r in runs],
                    [r[1] for r in here], [r[2] for r in here], [r[3] for r in here])

        def whole() -> tuple:
            total, runs = read_rows(here)
            cost, audit = repairer.audit(runs)
            walk = Repaired(audit)
            walk.rows((r[1], r[2], r[3]) for r in here)
            return (*_result(current[1], total, cost, audit, walk.hexdigest()), *[None] * (len(PIECES.fields) - len(RESULT)))

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                for no_conv, conv, no_turn, turn, role, text, copies, seen in zip(*(c.to_pylist() for c in part.columns)):
                    conversation = (True, None if no_conv else conv)
                    if conversation != current:
                        if current is not None:
                            out.append(as_piece() if first or started else whole())
                            first = False
                        here, size, started, current = [], 0, False, conversation
                    elif len(here) >= PIECE_ROWS or size + len(text) > PIECE_BYTES and here:
                        out.append(as_piece())
                        here, size, started = [], 0, True
                    here.append((turn if no_turn else None, role, text, copies, seen))
                    size += len(text)
                if out:
                    yield _record(out, PIECES_ARROW)
                    out = []
        if current is not None:
            yield _record([as_piece()], PIECES_ARROW)

    return materialise(dealt.mapInArrow(run, PIECES), "conversation-pieces")


def _joined(stored: DataFrame) -> DataFrame:
    """Repairs conversations from their pieces: first the runs of all, then the texts piece by piece."""
    names = [f"_{name}" for name in Summary.FIELDS]
    split = stored.where("at is not null")
    runs = split.select("conv_id", F.lit(0).alias("texts_follow"), "at", *names, "symbols", "lengths", *(
        F.lit(None).cast(PIECES[c].dataType).alias(c) for c in ("roles", "texts", "counts")))
    texts = split.select("conv_id", F.lit(1).alias("texts_follow"), "at", *(
        F.lit(None).cast(PIECES[c].dataType).alias(c) for c in (*names, "symbols", "lengths")), "roles", "texts", "counts")
    ordered = runs.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "texts_follow", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer()
        current, total, found, walk, cost = None, Summary(), [], None, 0
        for batch in batches:
            for at in range(batch.num_rows):  # a row holds a whole piece
                row = {name: batch.column(k)[at].as_py() for k, name in enumerate(batch.schema.names)}
                conversation = (True, row["conv_id"])
                if conversation != current:
                    if current is not None:
                        yield _record([_result(current[1], total, cost, walk.audit, walk.hexdigest())], RESULT_ARROW)
                    current, total, found, walk = conversation, Summary(), [], None
                if not row["texts_follow"]:
                    total.add(Summary(*(row[name] for name in names)))
                    for of, n in zip(row["symbols"], row["lengths"]):
                        add_run(found, of, n)
                    continue
                if walk is None:
                    cost, audit = repairer.audit(found)
                    walk = Repaired(audit)
                walk.rows(zip(row["roles"], row["texts"], row["counts"]))
        if current is not None:
            yield _record([_result(current[1], total, cost, walk.audit, walk.hexdigest())], RESULT_ARROW)

    return ordered.mapInArrow(run, StructType(RESULT))


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, counts of faults, cost, audit and repaired_sha256 of every conversation of (conv_id, turn, role, text, copies)."""
    stored = pieces(_with_seen(rows))
    return stored.where("at is null").select(*(f.name for f in RESULT)).union(_joined(stored))
