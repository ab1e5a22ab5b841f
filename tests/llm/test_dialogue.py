"""Conversation repair against a plain reading and a plain dynamic program."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from llm import dialogue

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    # names that the operator uses for its own columns
    *(T.StructField(name, T.StringType()) for name in ("copies", "digest", "seen", "audit", "at", "kind", "low"))])


def _spoil(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def _step(built, role):
    """What the initials so far become, or None; only whether they may go on matters."""
    more = built + role[:1]
    return more if re.fullmatch(r"s?(ua)*u?", more) else None


def _cheapest(rows):
    """(cost, audit, repaired roles) over rows (role, text, fault), by the shortest paths row by row."""
    # what has been built, reduced to a state: nothing, s, u, ua
    short = {"": "", "s": "s"}
    state_of = lambda built: short.get(built, built[-1:] if built[-1:] == "u" else "ua")
    layer = {"": (0, "", ())}

    def better(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def with_inserts(layer):
        for _ in range(4):
            for state, (cost, audit, kept) in list(layer.items()):
                for role in ("user", "assistant"):
                    built = _step(state, role)
                    if built is not None:
                        better(layer, state_of(built), (cost + 5, audit + "I", (*kept, (role, ""))))
        return layer

    for role, text, fault in rows:
        following = {}
        for state, (cost, audit, kept) in with_inserts(layer).items():
            better(following, state, (cost + 2, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            for edit, new, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                built = _step(state, new) if new else None
                if built is not None:
                    better(following, state_of(built), (cost + price + more, audit + edit, (*kept, (new, text))))
        layer = following
    return min((value for state, value in with_inserts(layer).items() if state in ("", "ua")), key=lambda v: v[:2])


def _plain(rows):
    out = {}
    for conv in {row[0] for row in rows}:
        own = sorted((r for r in _spoil(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults, seen = [], set()
        for _, _, role, text in own:
            body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            faults.append("blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen
                          else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in own if r[1] is not None}
        cost, audit, kept = _cheapest([(r[2], r[3], f) for r, f in zip(own, faults)])
        out[conv] = (
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest())
    return sorted(out.values(), key=repr)


def _random_rows(seed, n_conversations=60, most=14):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "a", "u"]
    texts = ["Fine.", "Also fine!", "cut off", "", " \t", None, "Is it? ", "x", "é　", "A longer one.\nWith lines."]
    rows = []
    for conv in range(n_conversations):
        for _ in range(rng.randrange(most)):
            rows.append((conv, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)))
    return rows + [(None, 1, "user", "no id."), (None, None, None, None), (10 ** 12, 5, "assistant", "z" * 300_000 + ".")]


def _frame(spark, rows):
    return spark.createDataFrame([(*row, *["x"] * 7) for row in rows], SCHEMA)


def _got(spark, rows):
    found = dialogue.repair(dialogue.damaged(_frame(spark, rows)))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_repairs_equal_the_plain_program(spark, seed):
    rows = _random_rows(seed)
    assert _got(spark, rows) == _plain(rows)


def test_a_conversation_in_many_pieces_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(dialogue, "PIECE_ROWS", 5)
    rng = random.Random(4)
    rows = [(7, turn, rng.choice(["user", "assistant", "system"]), rng.choice([f"text {turn}.", "again.", "open", ""]))
            for turn in range(400)]
    rows += [(8, 3, "user", "the same row.")] * 90 + [(9, None, "user", "q?"), (9, None, "assistant", "r.")] + _random_rows(5, 20, 30)
    frame = _frame(spark, rows).repartition(6)
    found = dialogue.repair(dialogue.damaged(frame))
    assert sorted(map(tuple, found.collect()), key=repr) == _plain(rows)


def test_runs_by_powers_equal_single_rows():
    rng, repairer = random.Random(3), dialogue.Repairer()
    for _ in range(300):
        runs = []
        for _ in range(rng.randrange(1, 7)):
            dialogue.add_run(runs, rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]), rng.choice([1, 2, 3, 7, 64, 200]))
        cost, audit = repairer.audit(runs)
        faults = {0: "", 1: "truncated"}
        rows = [("suao"[of // 2] if of != dialogue.GONE else "u", "t", "blank" if of == dialogue.GONE else faults[of % 2])
                for of, n in runs for _ in range(n)]
        assert (cost, audit) == _cheapest(rows)[:2]


def test_a_run_of_a_million_rows_is_repaired_at_once():
    cost, audit = dialogue.Repairer().audit([(dialogue.symbol(dialogue.USER, dialogue.FINE), 1_000_000)])
    assert len(audit) == 1_000_000 and audit.count("R") == 500_000 == cost


def test_empty_and_dropped(spark):
    assert _got(spark, []) == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    assert _got(spark, [(3, dropped, "user", "gone.")]) == [(3, *[0] * 6, "", hashlib.sha256(b"").hexdigest())]


def test_query_equals_the_plain_program_on_a_table(spark):
    from llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, folder).collect()), key=repr) == _plain(rows)
