"""Interleave sources to target weights by Pfair scheduling.

Each source is a queue of blocks of ``block_rows`` documents.  With weight w
(a share of all blocks), block j of a source is released at floor(j / w) and
due at ceil((j + 1) / w), in units of one block.  In every slot the released
block with the earliest deadline comes next.  So at the start of slot t a
source has had more than w t - 1 and fewer than w t + 1 blocks.

With weights that are whole parts of a period the schedule repeats, so the
slots of one period, found by a fold over its slots in SQL, place every block
by arithmetic.  Nothing is dropped: where a source has run out its slots stay
empty and the others go on in the same order.  The bound holds up to the
first empty slot.

Documents of sources without a weight, null among them, are one source,
"other".  Order inside a source is by ``doc_id``, null first; rows with the
same ``doc_id`` are in any order.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from llm.common import carry, need, numbered, restore

OTHER = "other"


def whole_parts(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Weights as whole parts of ``period``, at least one each, by largest remainder."""
    if not weights or any(not weight > 0 for weight in weights.values()) or len(weights) > period:
        raise ValueError("weights must be above 0 and fewer than the period")
    total = sum(weights.values())
    exact = {name: weight * period / total for name, weight in weights.items()}
    parts = {name: max(1, int(value)) for name, value in exact.items()}
    order = sorted(weights, key=lambda name: (parts[name] - exact[name], name))
    at = 0
    while (short := period - sum(parts.values())) > 0:
        parts[order[at % len(order)]] += 1
        at += 1
    while short < 0:
        largest = max(parts, key=lambda name: (parts[name] - exact[name], parts[name]))
        parts[largest] -= 1
        short += 1
    return parts


def period_slots(parts: list[int]) -> Column:
    """array<array<int>>: for each source the slots of its blocks in one period.

    A fold over the slots keeps how many blocks each source has had, and
    takes the released block with the earliest deadline; a tie goes to the
    first source.
    """
    period, shares = sum(parts), ", ".join(map(str, parts))
    sources = f"sequence(0, {len(parts) - 1})"
    return F.expr(f"""
        transform(array(aggregate(
            sequence(0, {period - 1}),
            named_struct('had', transform({sources}, s -> 0), 'picks', cast(array() as array<int>)),
            (state, t) -> transform(
                array(array_min(filter(transform({sources}, s -> named_struct(
                    'due', (state.had[s] * {period} + {period} + array({shares})[s] - 1) div array({shares})[s],
                    'source', s,
                    'release', (state.had[s] * {period}) div array({shares})[s])), x -> x.release <= t)).source),
                pick -> named_struct(
                    'had', transform(state.had, (n, s) -> if(s = pick, n + 1, n)),
                    'picks', array_append(state.picks, pick)))[0]
        ).picks), picks -> transform({sources}, s -> filter(sequence(0, {period - 1}), t -> picks[t] = s)))[0]
    """)


def schedule(docs: DataFrame, weights: Mapping[str, float], block_rows: int, period: int = 100,
             source: str = "source") -> DataFrame:
    """``docs`` with stream, block, block_offset, release, deadline and slot.

    Ordering by (slot, block_offset) gives the mix; (slot, block_offset) is
    unique.  ``weights`` is configuration: one entry per source, with one for
    "other" if other documents are expected (else it gets the least weight).
    Columns of ``docs`` with the new names are replaced.
    """
    weights = dict(weights)
    weights.setdefault(OTHER, min(weights.values()))
    parts = whole_parts(weights, period)
    names = sorted(parts)
    new = ["stream", "block", "block_offset", "release", "deadline", "slot"]
    rows = docs.drop(*new)
    named = [name for name in names if name != OTHER]
    stream = F.when(F.col(f"`{source}`").isin(named), F.col(f"`{source}`").cast("string")).otherwise(OTHER)
    rows = numbered(rows.withColumn("stream", stream), [F.col("doc_id")], ["stream"], "__n_row")
    at = F.expr("case stream " + " ".join(f"when '{_quoted(n)}' then {k}" for k, n in enumerate(names)) + " end")
    share = F.expr("case stream " + " ".join(f"when '{_quoted(n)}' then {parts[n]}" for n in names) + " end").cast("long")
    block = F.col("block")
    # the fold runs once, not once a row; its result has one number per slot of the period
    slots = docs.sparkSession.range(1).select(period_slots([parts[n] for n in names])).first()[0]
    slots_of = F.expr("array(" + ", ".join(f"array({', '.join(map(str, own))})" for own in slots) + ")")
    return (
        rows.withColumn("block", F.expr(f"__n_row div {block_rows}"))
        .withColumn("block_offset", F.col("__n_row") % block_rows)
        .withColumn("__n_share", share)
        .withColumn("release", F.expr(f"(block * {period}) div __n_share"))
        .withColumn("deadline", F.expr(f"(block * {period} + {period} + __n_share - 1) div __n_share"))
        .withColumn("__n_cycle", F.expr("block div __n_share"))
        .withColumn("slot", F.col("__n_cycle") * period + F.get(F.get(slots_of, at), (block % F.col("__n_share")).cast("int")))
        .drop("__n_row", "__n_share", "__n_cycle")
    )


def _quoted(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def positions(docs: DataFrame, weights: Mapping[str, float], block_rows: int, period: int = 100) -> DataFrame:
    """The schedule of ``docs`` with the gapless ``position`` of each row in the mix."""
    rows = need(docs, doc_id="long", source="string")
    return numbered(schedule(rows, weights, block_rows, period), [F.col("slot"), F.col("block_offset")], [], "position")


def mixed(docs: DataFrame, weights: Mapping[str, float], block_rows: int, period: int = 100) -> DataFrame:
    """All columns of ``docs``, whatever their names, its rows in the order of the mix: written as files, the files follow that order."""
    ordered = (
        schedule(carry(docs, "doc_id", "source"), weights, block_rows, period)
        .repartitionByRange("slot", "block_offset")
        .sortWithinPartitions("slot", "block_offset")
    )
    return restore(ordered, docs.columns, "doc_id", "source")


def oracle_sql(weights: Mapping[str, float], block_rows: int, period: int = 100) -> str:
    """DuckDB SQL for ``positions`` over the table documents with unique ids: the slots by recursion, one a step."""
    weights = {OTHER: min(weights.values()), **weights}
    parts = whole_parts(weights, period)
    names = sorted(parts)
    shares = [parts[n] for n in names]
    named = ", ".join(f"'{n}'" for n in names if n != OTHER)
    return f"""
    with recursive run(t, had, pick) as (
        select -1, {[0] * len(names)}, -1
        union all
        select t + 1, list_transform(had, lambda h, i: case when i - 1 = pick then h + 1 else h end), pick from (
            select t, had, list_sort(list_filter(list_transform(range({len(names)}), lambda k: {{
                'due': ((had[k + 1] + 1) * {period} + {shares}[k + 1] - 1) // {shares}[k + 1], 'k': k,
                'release': had[k + 1] * {period} // {shares}[k + 1]}}), lambda x: x.release <= t + 1))[1].k as pick
            from run where t < {period - 1})),
    slots as (select t, pick, row_number() over (partition by pick order by t) - 1 as j from run where t >= 0),
    numbered as (
        select doc_id, source, case when source in ({named}) then source else '{OTHER}' end as stream,
               row_number() over (partition by case when source in ({named}) then source else '{OTHER}' end order by doc_id) - 1 as n
        from documents),
    placed as (
        select doc_id, source, stream, n // {block_rows} as block, n % {block_rows} as block_offset,
               list_position({names}, stream) - 1 as k, {shares}[list_position({names}, stream)] as w from numbered)
    select doc_id, source, stream, block, block_offset, block * {period} // w as release,
           (block * {period} + {period} + w - 1) // w as deadline, block // w * {period} + t as slot,
           row_number() over (order by block // w * {period} + t, block_offset) - 1 as position
    from placed join slots on slots.pick = placed.k and slots.j = placed.block % w"""
