"""Time bounds, the train/test cutoff, and test targets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.constants import CONTENT_UNKNOWN_WEIGHT, CURATED_UNKNOWN_WEIGHT, DAY_MS
from shoplens.operators.ranking import first_per_key
from shoplens.operators.rollup import split_rollup, train_pairs


def time_bounds(interactions: DataFrame) -> DataFrame:
    return interactions.agg(
        F.min("event_timestamp_ms").alias("min_timestamp_ms"),
        F.max("event_timestamp_ms").alias("max_timestamp_ms"),
    )


@dataclass(frozen=True)
class Window:
    """Bounds of the history and the cutoff between train and test.

    Three numbers on the driver, so the cutoff is a literal in later plans
    and the comparison is pushed into the scan.
    """

    min_ms: int
    max_ms: int
    test_days: int

    @property
    def cutoff_ms(self) -> int:
        return self.max_ms - self.test_days * DAY_MS


def find_window(interactions: DataFrame, test_days: int) -> Window:
    bounds = time_bounds(interactions).first()
    if bounds is None or bounds["max_timestamp_ms"] is None:
        raise ValueError("no timestamp bounds: the interactions are empty")
    return Window(bounds["min_timestamp_ms"], bounds["max_timestamp_ms"], test_days)


@dataclass(frozen=True)
class SplitRule:
    """How a model reads the history.

    ``boundary_in_train``: side of an event exactly at the cutoff.
    ``latest_target``: among equally strong test items take the latest, else
    the earliest.
    """

    boundary_in_train: bool
    unknown_weight: float
    latest_target: bool

    def is_train(self, window: Window) -> Column:
        stamp = F.col("event_timestamp_ms")
        return stamp <= window.cutoff_ms if self.boundary_in_train else stamp < window.cutoff_ms


POPULARITY_RULE = SplitRule(boundary_in_train=False, unknown_weight=CURATED_UNKNOWN_WEIGHT, latest_target=True)
CONTENT_RULE = SplitRule(boundary_in_train=True, unknown_weight=CONTENT_UNKNOWN_WEIGHT, latest_target=False)


def split_pairs(interactions: DataFrame, window: Window, rule: SplitRule) -> DataFrame:
    return split_rollup(interactions, rule.is_train(window), rule.unknown_weight)


def train_split(interactions: DataFrame, window: Window, rule: SplitRule) -> DataFrame:
    """Only the train part; the time filter is pushed into the scan."""
    return split_pairs(interactions.where(rule.is_train(window)), window, rule)


def event_counts(split: DataFrame) -> DataFrame:
    return split.agg(
        F.coalesce(F.sum("train_events"), F.lit(0)).alias("train_event_count"),
        F.coalesce(F.sum("test_events"), F.lit(0)).alias("test_event_count"),
    )


def test_targets(split: DataFrame, rule: SplitRule, sample_users: int | None = None) -> DataFrame:
    """One target item per user: strongest, then latest or earliest, then lowest id.

    With ``sample_users`` at most that many users are kept, in scattered order
    for the popularity rule and in id order for the content rule.
    """
    stamp_name = "last_target_ms" if rule.latest_target else "first_target_ms"
    stamp = F.col(stamp_name)
    order = [
        F.col("target_weight").desc(),
        stamp.desc() if rule.latest_target else stamp.asc(),
        F.col("item_id").asc(),
    ]
    targets = first_per_key(split.where(F.col("target_weight").isNotNull()), ["user_id"], order).select(
        "user_id", F.col("item_id").alias("target_item_id"), "target_weight", stamp_name
    )
    if sample_users is None:
        return targets
    return targets.orderBy(*(scattered() if rule.latest_target else [F.col("user_id")])).limit(sample_users)


def scattered() -> list[Column]:
    """An order of users unrelated to their ids, in integers any engine computes alike."""
    return [F.pmod(F.col("user_id"), F.lit(1_000_003)) * F.lit(2_654_435_761) % F.lit(4_294_967_296), F.col("user_id")]


def seen_by(split: DataFrame, users: DataFrame) -> DataFrame:
    """Train-window items, with weights, of the users in scope."""
    return train_pairs(split).join(users.select("user_id"), "user_id", "left_semi")
