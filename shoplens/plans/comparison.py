"""Side-by-side training summaries of several models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoplens.functions.columns import preferred
from shoplens.operators.merge import stack

# --- fixed values: columns of the comparison, in order --------------------
COMPARISON_COLUMNS = (
    "model_family", "model_name", "model_type", "top_k", "evaluated_users", "hits",
    "hit_rate_at_10", "precision_at_10", "recall_at_10", "ndcg_at_10",
    "model_artifact_path", "training_report_path",
)
COMPARED_METRICS = ("hit_rate_at_10", "precision_at_10", "recall_at_10", "ndcg_at_10")


def labelled(summary: DataFrame, family: str, artifact: str, report: str) -> DataFrame:
    return summary.withColumns({
        "model_family": F.lit(family),
        "model_artifact_path": F.lit(artifact),
        "training_report_path": F.lit(report),
    })


def compare_models(*summaries: DataFrame) -> DataFrame:
    return preferred(stack(*summaries), COMPARISON_COLUMNS, keep_rest=False)


def metric_matrix(comparison: DataFrame, families: list[str], metrics: tuple[str, ...] = COMPARED_METRICS) -> DataFrame:
    """One row per metric, one column per model family."""
    return (
        comparison.unpivot("model_family", list(metrics), "metric", "score")
        .groupBy("metric")
        .pivot("model_family", families)
        .agg(F.first("score"))
    )
