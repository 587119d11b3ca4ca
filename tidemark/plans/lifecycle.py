"""Training runs and their consequences as tables: compare, gate, register, promote."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..operators import registry, selection
from ..operators.training import results_table, train_and_compare


def train_run(
    matrix: DataFrame,
    *,
    experiment: Mapping[str, object],
    features: Sequence[str],
    targets: Sequence[str],
    params: Mapping[str, Mapping[str, object]] | None = None,
) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """Fit the model families, return (models, per-target metrics, scored results)."""
    models, metrics = train_and_compare(matrix, features=features, targets=targets, params=params)
    scores = selection.composite_scores(results_table(metrics, experiment), list(experiment))
    return models, metrics, scores


def decide(scores: DataFrame, *, series: Sequence[str], run: str, extra: bool = False) -> DataFrame:
    """Best model per run, compared with the run before, with the gate's decision."""
    best = selection.select_composite(scores, [*series, run])
    return selection.deployment_gate(selection.with_previous_run(best, series, run), extra=extra)


def register(versions: DataFrame, decided: DataFrame, *, model: Sequence[str], run: str) -> DataFrame:
    """Add the decided runs as new versions and promote: the new snapshot of the version table."""
    candidates = decided.select(*model, F.col(run).alias("run_id"), F.col("should_deploy").alias("approved"))
    numbered = registry.next_versions(versions, candidates, model, ["run_id"])
    added = numbered.withColumn("stage", F.lit("None"))
    return registry.promote(versions.unionByName(added), model)
