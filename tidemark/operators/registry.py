"""Model versions as a table: numbering, promotion, listing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def next_versions(versions: DataFrame, candidates: DataFrame, model: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number new candidates after the highest version each model already has."""
    highest = versions.groupBy(*model).agg(F.max("version").alias("_highest"))
    place = F.row_number().over(Window.partitionBy(*model).orderBy(*order))
    return (
        candidates.join(highest, list(model), "left")
        .withColumn("version", (F.coalesce("_highest", F.lit(0)) + place).cast("int"))
        .drop("_highest")
    )


def promote(versions: DataFrame, model: Sequence[str]) -> DataFrame:
    """A new snapshot: the newest approved version serves, versions that served before are archived.

    Rows carry ``version``, ``approved`` and the current ``stage``.
    """
    peers = Window.partitionBy(*model)
    newest = F.max(F.when(F.col("approved"), F.col("version"))).over(peers)
    stage = (
        F.when(F.col("version") == F.col("_serving"), "Production")
        .when((F.col("stage") == "Production") & F.col("_serving").isNotNull(), "Archived")
        .otherwise(F.col("stage"))
    )
    return versions.withColumn("_serving", newest).withColumn("stage", stage).drop("_serving")


def production_version(versions: DataFrame, model: Sequence[str]) -> DataFrame:
    """The version that scores new data: the highest one in stage Production."""
    return versions.where(F.col("stage") == "Production").groupBy(*model).agg(F.max("version").alias("version"))


def with_tags(
    versions: DataFrame, *, metrics: Mapping[str, str], model_type: str, ready: str, trained: Column, data: str
) -> DataFrame:
    """Add ``tags``, a map of texts: the metrics in four digits (unknown ones are left out), type, day, verdict and data."""
    texts = {tag: F.nanvl(F.col(c), F.lit(None).cast("double")).cast("decimal(28,4)") for tag, c in metrics.items()}
    texts |= {
        "model_type": F.col(model_type), "training_date": F.date_format(trained, "yyyy-MM-dd"),
        "deployment_ready": F.col(ready), "data_version": F.lit(data),
    }
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in texts.items()))
    return versions.withColumn("tags", F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())))


def list_models(versions: DataFrame, model: Sequence[str]) -> DataFrame:
    """Per model the newest version of every stage, with the version's tags where versions carry them."""
    tags = [F.max_by("tags", "version").alias("tags")] if "tags" in versions.columns else []
    return versions.groupBy(*model, "stage").agg(
        F.max("version").alias("latest_version"),
        F.max_by("run_id", "version").alias("run_id"),
        F.count("*").alias("n_versions"),
        *tags,
    )


def model_counts(versions: DataFrame, groups: Sequence[str], model: Sequence[str]) -> DataFrame:
    """Models, versions, and models that serve, per group."""
    serving = F.when(F.col("stage") == "Production", F.struct(*model))
    return versions.groupBy(*groups).agg(
        F.count_distinct(F.struct(*model)).alias("models"), F.count("*").alias("versions"), F.count_distinct(serving).alias("serving")
    )
