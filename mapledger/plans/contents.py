"""What every dataset of the catalog offers in a display mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import given
from ..operators import catalog as catalog_ops, resources as resource_ops, versions as version_ops


def dataset_contents(catalog: DataFrame, versions: DataFrame, resources: DataFrame, mode=2) -> DataFrame:
    """One row per visible dataset: live table, visible files, active version and what is left.

    ``offer`` says what a dataset without layers falls back to: ``table`` for its plain rows,
    ``version_error`` without a version, ``no_files`` when its version shows none, and
    ``contents`` when it has something to show.
    """
    level = catalog_ops.display_mode(mode)
    shown = catalog_ops.visible_in_mode(catalog, level)
    latest = version_ops.latest_version(versions).select(
        "dataset_id", "version_id", "version_number",
        F.substring(F.coalesce("detected_at", F.lit("")), 1, 10).alias("detected"),
    )
    counted = versions.groupBy("dataset_id").agg((F.count("*") - 1).alias("older"))
    visible = resource_ops.resources_in_mode(resource_ops.classify_resources(resources), level)
    # Counted by version first: a row for each version meets the newest ones, not a row with address for each file.
    kinds = ("spatial", "data", "other")
    by_version = visible.groupBy("version_id", "dataset_id").agg(
        *[F.count_if(F.col("category") == c).alias(f"{c}_files") for c in kinds]
    )
    newest = by_version.join(latest.select("version_id"), "version_id", "left_semi")
    files = newest.groupBy("dataset_id").agg(*[F.sum(f"{c}_files").alias(f"{c}_files") for c in kinds])
    rows = (
        shown.select("dataset_id", "title", "is_spatial", "spatial_table", "primary_table")
        .join(latest, "dataset_id", "left")
        .join(counted, "dataset_id", "left")
        .join(files, "dataset_id", "left")
    )

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0))

    live = F.col("is_spatial") & given(F.col("spatial_table")).isNotNull()
    has_history = F.col("version_id").isNotNull() & (F.coalesce("version_number", F.lit(1)) > 1)
    populated = live | has_history | (count("spatial_files") + count("data_files") + count("other_files") > 0)
    fallback = ~F.col("is_spatial") & given(F.col("primary_table")).isNotNull()
    return rows.select(
        "dataset_id", "title", live.alias("live"),
        *[count(f"{c}_files").alias(f"{c}_files") for c in ("spatial", "data", "other")],
        F.col("version_number").alias("active_version"), F.col("detected").alias("active_detected"),
        F.when(has_history, count("older")).otherwise(0).alias("previous_versions"),
        fallback.alias("table_fallback"),
        F.when(populated, "contents").when(fallback, "table")
        .when(F.col("version_id").isNull(), "version_error").otherwise("no_files").alias("offer"),
    )
