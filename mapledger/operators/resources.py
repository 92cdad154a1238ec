"""Turning the resources of versions into classified files.

A resources relation has ``version_id, dataset_id, res_ord, name, format, download_url,
odata_url``; ``res_ord`` is the position within the version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import addresses, files, fixed
from ..functions.text import given
from .joins import picked, split_join


def attach_row_counts(resources: DataFrame, change_rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Add ``rows``: the count listed under the resource's name, else the version's total."""
    last = change_rows.where("name IS NOT NULL").groupBy("version_id", "name").agg(F.max_by("rows_count", "row_ord").alias("n"))
    # As long as the version's answer; resources then meet their version once.
    listed = last.groupBy("version_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "n"))).alias("listed"))
    counts = versions.select("version_id", "total_rows").join(listed, "version_id", "full")
    name = F.coalesce(given(F.col("name")), F.lit("resource"))
    return (
        split_join(resources, counts, ["version_id"], "left")
        .withColumn("rows", F.coalesce(F.try_element_at("listed", name), "total_rows"))
        .drop("listed", "total_rows")
    )


def classify_resources(resources: DataFrame) -> DataFrame:
    """Add everything that follows from name, format and address; one projection, no shuffle."""
    url = given(F.col("download_url"))
    has_url = url.isNotNull()
    name = F.coalesce(given(F.col("name")), F.lit("resource"))
    fmt = F.lower(F.coalesce("format", F.lit("")))
    typed = resources.withColumns({
        "name": name,
        "fmt": fmt,
        "download_url": url,
        "odata_url": F.when(~has_url, F.col("odata_url")),
        "ext": F.when(has_url, files.resource_ext(fmt, url)).otherwise(""),
    }).drop("format")
    url, kind = F.col("download_url"), F.col("class.layer_kind")
    styled = files.is_symbology(F.col("name"), url)
    fetched = url.isNotNull()
    classed = typed.withColumn("class", F.when(fetched, files.file_class(F.col("ext"), styled)))
    return classed.withColumns({
        "category": F.coalesce("class.category", F.lit("other")),
        "layer_kind": kind,
        "container": F.coalesce("class.container", F.lit(False)),
        "kind": F.when(fetched, files.coarse_kind(kind)).otherwise("odata"),
        "uri": F.when(fetched, files.open_uri(url, F.col("ext"))),
    }).drop("class")


def resolve_resources(resources: DataFrame, change_rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Every resource of every version with its class, its way to open and its row count."""
    return classify_resources(attach_row_counts(resources, change_rows, versions))


def read_plan(classified: DataFrame) -> DataFrame:
    """One row per way to open a file, in the order to try them."""
    plan = classified.filter(F.col("download_url").isNotNull()).select(
        "version_id", "res_ord", "ext",
        files.is_gzip(F.col("download_url")).alias("compressed"),
        F.posexplode(files.open_attempts(F.col("download_url"), F.col("ext"))).alias("pos", "uri"),
    )
    return plan.select(
        "version_id", "res_ord", "ext", "compressed", (F.col("pos") + 1).cast("bigint").alias("attempt"), "uri"
    )


def resources_in_mode(classified: DataFrame, mode: int) -> DataFrame:
    """The files that a display mode shows; ``warn`` marks those that cannot be opened."""
    shown = classified.filter(F.col("download_url").isNotNull())
    if mode <= 1:
        shown = shown.filter(F.col("category") == "spatial")
    elif mode == 2:
        shown = shown.filter(F.col("category") != "other")
    return shown.withColumn("warn", (F.lit(mode) >= 3) & (F.col("category") == "other"))


def _first_by(rows: DataFrame, order) -> DataFrame:
    return picked(rows, ["version_id"], F.min_by, order)


def pick_default(classified: DataFrame, prefer_geojson: bool = True) -> DataFrame:
    """The file that a version opens with: its first vector file, else its first resource."""
    later = F.col("kind") != "vector" if prefer_geojson else F.lit(False)
    return _first_by(classified, F.struct(later, F.col("res_ord")))


def pick_bundle(classified: DataFrame) -> DataFrame:
    """The archive a version takes its style from: the first named as symbology, else the first."""
    archives = classified.select("version_id", "res_ord", "name", "ext", "download_url").filter(
        (F.col("ext") == "zip") & F.col("download_url").isNotNull()
    )
    unnamed = ~F.lower("name").contains("symbology")
    return _first_by(archives, F.struct(unnamed, F.col("res_ord")))


def files_by_suffix(resources: DataFrame) -> DataFrame:
    """One bucket file per version and suffix; the last listed wins."""
    names = F.filter(F.array(F.regexp_extract("download_url", fixed.BUCKET_PATTERN, 2)), lambda n: n != "")
    in_bucket = resources.select(
        "version_id", "dataset_id", "res_ord", "download_url", F.explode(names).alias("file_name")
    )
    named = in_bucket.withColumn("suffix", addresses.resource_suffix(F.col("file_name")))
    last = picked(named, ["version_id", "dataset_id", "suffix"], F.max_by, F.col("res_ord"))
    return last.select("version_id", "dataset_id", "suffix", "file_name", "download_url")
