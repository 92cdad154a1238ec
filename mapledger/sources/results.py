"""Writing reports and naming results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import given
from ..session import fresh_path, remove, written

# Tables behind named results, by application and name.
_NAMED: dict[tuple[str, str], list[str]] = {}


def write_refresh_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the eleven text columns; empty text stays empty text."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in fixed.REPORT_COLUMNS]
    rows = report.select(*columns)
    if fmt == "csv":
        rows.write.csv(path, header=True, emptyValue="", escape='"')
    else:
        rows.write.format(fmt).save(path)


def is_spatial_result(result: DataFrame) -> DataFrame:
    """One row: whether any record of a result carries geometry."""
    if fixed.GEOJSON_COLUMN not in result.columns:
        return result.agg(F.lit(False).alias("is_spatial"))
    carries = given(F.col(fixed.GEOJSON_COLUMN)).isNotNull()
    return result.agg(F.coalesce(F.bool_or(carries), F.lit(False)).alias("is_spatial"))


def materialize_result(result: DataFrame, name: str, spatial: bool | None = None, stored: bool = False) -> DataFrame:
    """Register a result under ``name``: a spatial one without the records that lack geometry.

    Whether a free result is spatial follows from its records; a layer load is always
    spatial, a table load never. Helper geometry columns other than the GeoJSON are dropped. A free
    result is stored before its kind is asked for, so it is computed once, unless it is ``stored``. That table
    outlives the job it is made in and goes with ``drop_result``.
    """
    if spatial is None and not stored and fixed.GEOJSON_COLUMN in result.columns:
        spark = result.sparkSession
        path = fresh_path(spark, "free-result", lasting=True)
        result = written(result, "free-result", path)
        _NAMED.setdefault((spark.sparkContext.applicationId, name), []).append(path)
    columns = [c for c in result.columns if c not in (fixed.GEOMETRY_COLUMN, "geometry_wkt")]
    rows = result.select(*columns)
    if fixed.GEOJSON_COLUMN in columns:
        carries = given(F.col(fixed.GEOJSON_COLUMN)).isNotNull()
        if spatial is None:
            rows = rows.filter(carries | ~is_spatial_result(result).scalar())
        elif spatial:
            rows = rows.filter(carries)
        else:
            rows = rows.drop(fixed.GEOJSON_COLUMN)
    rows.createOrReplaceTempView(name)
    return rows


def drop_result(spark: SparkSession, name: str) -> None:
    """Forget a named result and remove the tables stored for it; a name that is not there is no error."""
    spark.catalog.dropTempView(name)
    for path in _NAMED.pop((spark.sparkContext.applicationId, name), []):
        remove(spark, path)
