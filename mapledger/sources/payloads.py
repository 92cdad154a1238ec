"""JSON answers of the service as relations.

An answer is one text, and many answers are read at once. ``read_payloads`` takes a folder
of files with one answer each; the functions below also take answers from any relation with
the columns named in their description. Typed parts are parsed by ``from_json``; free-form
records stay JSON text, which keeps the order of their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import given

TABLE_ROW = (
    "STRUCT<`table` STRING, dataset_id STRING, ckan_id STRING, title STRING, organization STRING,"
    " source_type STRING, est_rows BIGINT, `schema` STRING, versions_url STRING,"
    " columns ARRAY<STRUCT<name STRING, type STRING>>>"
)
LISTING_ITEM = (
    "STRUCT<id STRING, title STRING, organization VARIANT, source_type STRING, ckan_id STRING,"
    " versions_url STRING, new_resources_at_source ARRAY<STRUCT<format STRING>>>"
)
VERSION = (
    "STRUCT<version_number BIGINT, detected_at STRING,"
    " change_summary STRUCT<total_rows BIGINT, resources ARRAY<STRUCT<name STRING, `rows` BIGINT>>>,"
    " resources ARRAY<STRUCT<name STRING, format STRING, download_url STRING, odata_resource_url STRING>>>"
)


def read_payloads(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Answers below ``path`` with the file they came from; gzip is looked through."""
    texts = spark.read.text(path, wholetext=not one_per_line)
    return texts.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("payload"))


def _is_list(payload: Column) -> Column:
    return F.ltrim(payload).startswith("[")


def _listed(payload: Column, element: str, *keys: str) -> Column:
    """The payload itself when it is a list, else the list under the first of ``keys`` that holds one."""
    fields = ", ".join(f"`{key}` ARRAY<{element}>" for key in keys)
    parsed = F.from_json(payload, f"STRUCT<{fields}>")
    inner = [
        F.when(F.get_json_object(payload, f"$.{key}").startswith("["), parsed[key]) for key in keys
    ]
    return F.when(_is_list(payload), F.from_json(payload, f"ARRAY<{element}>")).otherwise(F.coalesce(*inner))


def catalog_tables(payloads: DataFrame) -> DataFrame:
    """Table rows of ``payload``; ``payload_no`` orders several answers."""
    rows = payloads.select("payload_no", F.posexplode(_listed(F.col("payload"), TABLE_ROW, "tables")).alias("pos", "t"))
    return rows.select(
        F.struct("payload_no", "pos").alias("place"), F.col("t.table").alias("table_name"),
        F.col("t.schema").alias("schema_name"),
        *[F.col(f"t.{c}") for c in (
            "dataset_id", "ckan_id", "title", "organization", "source_type", "est_rows", "versions_url", "columns"
        )],
    )


def dataset_pages(payloads: DataFrame) -> DataFrame:
    """Listing items of pages with ``page_offset, payload``. All pages count, also those after a short one:
    that a short page is the last is for the fetching of pages to say."""
    pages = payloads.select("page_offset", _listed(F.col("payload"), LISTING_ITEM, "items").alias("items"))
    rows = pages.select("page_offset", F.posexplode("items").alias("pos", "i"))
    org = F.col("i.organization")
    named = F.when(F.schema_of_variant(org).startswith("OBJECT"), F.try_variant_get(org, "$.name", "string"))
    return rows.select(
        (F.col("page_offset") + F.col("pos")).cast("bigint").alias("listing_ord"),
        F.col("i.id").alias("dataset_id"), "i.title",
        F.when(F.schema_of_variant(org).startswith("OBJECT"), named)
        .otherwise(F.try_variant_get(org, "$", "string")).alias("organization"),
        "i.source_type", "i.ckan_id", "i.versions_url",
        F.transform("i.new_resources_at_source", lambda r: r.format).alias("formats"),
    )


def versions(payloads: DataFrame) -> DataFrame:
    """Version objects of answers with ``dataset_id, payload``; ``version_ord`` is the payload position."""
    rows = payloads.select(
        "dataset_id",
        F.posexplode(_listed(F.col("payload"), VERSION, "versions", "items", "results")).alias("version_ord", "v"),
    )
    return rows.select(
        "dataset_id", F.col("version_ord").cast("bigint").alias("version_ord"),
        "v.version_number", "v.detected_at", F.col("v.change_summary.total_rows").alias("total_rows"),
        F.col("v.resources").alias("resources"), F.col("v.change_summary.resources").alias("change_rows"),
    )


def version_resources(parsed: DataFrame) -> DataFrame:
    """One row per resource of every parsed version."""
    rows = parsed.select("dataset_id", "version_ord", F.posexplode("resources").alias("pos", "r"))
    return rows.select(
        "dataset_id", "version_ord", F.col("pos").cast("bigint").alias("res_ord"),
        "r.name", "r.format", "r.download_url", F.col("r.odata_resource_url").alias("odata_url"),
    )


def version_change_rows(parsed: DataFrame) -> DataFrame:
    """One row per named row count of every parsed version."""
    rows = parsed.select("dataset_id", "version_ord", F.posexplode("change_rows").alias("pos", "r"))
    return rows.select(
        "dataset_id", "version_ord", F.col("pos").cast("bigint").alias("row_ord"),
        "r.name", F.col("r.rows").alias("rows_count"),
    )


def feature_columns(feature: Column) -> list[Column]:
    """``properties`` and ``geojson`` of a parsed feature; an empty geometry is none."""
    shape = feature["geometry"]
    empty = F.get_json_object(shape, "$.type").isNull() & (F.size(F.json_object_keys(shape)) == 0)
    return [
        F.coalesce(given(feature["properties"]), F.lit("{}")).alias("properties"),
        F.when(~F.coalesce(empty, F.lit(False)), shape).alias("geojson"),
    ]


def geojson_features(payloads: DataFrame) -> DataFrame:
    """Features of FeatureCollections with ``table_name, page_no, payload``.

    A page is one row until here and holds at most a page of features; large files are
    read by ``collections.collection_features``.
    """
    shape = "STRUCT<features ARRAY<STRUCT<properties STRING, geometry STRING>>, exceededTransferLimit BOOLEAN>"
    parsed = payloads.select("table_name", "page_no", F.from_json("payload", shape).alias("c"))
    rows = parsed.select("table_name", "page_no", F.posexplode("c.features").alias("pos", "f"))
    return rows.select("table_name", "page_no", F.col("pos").cast("bigint").alias("page_pos"), *feature_columns(F.col("f")))


def search_records(payloads: DataFrame) -> DataFrame:
    """Records of search or SQL answers with ``payload_no, payload``, as JSON text, and the cut flag.

    The records are under ``result.records``, ``records``, a list under ``result``, or the
    answer itself is the list.
    """
    payload = F.col("payload")
    records = "STRUCT<records ARRAY<STRING>, truncated BOOLEAN>"
    wrapped = F.get_json_object(payload, "$.result")
    inner = F.when(_is_list(payload), payload).otherwise(F.coalesce(wrapped, payload))
    parsed = payloads.select("payload_no", inner.alias("inner"))
    boxed = F.from_json("inner", records)
    rows = parsed.select(
        "payload_no",
        F.when(_is_list(F.col("inner")), F.from_json("inner", "ARRAY<STRING>")).otherwise(boxed.records).alias("records"),
        F.when(_is_list(F.col("inner")), F.lit(False))
        .otherwise(F.coalesce(boxed.truncated, F.lit(False))).alias("truncated"),
    )
    return rows.select(
        "payload_no", "truncated", F.posexplode("records").alias("pos", "record")
    ).withColumn("pos", F.col("pos").cast("bigint"))
