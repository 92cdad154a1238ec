"""Rows of feature tables: boxes, filters, caps, schemas and extents.

A features relation has ``feature_ord, table_name, properties, geojson`` and the box
``xmin, ymin, xmax, ymax``; ``properties`` and ``geojson`` are JSON text. The box is null
without geometry, so box filters need not read the geometry.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, geometry
from ..functions.text import given
from .ranks import positions


def has_geometry() -> Column:
    return given(F.col("geojson")).isNotNull()


def with_box(features: DataFrame) -> DataFrame:
    """Add the box around ``geojson``; null without geometry."""
    return features.withColumns({name: F.expr(sql) for name, sql in geometry.box_sql("geojson").items()})


def bbox_overlap(features: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Features whose box overlaps the clamped ``box``; four comparisons that reach the scan."""
    cut = geometry.clamp_literal(box)
    if cut is None:
        return features.filter(F.lit(False))
    own = {name: F.col(name) for name in geometry.BOX}
    wanted = dict(zip(geometry.BOX, map(F.lit, cut)))
    return features.filter(geometry.boxes_overlap(own, wanted))


def intersects_box(features: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Features that share a point with ``box``: the box filter first, then the exact test."""
    xmin, ymin, xmax, ymax = (float(v) for v in box)
    own = {name: F.col(name) for name in geometry.BOX}
    wanted = dict(zip(geometry.BOX, map(F.lit, (xmin, ymin, xmax, ymax))))
    near = features.filter(geometry.boxes_overlap(own, wanted))
    sides = (f"CAST({v!r} AS DOUBLE)" for v in (xmin, ymin, xmax, ymax))
    return near.filter(F.expr(geometry.intersects_sql("geojson", *sides)))


@contextmanager
def quoted_identifiers(spark: SparkSession):
    """Within it, SQL text may quote names as ``"name"``."""
    wanted = {"spark.sql.ansi.enabled": "true", "spark.sql.ansi.doubleQuotedIdentifiers": "true"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def where_fragment(rows: DataFrame, where: str | None) -> DataFrame:
    """Rows that a raw WHERE fragment keeps; names may be double-quoted."""
    if not where:
        return rows
    with quoted_identifiers(rows.sparkSession):
        kept = rows.filter(F.expr(f"({where})"))
        kept.schema  # analysed while the setting holds
        return kept


def drop_null_geometry(records: DataFrame, spatial: bool) -> DataFrame:
    """A spatial result has no records without geometry; a table result keeps them."""
    return records.filter(has_geometry()) if spatial else records


def page(rows: DataFrame, limit: int, offset: int = 0, key: str = "feature_ord") -> DataFrame:
    """One window of the rows in the order of a unique key.

    The keys alone are put in order and numbered, which gives the window's first and last key; only
    the rows between them are gathered, however deep the window lies.
    """
    if not offset:
        return rows.orderBy(key).limit(limit)
    place = F.col("position")
    window = positions(rows.select(F.col(key).alias("k")), "k").filter((place >= offset) & (place < offset + limit))
    low, high = (window.agg(f("k")).scalar() for f in (F.min, F.max))
    return rows.filter(F.col(key).between(low, high)).orderBy(key)


def capped(rows: DataFrame, cap: int, route: str, key: str = "feature_ord") -> DataFrame:
    """The first ``cap`` rows in the order of a unique key, with ``truncated``.

    The ``features`` route knows whether more rows follow; the ``sql`` route says so as soon
    as the cap is reached. Keys alone are put in order, and rows are kept by one comparison.
    """
    keys = rows.select(F.col(key).alias("k"))
    last = keys.orderBy("k").limit(cap).agg(F.max("k")).scalar()
    seen = keys.limit(cap + 1).agg(F.count("*")).scalar()
    truncated = seen >= cap if route == "sql" else seen > cap
    return rows.filter(F.col(key) <= last).withColumn("truncated", truncated)


def first_rows(features: DataFrame, among: Column, *columns: str) -> DataFrame:
    """The given columns of the first row of every table among the rows that count.

    The ordinals alone are aggregated, in a hash aggregate over two narrow columns, and the rows
    are looked up by them; the join knows the size of the aggregate when it runs. Wide rows are
    not sorted. ``feature_ord`` is unique in a table.
    """
    firsts = features.groupBy("table_name").agg(F.min(F.when(among, F.col("feature_ord"))).alias("feature_ord"))
    found = features.select("table_name", "feature_ord", *columns)
    return firsts.join(found, ["table_name", "feature_ord"], "left").drop("feature_ord")


def field_type(variant: Column) -> Column:
    """BOOLEAN, BIGINT, DOUBLE or STRING for one JSON value."""
    kind = F.schema_of_variant(variant)
    return (
        F.when(kind == "BOOLEAN", "BOOLEAN")
        .when(kind == "BIGINT", "BIGINT")
        .when((kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL"), "DOUBLE")
        .otherwise("STRING")
    )


def infer_schema(features: DataFrame) -> DataFrame:
    """Name, type and position of every attribute of the first record of every table."""
    records = first_rows(features, F.lit(True), "properties").filter(F.col("properties").isNotNull())
    return record_fields(records)


def record_fields(records: DataFrame) -> DataFrame:
    """The same for records with ``table_name, properties``; of a repeated key the last value counts."""
    keys = records.select(
        "table_name", "properties", F.posexplode(F.array_distinct(F.json_object_keys("properties"))).alias("pos", "field_name")
    )
    shown = keys.filter(~F.col("field_name").isin(*fixed.GEOMETRY_HELPER_COLUMNS))
    parsed = F.from_json("properties", "map<string,variant>")
    return shown.select(
        "table_name", F.col("pos").cast("bigint").alias("field_ord"), "field_name",
        field_type(F.try_element_at(F.filter(F.map_entries(parsed), lambda e: e["key"] == F.col("field_name")), F.lit(-1))["value"]).alias("field_type"),
    )


def detect_geometry_type(features: DataFrame) -> DataFrame:
    """The geometry type of every table's first record with geometry; MultiPolygon when unusual."""
    first = first_rows(features, has_geometry(), "geojson")
    kind = F.try_variant_get(F.try_parse_json("geojson"), "$.type", "string")
    return first.select(
        "table_name",
        F.when(kind.isin(*fixed.GEOMETRY_TYPES), kind)
        .otherwise(fixed.DEFAULT_GEOMETRY_TYPE).alias("geometry_type"),
    )


def first_geometry_type(features: DataFrame) -> DataFrame:
    """The upper-case geometry type of every table's very first feature; null when it has none."""
    first = first_rows(features, F.lit(True), "geojson")
    kind = F.try_variant_get(F.try_parse_json("geojson"), "$.type", "string")
    return first.select("table_name", F.upper(given(kind)).alias("geometry_type"))


def layer_extent(features: DataFrame) -> DataFrame:
    """Overall box and number of features with geometry of every table."""
    return features.filter("xmin IS NOT NULL").groupBy("table_name").agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
        F.count("*").alias("n_features"),
    )


def store_features(features: DataFrame, path: str, cell_degrees: float = 4.0) -> None:
    """Write features so that a box filter skips files and row groups.

    Rows are range-partitioned and sorted by grid cell, which gives every file a narrow box.
    The feature ordinal ends the range key, so one crowded cell spreads over many files.
    """
    cell = [F.floor(F.col(c) / cell_degrees) for c in ("ymin", "xmin")]
    features.repartitionByRange(*cell, "feature_ord").sortWithinPartitions(*cell, "feature_ord").write.parquet(path)
