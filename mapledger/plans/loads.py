"""Loading one table's rows as a typed result: by box, by WHERE clause or by free SQL.

Result columns keep their names. Where two names are equal but for case, or one equals an engine column's, the
later one gets ``_2``, ``_3`` and so on; engine columns come first, but for ``truncated``, which comes last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, geometry
from ..operators import features as feature_ops
from ..session import written
from ..sources.results import materialize_result

# Types in the order of widening; text holds every value.
WIDER = {"BIGINT": "DOUBLE", "DOUBLE": "DECIMAL", "DECIMAL": "STRING", "BOOLEAN": "STRING"}
WHOLE_NUMBER = r"^[+-]?[0-9]+(\.0+)?$"
# A text that a number is written as, in one way only.
PLAIN_NUMBER = r"^(?!-0$)-?(0|[1-9][0-9]*)(\.[0-9]*[1-9])?$"


class LoadError(Exception):
    """Nothing to load."""


def free_names(names: list[str], taken: tuple[str, ...] = ()) -> list[str]:
    """``names``, each changed where it equals an earlier or taken one but for case."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        free, n = name, 1
        while free.lower() in used:
            n += 1
            free = f"{name}_{n}"
        used.add(free.lower())
        out.append(free)
    return out


def _value(records: Column, name: str) -> Column:
    """The value of an exact key, the last one if it is repeated."""
    return F.try_element_at(F.filter(F.map_entries(records), lambda e: e["key"] == name), F.lit(-1))["value"]


def _text(value: Column) -> Column:
    """A value as text; objects and lists as JSON; null for JSON null and missing keys."""
    kind = F.schema_of_variant(value)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(nested, F.to_json(value)).otherwise(F.try_variant_get(value, "$", "string"))


def _converted(text: Column, kind: str) -> Column:
    """A value's text in a type; null if the type cannot hold it."""
    if kind == "BIGINT":
        return F.when(text.rlike(WHOLE_NUMBER), F.regexp_replace(text, r"\.0+$", "").try_cast("bigint"))
    if kind == "BOOLEAN":
        return F.when(text.isin("true", "false"), text == "true")
    return text if kind == "STRING" else text.try_cast("decimal(38,18)" if kind == "DECIMAL" else kind)


def _fits(value: Column, kind: str) -> Column:
    """Whether a value comes back from a type as the same number, or, if it is a text, as the same text."""
    text, own = _text(value), F.schema_of_variant(value)
    typed = _converted(text, kind)
    is_text = own == "STRING"
    if kind == "BOOLEAN":
        fits = typed.isNotNull()
    elif kind == "BIGINT":
        fits = typed.isNotNull() & (~is_text | (typed.cast("string") == text))
    elif kind == "DECIMAL":
        fits = typed.isNotNull() & text.rlike(r"^-?[0-9]{1,20}(\.[0-9]{1,18}0*)?$") & (~is_text | text.rlike(PLAIN_NUMBER))
    else:
        shown = typed.cast("string")  # the shortest text that names the double

        def equal(scale: int) -> Column:
            return shown.try_cast(f"decimal(38,{scale})") == text.try_cast(f"decimal(38,{scale})")

        exact = equal(18) & F.when(F.abs(typed) < 1, equal(37)).otherwise(True)
        # A number written with an exponent is a double in the first place.
        fits = F.when(is_text, text.rlike(PLAIN_NUMBER) & exact).when(own.isin("DOUBLE", "FLOAT"), F.abs(typed) < float("inf")).otherwise(exact)
    return text.isNull() | F.coalesce(fits, F.lit(False))


def widened_fields(rows: DataFrame, fields: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """``fields`` with types that give the values of all rows back: a whole number widens to a double, where that is not
    exact to a decimal, and what does not fit either to text. One aggregate over all fields; one row comes to the driver."""
    records = F.from_json("properties", "map<string,variant>")
    checks = []
    for place, (name, kind) in enumerate(fields):
        while kind != "STRING":
            fits = F.bool_and(_fits(_value(F.col("r"), name), kind))
            checks.append(F.coalesce(fits, F.lit(True)).alias(f"{place}_{kind}"))
            kind = WIDER[kind]
    if not checks:
        return fields
    fits = rows.select(records.alias("r")).agg(*checks).head().asDict()
    out = []
    for place, (name, kind) in enumerate(fields):
        while kind != "STRING" and not fits[f"{place}_{kind}"]:
            kind = WIDER[kind]
        out.append((name, kind))
    return out


def typed_records(fields: list[tuple[str, str]], names: list[str]) -> list[Column]:
    """The attribute columns of JSON records, by exact key and type, under ``names``."""
    records = F.from_json("properties", "map<string,variant>")
    return [_converted(_text(_value(records, key)), kind).alias(name) for (key, kind), name in zip(fields, names, strict=True)]


def first_fields(rows: DataFrame) -> list[tuple[str, str]]:
    """Name and type of the attributes of the first row; no row is an error. One record comes to the driver."""
    first = rows.agg(F.count("*").alias("n"), F.min_by("properties", "feature_ord").alias("properties")).head()
    if not first.n:
        raise LoadError("no rows returned")
    record = rows.sparkSession.createDataFrame([("", first.properties)], "table_name STRING, properties STRING")
    fields = feature_ops.record_fields(record.filter("properties IS NOT NULL")).orderBy("field_ord").collect()
    return [(row.field_name, row.field_type) for row in fields]


def declared_columns(catalog_columns: DataFrame, table_ord: int) -> list[tuple[str, str]]:
    """The columns a WHERE clause on a table can use, from the catalog, in types of values."""
    kinds = {
        "bigint": "BIGINT", "integer": "BIGINT", "int": "BIGINT", "smallint": "BIGINT", "numeric": "DOUBLE",
        "double precision": "DOUBLE", "double": "DOUBLE", "real": "DOUBLE", "float": "DOUBLE", "boolean": "BOOLEAN",
    }
    from ..operators.catalog import queryable_columns

    own = queryable_columns(catalog_columns.filter(F.col("table_ord") == table_ord)).orderBy("col_ord")
    return [(c.column_name, kinds.get((c.column_type or "").lower(), "STRING")) for c in own.collect()]


def _selected(rows: DataFrame, where: str | None, columns: list[tuple[str, str]] | None) -> DataFrame:
    """Rows that a WHERE clause over the table's own columns keeps.

    The columns are the declared ones, else those of the first record there is, and widened so that no value is
    lost. Relation columns can be used too where no attribute has their name.
    """
    if not where:
        return rows
    described = rows.filter("properties IS NOT NULL")
    if not columns and described.isEmpty():
        return described
    fields = widened_fields(rows, columns if columns else first_fields(described))
    names = free_names([name for name, _ in fields])
    taken = {name.lower() for name in names}
    whole = F.struct(*rows.columns).alias("engine_row")
    others = [c for c in rows.columns if c.lower() not in taken]
    typed = rows.select(whole, *typed_records(fields, names), *others)
    return feature_ops.where_fragment(typed, where).select("engine_row.*")


def _typed(rows: DataFrame, row_cap: int | None, route: str, spatial: bool) -> DataFrame:
    fields = widened_fields(rows, first_fields(rows))
    records = rows.withColumn("truncated", F.lit(False)) if row_cap is None else feature_ops.capped(rows, row_cap, route)
    engine = ("feature_ord", fixed.GEOJSON_COLUMN, "truncated") if spatial else ("feature_ord", "truncated")
    names = free_names([name for name, _ in fields], engine)
    shape = [F.col("geojson").alias(fixed.GEOJSON_COLUMN)] if spatial else []
    return records.select("feature_ord", *typed_records(fields, names), *shape, "truncated")


def load_layer(
    features: DataFrame,
    table: str,
    name: str,
    bbox: tuple[float, float, float, float] | None = None,
    where: str | None = None,
    row_cap: int | None = None,
    columns: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """A spatial table as a layer, registered under ``name``; all of it unless a ``row_cap`` is named.

    With a WHERE clause the box is exact, without one it is an overlap of boxes, and the cap flag follows
    the route of either. Attributes are those of the first row, in types that hold the values of all rows.
    """
    if not table:
        raise LoadError("dataset has no spatial table")
    rows = features.filter(F.col("table_name") == table)
    if where:
        rows = rows if bbox is None else feature_ops.intersects_box(rows, bbox)
        rows = _selected(rows, where, columns)
    elif bbox is not None:
        rows = feature_ops.bbox_overlap(rows, bbox)
    return materialize_result(_typed(rows, row_cap, "sql" if where else "features", True), name, spatial=True)


def load_table(
    features: DataFrame,
    table: str,
    name: str,
    where: str | None = None,
    row_cap: int | None = None,
    columns: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """A table's attributes without geometry, registered under ``name``; all rows unless a ``row_cap`` is named."""
    if not table:
        raise LoadError("dataset has no datastore table")
    rows = _selected(features.filter(F.col("table_name") == table), where, columns)
    return materialize_result(_typed(rows, row_cap, "sql", False), name, spatial=False)


def register_tables(spark: SparkSession, tables: dict[tuple[str, str], str]) -> None:
    """Make Parquet tables readable in free SQL as ``"schema"."table"``."""
    for (schema, table), path in tables.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
        spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{table}` AS SELECT * FROM parquet.`{path}`")


def register_spatial_functions(spark: SparkSession, schema: str = "extensions") -> None:
    """``ST_AsGeoJSON``, ``ST_MakeEnvelope`` and ``ST_Intersects`` for free SQL."""
    box = "STRUCT<xmin: DOUBLE, ymin: DOUBLE, xmax: DOUBLE, ymax: DOUBLE>"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    spark.sql(
        f"CREATE OR REPLACE FUNCTION `{schema}`.ST_AsGeoJSON(g STRING) RETURNS STRING RETURN g"
    )
    spark.sql(
        f"CREATE OR REPLACE FUNCTION `{schema}`.ST_MakeEnvelope"
        f"(x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, srid INT) RETURNS {box}"
        " RETURN named_struct('xmin', x0, 'ymin', y0, 'xmax', x1, 'ymax', y1)"
    )
    sides = (f"box.{name}" for name in geometry.BOX)
    spark.sql(
        f"CREATE OR REPLACE FUNCTION `{schema}`.ST_Intersects(g STRING, box {box}) RETURNS BOOLEAN"
        f" RETURN {geometry.intersects_sql('g', *sides)}"
    )


def load_free_query(spark: SparkSession, sql: str, name: str, cap: int | None = None) -> DataFrame:
    """The rows of a user's query, or the first ``cap`` of them, with ``truncated``, registered under ``name``.

    The text stands in a FROM clause, so that anything but a query fails to parse. It runs once: its rows
    are stored, and the flag, the kind of result and all later reads come from there.
    """
    body = sql.strip().rstrip(";")
    limit = "" if cap is None else f" LIMIT {cap + 1}"
    with feature_ops.quoted_identifiers(spark):
        rows = spark.sql(f"SELECT * FROM (\n{body}\n) q{limit}")
        rows.schema  # analysed while the setting holds
    names = free_names(rows.columns)
    flag = free_names(["truncated"], tuple(names))[0]
    plain = rows.toDF(*(f"c{i}" for i in range(len(names))))
    plain = plain.withColumns({c: F.col(c).cast("string") for c, kind in plain.dtypes if kind == "void"})
    stored = written(plain.withColumn("row_place", F.monotonically_increasing_id()), "free-query")
    result = stored if cap is None else stored.orderBy("row_place").limit(cap)
    more = F.lit(False) if cap is None else stored.agg(F.count("*") > cap).scalar()
    shown = result.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)), more.alias(flag))
    return materialize_result(shown, name, stored=True)
