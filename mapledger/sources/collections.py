"""Large GeoJSON files, read by many tasks.

A FeatureCollection is cut at every closing brace, which Spark's text source does by byte ranges. Whether
such a piece begins inside a string, and how deep, follows from sums over the pieces before it: sums within a
block are taken by the tasks, and one row for each block carries them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written
from .payloads import feature_columns

_OPENING = r'"features"\s*+:\s*+\['
_CLOSED_AT_ONCE = r"\A[^\[{\]]*+\]"
PLACE = ["file", "block", "place"]


def _bare(text: Column) -> Column:
    """``text`` without escaped characters."""
    return F.regexp_replace(text, r"(?s)\\.", "")


def _quotes(bare: Column) -> Column:
    return F.length(bare) - F.length(F.translate(bare, '"', ""))


def _structure(bare: Column, inside: bool | Column) -> Column:
    """What is outside strings in a text that begins inside one or not."""
    if isinstance(inside, bool):
        outside = F.regexp_replace(bare, r'\A[^"]*+"?+', "") if inside else bare
        return F.regexp_replace(outside, r'"[^"]*+"?+', "")
    return F.when(inside, _structure(bare, True)).otherwise(_structure(bare, False))


def _unsent(rows: DataFrame) -> DataFrame:
    """``rows`` with a row for many pieces, for a join that may not broadcast either side: stored pieces are compressed, so
    Spark takes them for small, and a broadcast of them is put together in the driver's memory."""
    return rows.hint("merge")


def _gain(structure: Column) -> Column:
    """Brackets opened less brackets closed."""
    opened, closed = (F.length(structure) - F.length(F.translate(structure, c, "")) for c in ("{[", "]"))
    return opened - closed


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Texts between closing braces, with their quotes and, for a start outside (0) and inside (1) a string, the
    change of depth and whether a bracket is closed before one is opened."""
    cut = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("table_name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), "value",
        _bare(F.col("value")).alias("bare"),
    )
    counted = cut.withColumns({
        "quotes": _quotes(F.col("bare")), "s0": _structure(F.col("bare"), False), "s1": _structure(F.col("bare"), True),
    })
    return counted.select(
        *PLACE, "table_name", "value", "quotes",
        *[(_gain(F.col(f"s{n}")) - F.when(F.col("quotes") % 2 == n, 1).otherwise(0)).alias(f"gain{n}") for n in (0, 1)],
        *[F.col(f"s{n}").rlike(_CLOSED_AT_ONCE).alias(f"closes{n}") for n in (0, 1)],
    )


_BEFORE = (Window.unboundedPreceding, -1)


def _in_block() -> Window:
    return Window.partitionBy("file", "block").orderBy("place").rowsBetween(*_BEFORE)


def _blocks() -> Window:
    return Window.partitionBy("file").orderBy("block").rowsBetween(*_BEFORE)


def _so_far(value: Column, window: Window) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _chosen(odd: Column, even_value: str, odd_value: str) -> Column:
    return F.when(odd, F.col(odd_value)).otherwise(F.col(even_value))


def _with_state(pieces: DataFrame) -> DataFrame:
    """Pieces with ``inside``, whether they begin in a string, and ``depth``, that at their begin."""
    local = pieces.withColumn("odd", _so_far(F.col("quotes"), _in_block()) % 2 == 1).withColumns({
        "gain_even": _chosen(F.col("odd"), "gain0", "gain1"), "gain_odd": _chosen(F.col("odd"), "gain1", "gain0"),
    })
    sums = local.groupBy("file", "block").agg(*[F.sum(c).alias(c) for c in ("quotes", "gain_even", "gain_odd")])
    starts = sums.withColumn("starts_odd", _so_far(F.col("quotes"), _blocks()) % 2 == 1).withColumn(
        "starts_at", _so_far(_chosen(F.col("starts_odd"), "gain_even", "gain_odd"), _blocks())
    )
    known = _unsent(local).join(starts.select("file", "block", "starts_odd", "starts_at"), ["file", "block"])
    known = known.withColumn("gain", _chosen(F.col("starts_odd"), "gain_even", "gain_odd"))
    return known.withColumns({
        "inside": F.col("odd") != F.col("starts_odd"),
        "depth": F.col("starts_at") + _so_far(F.col("gain"), _in_block()),
    }).drop("odd", "gain_even", "gain_odd", "starts_odd", "starts_at")


def _after_opening(text: Column, inside: Column, depth: Column) -> Column:
    """What follows the bracket of the outermost ``features`` list in a piece that opens it, else null."""
    parts = F.split(text, _OPENING)
    mark = '"features":['

    def outermost(i: Column) -> Column:
        bare = _bare(F.array_join(F.slice(parts, F.lit(1), i), mark))
        outside = (F.when(inside, 1).otherwise(0) + _quotes(bare)) % 2 == 0
        return outside & (depth + _gain(_structure(bare, inside)) == 1)

    places = F.when(F.size(parts) > 1, F.filter(F.sequence(F.lit(1), F.size(parts) - 1), outermost))
    first = F.try_element_at(places, F.lit(1))
    return F.when(first.isNotNull(), F.array_join(F.slice(parts, first + 1, F.size(parts)), mark))


def collection_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of FeatureCollection files: ``table_name, page_no, page_pos, properties, geojson``.

    A file of any size is read by as many tasks as it has blocks; a task holds one feature at a time.
    ``page_pos`` counts the objects of the outermost ``features`` list; a file without one has no rows, and
    what a file that breaks off has of its last feature is left out. Files are in UTF-8.
    """
    pieces = written(_pieces(spark, path), "collection-pieces")
    # Texts stay behind, but for the few that name the list.
    opener = F.when(F.col("value").contains('"features"'), F.col("value")).alias("opener")
    state = _with_state(_unsent(pieces.drop("table_name", "value")).join(
        pieces.select(*PLACE, opener).filter("opener IS NOT NULL"), PLACE, "left"))
    rest = _after_opening(F.col("opener"), F.col("inside"), F.col("depth"))
    state = state.withColumn("rest", rest)
    real = F.col("inside") == (F.col("quotes") % 2 == 1)
    closed_at_once = _structure(_bare(F.col("rest")), False).rlike(_CLOSED_AT_ONCE)
    state = written(state.select(
        *PLACE, "rest", (F.col("rest").isNotNull() & ~closed_at_once).alias("opens"),
        ((F.col("depth") == 2) & _chosen(F.col("inside"), "closes0", "closes1")).alias("closes"),
        (real & (F.col("depth") + F.col("gain") == 2)).alias("ends"),
    ), "collection-states")
    at = F.struct("block", "place")
    opened = state.filter("opens").groupBy("file").agg(F.min(at).alias("opened_at"))
    closed = state.filter("closes").select("file", at.alias("at")).join(opened, "file").filter("at > opened_at")
    bounds = opened.join(closed.groupBy("file").agg(F.min("at").alias("closed_at")), "file", "left")
    # One row for each block of a file, so that a large file is no hot key.
    listed = _unsent(state).join(state.select("file", "block").distinct().join(bounds, "file"), ["file", "block"]).filter(
        (at >= F.col("opened_at")) & F.coalesce(at < F.col("closed_at"), F.lit(True))
    )
    ended = F.when(F.col("ends"), 1).otherwise(0)
    ahead = listed.groupBy("file", "block").agg(F.sum(ended).alias("n")).select(
        "file", "block", _so_far(F.col("n"), _blocks()).alias("ahead")
    )
    numbered = _unsent(listed).join(ahead, ["file", "block"]).select(
        *PLACE, F.when(F.col("opens"), F.col("rest")).alias("rest"), "ends",
        (F.col("ahead") + _so_far(ended, _in_block())).alias("page_pos"),
    )
    parts = _unsent(pieces.select(*PLACE, "table_name", "value")).join(numbered, PLACE)
    whole = parts.groupBy("file", "table_name", "page_pos").agg(
        F.sort_array(F.collect_list(F.struct("block", "place", F.coalesce("rest", "value").alias("text")))).alias("parts"),
        F.bool_or("ends").alias("complete"),
    ).filter("complete")
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["text"]), "}"), F.lit("}"))
    feature = F.from_json(F.regexp_replace(text, r"\A[^{]*+", ""), "STRUCT<properties STRING, geometry STRING>")
    rows = whole.select("table_name", F.lit(0).cast("bigint").alias("page_no"), F.col("page_pos").cast("bigint"), feature.alias("f"))
    return rows.select("table_name", "page_no", "page_pos", *feature_columns(F.col("f")))
