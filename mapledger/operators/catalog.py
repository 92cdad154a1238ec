"""Building, filtering and searching the dataset catalog.

Catalog order is (``file_only``, ``first_ord``): table-backed datasets by their first table,
then the datasets known from the listing alone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import given, tokens
from .joins import split_join
from .ranks import positions, ranked_in_groups, store_in_order, stored_page, stored_total

CATALOG_ORDER = ("file_only", "first_ord")

CATALOG_COLUMNS = (
    "dataset_id", "title", "organization", "source_type", "ckan_id", "versions_url", "is_spatial", "has_openable",
    "spatial_table", "spatial_schema", "spatial_ord", "primary_table", "primary_schema", "primary_ord",
    "est_rows", "table_count", "file_only", "first_ord",
)


def spatial_tables(columns: DataFrame) -> DataFrame:
    """The tables that have a geometry column."""
    spatial = F.lower(F.coalesce("column_type", F.lit(""))) == "geometry"
    return columns.groupBy("table_ord").agg(F.bool_or(spatial).alias("is_spatial"))


def queryable_columns(columns: DataFrame) -> DataFrame:
    """The columns that a WHERE clause can use."""
    return columns.filter(
        ~F.coalesce("column_name", F.lit("")).isin(*fixed.HIDDEN_QUERY_COLUMNS)
        & (F.lower(F.coalesce("column_type", F.lit(""))) != "geometry")
    )


def _first_named(names: Column, ordinal: Column, among: Column) -> Column:
    """The first row among ``among`` with a table name, else the last of them."""
    named = F.min_by(names, F.when(among & given(F.col("table_name")).isNotNull(), ordinal))
    return F.coalesce(named, F.max_by(names, F.when(among, ordinal)))


def build_catalog(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """One record per dataset from its table rows.

    ``spatial_ord`` and ``primary_ord`` name the table whose columns describe the dataset;
    the column lists stay in ``columns`` and join on ``table_ord``.
    """
    rows = (
        tables.filter(given(F.col("dataset_id")).isNotNull())
        .join(spatial_tables(columns), "table_ord", "left")
        .withColumn("is_spatial", F.coalesce("is_spatial", F.lit(False)))
    )
    ordinal, spatial = F.col("table_ord"), F.col("is_spatial")
    schema = F.coalesce(given(F.col("schema_name")), F.lit(fixed.DEFAULT_SCHEMA))
    names = F.struct(F.col("table_name").alias("table"), schema.alias("schema"), ordinal.alias("ord"))
    head = F.struct(
        F.coalesce("title", F.lit("")).alias("title"), "organization", "source_type", "ckan_id", "versions_url"
    )
    grouped = rows.groupBy("dataset_id").agg(
        F.min_by(head, ordinal).alias("head"),
        F.bool_or(spatial).alias("is_spatial"),
        _first_named(names, ordinal, spatial).alias("s"),
        _first_named(names, ordinal, F.lit(True)).alias("p"),
        F.sum(F.coalesce("est_rows", F.lit(0))).alias("est_rows"),
        F.count("*").alias("table_count"),
        F.min(ordinal).alias("first_ord"),
    )
    return grouped.select(
        "dataset_id", "head.*", "is_spatial", F.lit(True).alias("has_openable"),
        F.col("s.table").alias("spatial_table"), F.col("s.schema").alias("spatial_schema"),
        F.col("s.ord").alias("spatial_ord"),
        F.col("p.table").alias("primary_table"), F.col("p.schema").alias("primary_schema"),
        F.col("p.ord").alias("primary_ord"),
        "est_rows", "table_count", F.lit(False).alias("file_only"), "first_ord",
    ).select(*CATALOG_COLUMNS)


def source_format_flags(formats: DataFrame) -> DataFrame:
    """Whether a dataset's source offers a spatial or an openable format."""
    fmt = F.lower(F.coalesce("format", F.lit("")))
    return formats.groupBy("dataset_id").agg(
        F.bool_or(fmt.isin(*fixed.SPATIAL_SOURCE_FORMATS)).alias("spatial_format"),
        F.bool_or(fmt.isin(*fixed.OPENABLE_SOURCE_FORMATS)).alias("openable_format"),
    )


def file_only_flags(listing: DataFrame, formats: DataFrame) -> DataFrame:
    """Listing rows with the two guesses ``is_spatial`` and ``has_openable``."""
    scraped = F.coalesce(F.col("source_type").isin(*fixed.SPATIAL_SOURCE_TYPES), F.lit(False))
    spatial = scraped | F.coalesce("spatial_format", F.lit(False))
    return (
        listing.join(source_format_flags(formats), "dataset_id", "left")
        .withColumns({
            "is_spatial": spatial,
            "has_openable": spatial | F.coalesce("openable_format", F.lit(False)),
        })
        .drop("spatial_format", "openable_format")
    )


def file_only_datasets(listing: DataFrame, formats: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog records of the listed datasets that no table belongs to."""
    rest = [c for c in listing.columns if c != "dataset_id"]
    unseen = (
        listing.filter(given(F.col("dataset_id")).isNotNull())
        .groupBy("dataset_id")
        .agg(F.min_by(F.struct(*rest), "listing_ord").alias("l"))
        .select("dataset_id", "l.*")
        .join(catalog.select("dataset_id"), "dataset_id", "left_anti")
    )
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    return file_only_flags(unseen, formats).select(
        "dataset_id", F.coalesce("title", F.lit("")).alias("title"), "organization", "source_type", "ckan_id",
        "versions_url", "is_spatial", "has_openable",
        text.alias("spatial_table"), text.alias("spatial_schema"), number.alias("spatial_ord"),
        text.alias("primary_table"), text.alias("primary_schema"), number.alias("primary_ord"),
        F.lit(0).cast("bigint").alias("est_rows"), F.lit(0).cast("bigint").alias("table_count"),
        F.lit(True).alias("file_only"), F.col("listing_ord").alias("first_ord"),
    ).select(*CATALOG_COLUMNS)


def full_catalog(tables: DataFrame, columns: DataFrame, listing: DataFrame, formats: DataFrame) -> DataFrame:
    """Table-backed datasets first, then those known from the listing alone."""
    backed = build_catalog(tables, columns)
    # The anti join needs only the ids, which come from the table rows without the roll-up.
    return backed.unionByName(file_only_datasets(listing, formats, tables.select("dataset_id").distinct()))


def source_types(catalog: DataFrame) -> DataFrame:
    """The source types present, sorted."""
    shown = F.coalesce(given(F.col("source_type")), F.lit(fixed.NO_NAME))
    return catalog.select(shown.alias("source_type")).distinct().orderBy("source_type")


def organizations(catalog: DataFrame, source_type: str | None = None) -> DataFrame:
    """The organizations of one source type, or of every source type at once, sorted."""
    rows = catalog if source_type is None else catalog.filter(F.col("source_type") == source_type)
    shown = F.coalesce(given(F.col("organization")), F.lit(fixed.NO_NAME))
    return (
        rows.filter(F.col("source_type").isNotNull())
        .select("source_type", shown.alias("organization"))
        .distinct()
        .orderBy("source_type", "organization")
    )


def pick_gateway(tables: DataFrame) -> DataFrame:
    """The dataset of the first ckan table; one row, null when there is none."""
    usable = given(F.col("dataset_id")).isNotNull() & (F.col("source_type") == fixed.GATEWAY_SOURCE_TYPE)
    return tables.agg(F.min_by("dataset_id", F.when(usable, F.col("table_ord"))).alias("gateway_id"))


def display_mode(setting) -> int:
    """A display-mode setting as a number; 2 when it is none."""
    try:
        return int(setting)
    except (TypeError, ValueError):
        return fixed.DEFAULT_DISPLAY_MODE


def visible_in_mode(catalog: DataFrame, mode) -> DataFrame:
    """The datasets that a display mode shows."""
    level = display_mode(mode)
    if level <= 1:
        return catalog.filter("is_spatial")
    return catalog.filter("has_openable") if level == 2 else catalog


def sort_by_title(catalog: DataFrame) -> DataFrame:
    """By lower-case title, catalog order among equals: one range-partitioned sort."""
    return catalog.orderBy(F.lower(F.coalesce("title", F.lit(""))), *CATALOG_ORDER)


def title_places(catalog: DataFrame) -> DataFrame:
    """The catalog with ``rank``, its place by title from 1."""
    placed = positions(catalog, F.lower(F.coalesce("title", F.lit(""))), *CATALOG_ORDER)
    return placed.withColumn("rank", F.col("position") + 1).drop("position")


def datasets(
    catalog: DataFrame, source_type: str | None = None, organization: str | None = None, mode=3
) -> DataFrame:
    """The datasets of a source type and organization that a mode shows, by title."""
    rows = catalog
    if source_type is not None:
        rows = rows.filter(F.col("source_type") == source_type)
    if organization is not None:
        rows = rows.filter(F.coalesce(given(F.col("organization")), F.lit(fixed.NO_NAME)) == organization)
    return sort_by_title(visible_in_mode(rows, mode))


def _title_matches(title: Column, words: list[str]) -> Column:
    found = F.lit(True)
    for word in words:
        found = found & F.lower(title).contains(word)
    return found


def search_titles(
    rows: DataFrame,
    text: str,
    limit: int | None = None,
    spatial_only: bool = False,
    title: str = "title",
    order: tuple[str, ...] = CATALOG_ORDER,
) -> DataFrame:
    """The rows, in order, whose title holds every word of ``text``; the first ``limit`` if one is named."""
    words = tokens(text)
    if not words:
        return rows.limit(0)
    found = rows.filter("is_spatial") if spatial_only else rows
    matching = found.filter(_title_matches(F.coalesce(title, F.lit("")), words)).orderBy(*order)
    return matching if limit is None else matching.limit(limit)


def search_many(
    rows: DataFrame,
    texts: list[str],
    limit: int | None = None,
    title: str = "title",
    order: tuple[str, ...] = CATALOG_ORDER,
) -> DataFrame:
    """The same for several search texts in one scan: ``query_no``, rank and the row.

    A row is kept once per text it matches, so nothing is paired up front. A per-text limit is
    applied before the shuffle, so a text that matches everything stays cheap; without one all
    matches are ranked by a range-partitioned sort, which spreads such a text over tasks.
    """
    wanted = [
        F.when(_title_matches(F.coalesce(title, F.lit("")), words), F.lit(number).cast("bigint"))
        for number, words in enumerate(map(tokens, texts))
        if words
    ]
    if not wanted:
        return rows.limit(0).withColumns({"query_no": F.lit(0).cast("bigint"), "rank": F.lit(0).cast("bigint")})
    hits = rows.withColumn("query_no", F.explode(F.array_compact(F.array(*wanted))))
    if limit is None:
        return ranked_in_groups(hits, ["query_no"], list(order))
    return first_per_group(hits, ["query_no"], list(order), limit)


def first_per_group(rows: DataFrame, keys: list[str], order: list, limit: int, slices: int = 256) -> DataFrame:
    """The first ``limit`` rows of every group with their ``rank``.

    A group is first cut into slices that are ranked apart; only ``slices * limit`` rows of
    a group meet in one task, however many it has.
    """
    spread = F.pmod(F.xxhash64(*[c for c in order if isinstance(c, str)]), F.lit(slices))
    local = Window.partitionBy(*keys, "slice").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("slice", spread)
        .withColumn("rank", F.row_number().over(local))
        .filter(F.col("rank") <= limit)
        .drop("slice")
        .withColumn("rank", F.row_number().over(final).cast("bigint"))
        .filter(F.col("rank") <= limit)
    )


def route_search(catalog: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    """What a search box shows: nothing under two characters, one dataset for an id, else titles.

    The id test ignores case, the lookup does not.
    """
    typed = (text or "").strip()
    if len(typed) < fixed.SHORTEST_SEARCH:
        return catalog.limit(0)
    if re.match(fixed.UUID_PATTERN, typed):
        return catalog.filter(F.col("dataset_id") == typed)
    return search_titles(catalog, typed, limit)


def _listed(catalog: DataFrame, source_type, organization, tag, query) -> DataFrame:
    rows = catalog
    if source_type:
        rows = rows.filter(F.col("source_type") == source_type)
    if organization:
        rows = rows.filter(F.col("organization") == organization)
    if tag:
        rows = rows.filter(F.array_contains("tags", tag))
    if query:
        rows = rows.filter(F.lower("title").contains(query.lower()))
    return rows


def _as_page(page: DataFrame, total: DataFrame, limit: int | None, offset: int) -> DataFrame:
    # The total is one row, so this attaches a constant.
    return page.withColumns({
        "total": total.scalar(),
        "limit": F.lit(limit).cast("bigint"),
        "offset": F.lit(offset).cast("bigint"),
    })


def list_datasets(
    catalog: DataFrame,
    limit: int | None = None,
    offset: int = 0,
    source_type: str | None = None,
    organization: str | None = None,
    tag: str | None = None,
    query: str | None = None,
) -> DataFrame:
    """One page of the filtered catalog, or all of it; ``total`` counts all matching datasets.

    ``tag`` needs an array column ``tags``; ``query`` is a case-insensitive part of the title. Only
    the rows of the page are gathered, however deep it lies; for page after page see ``store_listing``.
    """
    rows = _listed(catalog, source_type, organization, tag, query)
    if offset:
        wanted = positions(rows, *CATALOG_ORDER).filter(F.col("position") >= offset)
        page = (wanted if limit is None else wanted.filter(F.col("position") < offset + limit)).drop("position")
        page = page.orderBy(*CATALOG_ORDER)
    else:
        page = rows.orderBy(*CATALOG_ORDER)
        page = page if limit is None else page.limit(limit)
    return _as_page(page, rows.agg(F.count("*").alias("total")), limit, offset)


def store_listing(
    catalog: DataFrame,
    source_type: str | None = None,
    organization: str | None = None,
    tag: str | None = None,
    query: str | None = None,
    rows_per_file: int = 1_000_000,
) -> str:
    """Order the filtered catalog once for all its pages; returns the path that ``stored_listing_page`` takes."""
    return store_in_order(_listed(catalog, source_type, organization, tag, query), *CATALOG_ORDER, rows_per_file=rows_per_file)


def stored_listing_page(spark: SparkSession, path: str, limit: int, offset: int = 0) -> DataFrame:
    """The page that ``list_datasets`` returns, from a stored listing: its directory and the files of the page are read."""
    return _as_page(stored_page(spark, path, limit, offset).drop("position"), stored_total(spark, path), limit, offset)


def top_datasets(catalog: DataFrame, cap: int | None = None) -> DataFrame:
    """The datasets by title of every source type and organization, ranked; the first ``cap`` if one is named.

    ``overflow``, how many more there are, repeats on every row of its group.
    """
    keys = ["source_type", "organization"]
    rows = catalog.withColumns({
        "source_type": F.coalesce(given(F.col("source_type")), F.lit(fixed.NO_NAME)),
        "organization": F.coalesce(given(F.col("organization")), F.lit(fixed.NO_NAME)),
        "title_key": F.lower(F.coalesce("title", F.lit(""))),
    })
    order = ["title_key", *CATALOG_ORDER]
    if cap is None:
        return ranked_in_groups(rows, keys, order).drop("title_key").withColumn("overflow", F.lit(0).cast("bigint"))
    counts = rows.groupBy(*keys).agg(F.greatest(F.count("*") - cap, F.lit(0)).alias("overflow"))
    top = first_per_group(rows, keys, order, cap)
    return split_join(top.drop("title_key"), counts, keys)


def table_fallback(catalog: DataFrame) -> DataFrame:
    """The datasets without geometry whose first table can be loaded as plain rows."""
    return catalog.filter(~F.col("is_spatial") & given(F.col("primary_table")).isNotNull())
