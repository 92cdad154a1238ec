"""Queries over the dataset catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger.functions import fixed
from mapledger.operators import catalog as ops
from mapledger.operators import search
from mapledger.plans.contents import dataset_contents

from . import duck
from .registry import registered


def full_catalog(r):
    return ops.full_catalog(
        r("catalog_tables"), r("catalog_columns"), r("dataset_listing"), r("dataset_source_formats")
    )


SHOWN = ("dataset_id", "title", "organization", "source_type", "is_spatial", "has_openable", "file_only", "first_ord")
COLUMNS = ", ".join(SHOWN)


@registered(
    "build_catalog",
    f"WITH {duck.CATALOG} SELECT * FROM backed",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.build_catalog(r("catalog_tables"), r("catalog_columns"))


@registered("full_catalog", f"WITH {duck.CATALOG} SELECT * FROM catalog", duck.CATALOG_NEEDS)
def _(r):
    return full_catalog(r)


@registered("file_only_datasets", f"WITH {duck.CATALOG} SELECT * FROM filed", duck.CATALOG_NEEDS)
def _(r):
    backed = r("catalog_tables").filter("dataset_id <> ''").select("dataset_id").distinct()
    return ops.file_only_datasets(r("dataset_listing"), r("dataset_source_formats"), backed)


@registered(
    "file_only_flags",
    f"WITH {duck.CATALOG} SELECT dataset_id, is_spatial, has_openable FROM flagged",
    duck.CATALOG_NEEDS,
)
def _(r):
    flagged = ops.file_only_flags(r("dataset_listing"), r("dataset_source_formats"))
    return flagged.select("dataset_id", "is_spatial", "has_openable")


@registered(
    "spatial_tables",
    "SELECT table_ord, bool_or(lower(column_type) = 'geometry') AS is_spatial FROM catalog_columns GROUP BY table_ord",
    ("catalog_columns",),
)
def _(r):
    return ops.spatial_tables(r("catalog_columns"))


@registered(
    "queryable_columns",
    "SELECT * FROM catalog_columns WHERE column_name NOT IN ('geom','geometry_wkt') AND lower(column_type) <> 'geometry'",
    ("catalog_columns",),
)
def _(r):
    return ops.queryable_columns(r("catalog_columns"))


@registered(
    "source_types",
    f"WITH {duck.CATALOG} SELECT DISTINCT coalesce(nullif(source_type,''),'—') AS source_type FROM catalog",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.source_types(full_catalog(r))


@registered(
    "organizations",
    f"WITH {duck.CATALOG} SELECT DISTINCT source_type, coalesce(nullif(organization,''),'—') AS organization FROM catalog WHERE source_type IS NOT NULL",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.organizations(full_catalog(r))


@registered(
    "pick_gateway",
    "SELECT dataset_id AS gateway_id FROM catalog_tables WHERE source_type = 'ckan' AND coalesce(dataset_id,'') <> '' ORDER BY table_ord LIMIT 1",
    ("catalog_tables",),
)
def _(r):
    return ops.pick_gateway(r("catalog_tables"))


@registered("visible_spatial", f"WITH {duck.CATALOG} SELECT {COLUMNS} FROM catalog WHERE is_spatial", duck.CATALOG_NEEDS)
def _(r):
    return ops.visible_in_mode(full_catalog(r), 1).select(*SHOWN)


@registered(
    "visible_openable", f"WITH {duck.CATALOG} SELECT {COLUMNS} FROM catalog WHERE has_openable", duck.CATALOG_NEEDS
)
def _(r):
    return ops.visible_in_mode(full_catalog(r), "not a number").select(*SHOWN)


@registered(
    "datasets_by_source",
    f"WITH {duck.CATALOG} SELECT {COLUMNS} FROM catalog WHERE source_type = 'ckan' AND has_openable",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.datasets(full_catalog(r), source_type="ckan", mode=2).select(*SHOWN)


@registered(
    "datasets_without_organization",
    f"WITH {duck.CATALOG} SELECT {COLUMNS} FROM catalog WHERE coalesce(nullif(organization,''),'—') = '—'",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.datasets(full_catalog(r), organization="—").select(*SHOWN)


@registered(
    "sort_by_title",
    f"WITH {duck.CATALOG} SELECT {COLUMNS}, row_number() OVER (ORDER BY lower(coalesce(title,'')), file_only, first_ord) AS rank FROM catalog",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.title_places(full_catalog(r)).select(*SHOWN, "rank")


@registered(
    "search_titles",
    f"""WITH {duck.CATALOG} SELECT {COLUMNS} FROM catalog WHERE contains(lower(title),'אנדרטאות') AND contains(lower(title),'רמת')
        AND contains(lower(title),'הנגב') ORDER BY file_only, first_ord LIMIT 25""",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.search_titles(full_catalog(r), "אנדרטאות רמת הנגב", fixed.SEARCH_LIMIT).select(*SHOWN)


@registered(
    "search_titles_spatial",
    f"WITH {duck.CATALOG} SELECT {COLUMNS} FROM catalog WHERE is_spatial AND contains(lower(title),'bus') ORDER BY file_only, first_ord LIMIT 25",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.search_titles(full_catalog(r), "BUS", fixed.SEARCH_LIMIT, spatial_only=True).select(*SHOWN)


SEARCHES = ["the", "the email", "Ring  RED", "שלום", "que le", "  "]


def _search_twin(rows: str, text: str, key: str, capped: bool = True) -> str:
    parts = []
    for number, search in enumerate(SEARCHES):
        words = search.lower().split()
        if words:
            test = " AND ".join(f"contains(lower({text}),'{w}')" for w in words)
            parts.append(f"SELECT cast({number} AS bigint) AS query_no, {key} FROM {rows} WHERE {test}")
    return (
        f"SELECT query_no, {key}, row_number() OVER (PARTITION BY query_no ORDER BY {key}) AS rank FROM ({' UNION ALL '.join(parts)}) x"
        + (f" QUALIFY row_number() OVER (PARTITION BY query_no ORDER BY {key}) <= 25" if capped else "")
    )


@registered("search_documents", _search_twin("documents", "text", "doc_id"))
def _(r):
    found = ops.search_many(r("documents").select("doc_id", "text"), SEARCHES, fixed.SEARCH_LIMIT, title="text", order=("doc_id",))
    return found.select("query_no", "doc_id", "rank")


@registered("search_documents_all", _search_twin("documents", "text", "doc_id", capped=False))
def _(r):
    found = ops.search_many(r("documents").select("doc_id", "text"), SEARCHES, title="text", order=("doc_id",))
    return found.select("query_no", "doc_id", "rank")


@registered("search_many", _search_twin("catalog_tables", "title", "table_ord"), ("catalog_tables",))
def _(r):
    found = ops.search_many(r("catalog_tables"), SEARCHES, fixed.SEARCH_LIMIT, order=("table_ord",))
    return found.select("query_no", "table_ord", "rank")


def _table_twin(capped: bool) -> str:
    cut = " QUALIFY rank <= 25" if capped else ""
    return f"""WITH q AS (SELECT table_ord AS text_id, string_split(title,' ')[1]||'  '||upper(substr(coalesce(string_split(title,' ')[2],''),1,2)) AS text FROM catalog_tables),
        w AS (SELECT text_id, [x FOR x IN string_split(lower(text),' ') IF x <> ''] AS words FROM q)
        SELECT w.text_id, t.table_ord, row_number() OVER (PARTITION BY w.text_id ORDER BY t.table_ord) AS rank FROM w, catalog_tables t
        WHERE len(w.words) > 0 AND len([x FOR x IN w.words IF contains(lower(t.title), x)]) = len(w.words){cut}"""


def _table_search(r, limit: int | None):
    """The first word of every title and the beginning of the second, searched in all titles."""
    words = F.split("title", " ", -1)
    begun = F.upper(F.substring(F.coalesce(F.get(words, F.lit(1)), F.lit("")), 1, 2))
    texts = r("catalog_tables").select(F.col("table_ord").alias("text_id"), F.concat(F.get(words, F.lit(0)), F.lit("  "), begun).alias("text"))
    found = search.search_table(r("catalog_tables").select("table_ord", "title"), texts, limit, order=("table_ord",))
    return found.select("text_id", "table_ord", "rank")


@registered("search_table", _table_twin(True), ("catalog_tables",))
def _(r):
    return _table_search(r, fixed.SEARCH_LIMIT)


@registered("search_table_all", _table_twin(False), ("catalog_tables",))
def _(r):
    return _table_search(r, None)


@registered(
    "route_search_text",
    f"""WITH {duck.CATALOG} SELECT {COLUMNS} FROM catalog WHERE contains(lower(title),'red') AND contains(lower(title),'ring')
        ORDER BY file_only, first_ord LIMIT 25""",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.route_search(full_catalog(r), " ring RED ", fixed.SEARCH_LIMIT).select(*SHOWN)


KNOWN_ID = "d93fa3b2-5f83-f202-cc51-257eee2c9207"


@registered(
    "route_search_id", f"WITH {duck.CATALOG} SELECT {COLUMNS} FROM catalog WHERE dataset_id = '{KNOWN_ID}'", duck.CATALOG_NEEDS
)
def _(r):
    return ops.route_search(full_catalog(r), KNOWN_ID).select(*SHOWN)


@registered(
    "list_datasets",
    f"""WITH {duck.CATALOG}, m AS (SELECT * FROM catalog WHERE source_type = 'ckan' AND contains(lower(title),'customer'))
        SELECT {COLUMNS}, (SELECT count(*) FROM m) AS total, cast(50 AS bigint) AS "limit", cast(10 AS bigint) AS "offset"
        FROM m ORDER BY file_only, first_ord LIMIT 50 OFFSET 10""",
    duck.CATALOG_NEEDS,
)
def _(r):
    page = ops.list_datasets(full_catalog(r), 50, 10, source_type="ckan", query="Customer")
    return page.select(*SHOWN, "total", "limit", "offset")


@registered(
    "list_datasets_stored",
    f"""WITH {duck.CATALOG}, m AS (SELECT * FROM catalog WHERE contains(lower(title),'customer'))
        SELECT {COLUMNS}, (SELECT count(*) FROM m) AS total, cast(40 AS bigint) AS "limit", cast(25 AS bigint) AS "offset"
        FROM m ORDER BY file_only, first_ord LIMIT 40 OFFSET 25""",
    duck.CATALOG_NEEDS,
)
def _(r):
    path = ops.store_listing(full_catalog(r), query="Customer", rows_per_file=50)
    return ops.stored_listing_page(r.spark, path, 40, 25).select(*SHOWN, "total", "limit", "offset")


@registered(
    "list_datasets_all",
    f"""WITH {duck.CATALOG}, m AS (SELECT * FROM catalog WHERE contains(lower(title),'customer'))
        SELECT {COLUMNS}, (SELECT count(*) FROM m) AS total FROM m""",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.list_datasets(full_catalog(r), query="Customer").select(*SHOWN, "total")


@registered(
    "list_datasets_tag",
    f"""WITH {duck.CATALOG}, m AS (SELECT * FROM catalog WHERE source_type = 'govmap' OR is_spatial)
        SELECT {COLUMNS}, (SELECT count(*) FROM m) AS total FROM m""",
    duck.CATALOG_NEEDS,
)
def _(r):
    tags = F.array(F.col("source_type"), F.when(F.col("is_spatial"), F.lit("govmap")))
    return ops.list_datasets(full_catalog(r).withColumn("tags", tags), tag="govmap").select(*SHOWN, "total")


@registered(
    "top_datasets",
    f"""WITH {duck.CATALOG}, c AS (SELECT dataset_id, title, coalesce(nullif(source_type,''),'—') AS source_type,
            coalesce(nullif(organization,''),'—') AS organization, file_only, first_ord FROM catalog)
        SELECT *, row_number() OVER w AS rank, greatest(count(*) OVER (PARTITION BY source_type, organization) - 5, 0) AS overflow FROM c
        WINDOW w AS (PARTITION BY source_type, organization ORDER BY lower(title), file_only, first_ord) QUALIFY row_number() OVER w <= 5""",
    duck.CATALOG_NEEDS,
)
def _(r):
    top = ops.top_datasets(full_catalog(r), cap=5)
    return top.select("dataset_id", "title", "source_type", "organization", "file_only", "first_ord", "rank", "overflow")


@registered(
    "top_datasets_all",
    f"""WITH {duck.CATALOG}, c AS (SELECT dataset_id, title, coalesce(nullif(source_type,''),'—') AS source_type,
            coalesce(nullif(organization,''),'—') AS organization, file_only, first_ord FROM catalog)
        SELECT *, row_number() OVER (PARTITION BY source_type, organization ORDER BY lower(coalesce(title,'')), file_only, first_ord) AS rank,
               cast(0 AS bigint) AS overflow FROM c""",
    duck.CATALOG_NEEDS,
)
def _(r):
    top = ops.top_datasets(full_catalog(r))
    return top.select("dataset_id", "title", "source_type", "organization", "file_only", "first_ord", "rank", "overflow")


@registered(
    "table_fallback",
    f"WITH {duck.CATALOG} SELECT dataset_id, primary_table, primary_schema FROM catalog WHERE NOT is_spatial AND coalesce(primary_table,'') <> ''",
    duck.CATALOG_NEEDS,
)
def _(r):
    return ops.table_fallback(full_catalog(r)).select("dataset_id", "primary_table", "primary_schema")


def contents_twin(mode: int) -> str:
    shown = {1: "category = 'spatial'", 2: "category <> 'other'", 3: "true"}[mode]
    visible = {1: "is_spatial", 2: "has_openable", 3: "true"}[mode]
    return f"""WITH {duck.CATALOG}, {duck.LATEST}, {duck.CLASSIFIED},
vis AS (SELECT l.dataset_id, count(*) FILTER (WHERE category = 'spatial') AS spatial_files, count(*) FILTER (WHERE category = 'data') AS data_files,
        count(*) FILTER (WHERE category = 'other') AS other_files FROM classified c JOIN latest l USING (version_id)
        WHERE c.download_url IS NOT NULL AND {shown} GROUP BY l.dataset_id),
n AS (SELECT dataset_id, count(*) - 1 AS older FROM versions GROUP BY dataset_id),
e AS (SELECT c.*, l.version_id, l.version_number, substr(coalesce(l.detected_at,''),1,10) AS detected, coalesce(n.older,0) AS older,
      coalesce(v.spatial_files,0) AS sfi, coalesce(v.data_files,0) AS dfi, coalesce(v.other_files,0) AS ofi,
      c.is_spatial AND coalesce(c.spatial_table,'') <> '' AS live, l.version_id IS NOT NULL AND coalesce(l.version_number,1) > 1 AS hist,
      NOT c.is_spatial AND coalesce(c.primary_table,'') <> '' AS fallback
      FROM catalog c LEFT JOIN latest l USING (dataset_id) LEFT JOIN n USING (dataset_id) LEFT JOIN vis v USING (dataset_id) WHERE c.{visible})
SELECT dataset_id, title, live, sfi AS spatial_files, dfi AS data_files, ofi AS other_files, version_number AS active_version,
       CASE WHEN version_id IS NOT NULL THEN detected END AS active_detected, CASE WHEN hist THEN older ELSE 0 END AS previous_versions, fallback AS table_fallback,
       CASE WHEN live OR hist OR sfi + dfi + ofi > 0 THEN 'contents' WHEN fallback THEN 'table' WHEN version_id IS NULL THEN 'version_error' ELSE 'no_files' END AS offer
FROM e""".replace("WHERE c.true", "WHERE true")


CONTENT_NEEDS = (*duck.CATALOG_NEEDS, "versions", "resources")


@registered("dataset_contents", contents_twin(2), CONTENT_NEEDS)
def _(r):
    return dataset_contents(full_catalog(r), r("versions"), r("resources"), 2)


@registered("dataset_contents_spatial", contents_twin(1), CONTENT_NEEDS)
def _(r):
    return dataset_contents(full_catalog(r), r("versions"), r("resources"), 1)


@registered("dataset_contents_all", contents_twin(3), CONTENT_NEEDS)
def _(r):
    return dataset_contents(full_catalog(r), r("versions"), r("resources"), 3)


@registered(
    "primary_columns",
    f"WITH {duck.CATALOG} SELECT b.dataset_id, c.col_ord, c.column_name, c.column_type FROM backed b JOIN catalog_columns c ON c.table_ord = b.primary_ord",
    duck.CATALOG_NEEDS,
)
def _(r):
    backed = ops.build_catalog(r("catalog_tables"), r("catalog_columns"))
    described = backed.select("dataset_id", F.col("primary_ord").alias("table_ord"))
    return described.join(r("catalog_columns"), "table_ord").select("dataset_id", "col_ord", "column_name", "column_type")
