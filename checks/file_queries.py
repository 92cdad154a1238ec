"""Queries over files, resources and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger.functions import addresses, files
from mapledger.operators import resources as ops
from mapledger.operators import versions as version_ops

from . import duck
from .registry import registered

CLASS_COLUMNS = (
    "version_id", "res_ord", "name", "fmt", "ext", "category", "layer_kind", "container", "kind", "uri", "odata_url",
)


@registered("ext_from_url", f"SELECT page_id, url, {duck.ext_from_url('url')} AS ext FROM pages")
def _(r):
    return r("pages").select("page_id", "url", files.ext_from_url(F.col("url")).alias("ext"))


@registered(
    "resource_ext",
    f"SELECT version_id, res_ord, {duck.resource_ext('format', 'download_url')} AS ext FROM resources",
    ("resources",),
)
def _(r):
    return r("resources").select(
        "version_id", "res_ord", files.resource_ext(F.col("format"), F.col("download_url")).alias("ext")
    )


@registered(
    "classify_resources", f"WITH {duck.CLASSIFIED} SELECT {', '.join(CLASS_COLUMNS)} FROM classified", ("resources",)
)
def _(r):
    return ops.classify_resources(r("resources")).select(*CLASS_COLUMNS)


@registered(
    "classify_ext_counts",
    f"""SELECT ext, CASE WHEN ext IN {duck.CONTAINERS} OR ext IN {duck.RASTERS} OR ext IN {duck.VECTORS} OR ext IN {duck.STYLES} THEN 'spatial'
            WHEN ext IN {duck.TABULAR} THEN 'data' ELSE 'other' END AS category,
            CASE WHEN ext IN {duck.CONTAINERS} OR ext IN {duck.VECTORS} THEN 'vector' WHEN ext IN {duck.RASTERS} THEN 'raster'
                 WHEN ext IN {duck.TABULAR} THEN 'table' END AS layer_kind, ext IN {duck.CONTAINERS} AS container, count(*) AS n
        FROM (SELECT {duck.ext_from_url('url')} AS ext FROM pages) p GROUP BY ext""",
)
def _(r):
    ext = F.col("ext")
    counted = r("pages").select(files.ext_from_url(F.col("url")).alias("ext")).groupBy("ext").agg(F.count("*").alias("n"))
    return counted.withColumn("c", files.file_class(ext)).select("ext", "c.category", "c.layer_kind", "c.container", "n")


ROW_COUNTS = """
listed AS (SELECT version_id, name, rows_count FROM resource_rows
           QUALIFY row_number() OVER (PARTITION BY version_id, name ORDER BY row_ord DESC) = 1)"""


@registered(
    "attach_row_counts",
    f"""WITH {ROW_COUNTS} SELECT r.version_id, r.res_ord, r.name, coalesce(x.rows_count, v.total_rows) AS rows FROM resources r
        LEFT JOIN listed x ON x.version_id = r.version_id AND x.name = coalesce(nullif(r.name,''),'resource')
        LEFT JOIN versions v ON v.version_id = r.version_id""",
    ("resources", "resource_rows", "versions"),
)
def _(r):
    return ops.attach_row_counts(r("resources"), r("resource_rows"), r("versions")).select(
        "version_id", "res_ord", "name", "rows"
    )


@registered(
    "resolve_resources",
    f"""WITH {duck.CLASSIFIED}, {ROW_COUNTS} SELECT {', '.join('c.' + c for c in CLASS_COLUMNS)}, c.dataset_id, c.download_url,
        coalesce(x.rows_count, v.total_rows) AS rows FROM classified c
        LEFT JOIN listed x ON x.version_id = c.version_id AND x.name = c.name LEFT JOIN versions v ON v.version_id = c.version_id""",
    ("resources", "resource_rows", "versions"),
)
def _(r):
    resolved = ops.resolve_resources(r("resources"), r("resource_rows"), r("versions"))
    return resolved.select(*CLASS_COLUMNS, "dataset_id", "download_url", "rows")


@registered(
    "read_plan",
    f"""WITH {duck.CLASSIFIED},
        ways AS (SELECT version_id, res_ord, ext, lower(download_url) LIKE '%.gz' OR contains(lower(download_url),'.geojson.gz') AS compressed,
                 '/vsicurl/'||download_url AS plain FROM classified WHERE download_url IS NOT NULL),
        tries AS (SELECT version_id, res_ord, ext, compressed, cast(1 AS bigint) AS attempt,
                    CASE WHEN ext = 'geojson' AND compressed THEN '/vsigzip/'||plain WHEN ext = 'csv' THEN 'CSV:'||plain ELSE plain END AS uri FROM ways
                  UNION ALL SELECT version_id, res_ord, ext, compressed, cast(2 AS bigint),
                    CASE WHEN ext = 'geojson' AND NOT compressed THEN '/vsigzip/'||plain WHEN ext = 'gpkg' THEN 'GPKG:'||plain
                         WHEN ext IN ('kml','kmz') THEN 'KML:'||plain ELSE plain END
                  FROM ways WHERE ext IN ('geojson','gpkg','csv','kml','kmz'))
        SELECT * FROM tries""",
    ("resources",),
)
def _(r):
    return ops.read_plan(ops.classify_resources(r("resources")))


@registered(
    "resources_in_mode_openable",
    f"WITH {duck.CLASSIFIED} SELECT version_id, res_ord, ext, category, false AS warn FROM classified WHERE download_url IS NOT NULL AND category <> 'other'",
    ("resources",),
)
def _(r):
    shown = ops.resources_in_mode(ops.classify_resources(r("resources")), 2)
    return shown.select("version_id", "res_ord", "ext", "category", "warn")


@registered(
    "resources_in_mode_all",
    f"WITH {duck.CLASSIFIED} SELECT version_id, res_ord, ext, category, category = 'other' AS warn FROM classified WHERE download_url IS NOT NULL",
    ("resources",),
)
def _(r):
    shown = ops.resources_in_mode(ops.classify_resources(r("resources")), 3)
    return shown.select("version_id", "res_ord", "ext", "category", "warn")


@registered(
    "resources_in_mode_spatial",
    f"WITH {duck.CLASSIFIED} SELECT version_id, res_ord, ext, category, false AS warn FROM classified WHERE download_url IS NOT NULL AND category = 'spatial'",
    ("resources",),
)
def _(r):
    shown = ops.resources_in_mode(ops.classify_resources(r("resources")), 1)
    return shown.select("version_id", "res_ord", "ext", "category", "warn")


@registered(
    "pick_default",
    f"""WITH {duck.CLASSIFIED} SELECT version_id, res_ord, name, ext, kind FROM classified
        QUALIFY row_number() OVER (PARTITION BY version_id ORDER BY CASE WHEN kind = 'vector' THEN 0 ELSE 1 END, res_ord) = 1""",
    ("resources",),
)
def _(r):
    picked = ops.pick_default(ops.classify_resources(r("resources")))
    return picked.select("version_id", "res_ord", "name", "ext", "kind")


@registered(
    "pick_default_first",
    f"""WITH {duck.CLASSIFIED} SELECT version_id, res_ord, name, ext, kind FROM classified
        QUALIFY row_number() OVER (PARTITION BY version_id ORDER BY res_ord) = 1""",
    ("resources",),
)
def _(r):
    picked = ops.pick_default(ops.classify_resources(r("resources")), prefer_geojson=False)
    return picked.select("version_id", "res_ord", "name", "ext", "kind")


@registered(
    "pick_bundle",
    f"""WITH {duck.CLASSIFIED} SELECT version_id, res_ord, name, download_url FROM classified WHERE ext = 'zip' AND download_url IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY version_id ORDER BY CASE WHEN contains(lower(name),'symbology') THEN 0 ELSE 1 END, res_ord) = 1""",
    ("resources",),
)
def _(r):
    return ops.pick_bundle(ops.classify_resources(r("resources"))).select("version_id", "res_ord", "name", "download_url")


@registered(
    "files_by_suffix",
    f"WITH {duck.FILES} SELECT version_id, dataset_id, suffix, file_name, download_url FROM version_files",
    ("resources",),
)
def _(r):
    return ops.files_by_suffix(r("resources"))


@registered(
    "resource_suffix",
    f"""SELECT version_id, res_ord, {duck.suffix(duck.bucket('download_url', 2))} AS hashed, {duck.suffix("split_part(download_url,'/v1/',1)")} AS whole
        FROM resources""",
    ("resources",),
)
def _(r):
    url = F.col("download_url")
    return r("resources").select(
        "version_id", "res_ord",
        addresses.resource_suffix(addresses.bucket_file(url)).alias("hashed"),
        addresses.resource_suffix(F.substring_index(url, "/v1/", 1)).alias("whole"),
    )


@registered(
    "bundle_key",
    "SELECT version_id, res_ord, substr(sha1(coalesce(download_url,'')),1,16) AS bundle_key FROM resources",
    ("resources",),
)
def _(r):
    return r("resources").select("version_id", "res_ord", addresses.bundle_key(F.col("download_url")).alias("bundle_key"))


@registered(
    "latest_version",
    f"WITH {duck.LATEST} SELECT dataset_id, version_id, version_number, detected_at, total_rows FROM latest",
    ("versions",),
)
def _(r):
    return version_ops.latest_version(r("versions")).drop("version_ord")


@registered(
    "previous_versions",
    f"""WITH {duck.LATEST} SELECT v.dataset_id, v.version_id, v.version_number, v.detected_at, v.total_rows,
        row_number() OVER (PARTITION BY v.dataset_id ORDER BY coalesce(v.version_number,0) DESC, v.version_ord) AS rank FROM versions v JOIN latest l USING (dataset_id)
        WHERE coalesce(l.version_number,1) > 1 AND v.version_id <> l.version_id""",
    ("versions",),
)
def _(r):
    return version_ops.previous_versions(r("versions")).drop("version_ord")
