"""Fragments of DuckDB text shared by several twins."""

from __future__ import annotations

CONTAINERS = "('gpkg','parquet','fgb','gml','kml','kmz','zip')"
RASTERS = "('tif','tiff','geotiff','png','jpg','jpeg')"
VECTORS = "('geojson','shp')"
STYLES = "('sld','qml','qlr','lyr','lyrx')"
TABULAR = "('csv','tsv','txt','xls','xlsx','ods')"
SPATIAL_FORMATS = "('geojson','kml','kmz','gpkg','gml','zip','shp')"
OPENABLE_FORMATS = (
    "('geojson','kml','kmz','gpkg','gml','zip','shp','parquet','fgb','tif','tiff','geotiff','png','jpg','jpeg',"
    "'csv','tsv','txt','xls','xlsx','ods')"
)
PSEUDO = "('shape','shape_area','shape_length','geometry','the_geom')"
BUCKET = r"https://pub-[0-9a-z]+\.r2\.dev/datasets/([0-9a-fA-F-]{36})/v[0-9]+/([^/?|]+)"


def segment(url: str) -> str:
    path = f"split_part(split_part(lower(coalesce({url},'')),'?',1),'#',1)"
    return rf"regexp_replace(regexp_replace(rtrim({path},'/'),'^.*/',''),'\.gz$','')"


def ext_from_url(url: str) -> str:
    seg = segment(url)
    return (
        rf"CASE WHEN regexp_matches({seg},'\.[\p{{L}}\p{{N}}]{{2,8}}$') THEN regexp_extract({seg},'\.([\p{{L}}\p{{N}}]{{2,8}})$',1)"
        rf" ELSE regexp_extract({seg},'_([\p{{L}}\p{{N}}]{{2,8}})$',1) END"
    )


def resource_ext(fmt: str, url: str) -> str:
    declared = f"ltrim(trim(lower(coalesce({fmt},''))),'.')"
    raw = f"CASE WHEN {declared} <> '' THEN {declared} ELSE {ext_from_url(url)} END"
    return f"CASE {raw} WHEN 'geoparquet' THEN 'parquet' WHEN 'flatgeobuf' THEN 'fgb' WHEN 'json' THEN 'geojson' ELSE {raw} END"


def suffix(name: str) -> str:
    return (
        f"CASE WHEN regexp_matches(coalesce({name},''),'^[0-9a-fA-F]+_.+$')"
        f" THEN regexp_extract({name},'^[0-9a-fA-F]+_(.+)$',1) ELSE coalesce({name},'') END"
    )


def bucket(source: str, group: int) -> str:
    return f"nullif(regexp_extract({source},'{BUCKET}',{group}),'')"


# classified: every resource with its class.
CLASSIFIED = f"""
typed AS MATERIALIZED (SELECT version_id, dataset_id, res_ord, coalesce(nullif(name,''),'resource') AS name, lower(coalesce(format,'')) AS fmt,
                 CASE WHEN download_url IS NULL THEN '' ELSE {resource_ext('format', 'download_url')} END AS ext,
                 nullif(download_url,'') AS download_url, CASE WHEN download_url IS NULL THEN odata_url END AS odata_url FROM resources),
bundled AS (SELECT *, ext = 'zip' AND contains(lower(name||' '||coalesce(download_url,'')),'symbology') AS is_bundle FROM typed),
kinds AS (SELECT *, CASE WHEN download_url IS NULL OR is_bundle THEN NULL WHEN ext IN {CONTAINERS} OR ext IN {VECTORS} THEN 'vector'
                         WHEN ext IN {RASTERS} THEN 'raster' WHEN ext IN {TABULAR} THEN 'table' END AS layer_kind FROM bundled),
classified AS (SELECT version_id, dataset_id, res_ord, name, fmt, ext, download_url, odata_url, layer_kind,
    CASE WHEN download_url IS NULL THEN 'other' WHEN ext IN {CONTAINERS} OR ext IN {RASTERS} OR ext IN {VECTORS} OR ext IN {STYLES} THEN 'spatial'
         WHEN ext IN {TABULAR} THEN 'data' ELSE 'other' END AS category,
    download_url IS NOT NULL AND NOT is_bundle AND ext IN {CONTAINERS} AS container,
    CASE WHEN download_url IS NULL THEN 'odata' WHEN layer_kind IN ('vector','raster') THEN 'vector'
         WHEN layer_kind = 'table' THEN 'table' ELSE 'other' END AS kind,
    CASE WHEN download_url IS NULL THEN NULL
         WHEN ext = 'geojson' AND (lower(download_url) LIKE '%.gz' OR contains(lower(download_url),'.geojson.gz')) THEN '/vsigzip//vsicurl/'||download_url
         WHEN ext = 'csv' THEN 'CSV:/vsicurl/'||download_url WHEN ext = 'zip' THEN '/vsizip//vsicurl/'||download_url
         ELSE '/vsicurl/'||download_url END AS uri FROM kinds)"""

# suffix_files: one bucket file per version and suffix.
FILES = f"""
in_bucket AS (SELECT version_id, dataset_id, res_ord, download_url, {bucket('download_url', 2)} AS file_name FROM resources),
version_files AS (SELECT version_id, dataset_id, {suffix('file_name')} AS suffix, file_name, download_url FROM in_bucket WHERE file_name IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY version_id, {suffix('file_name')} ORDER BY res_ord DESC) = 1)"""

LATEST = """
latest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY coalesce(version_number,0) DESC, version_ord) = 1)"""

# saved: layers served from a bucket.
SAVED = f"""
saved AS (SELECT *, {suffix('old_file')} AS suffix FROM (SELECT *, {bucket('source', 1)} AS dataset_id, {bucket('source', 2)} AS old_file FROM layers) b
          WHERE old_file IS NOT NULL)"""

SCAN = f"""{FILES}, {LATEST}, {SAVED},
current_version AS (SELECT f.dataset_id, f.file_name, v.version_number, substr(v.detected_at,1,10) AS detected, v.total_rows
    FROM version_files f JOIN versions v USING (version_id)
    QUALIFY row_number() OVER (PARTITION BY f.dataset_id, f.file_name ORDER BY coalesce(v.version_number,0) DESC, v.version_ord) = 1),
bundles AS MATERIALIZED (SELECT version_id, download_url AS sym_url FROM resources WHERE download_url IS NOT NULL AND {resource_ext('format', 'download_url')} = 'zip'
    QUALIFY row_number() OVER (PARTITION BY version_id ORDER BY CASE WHEN contains(lower(coalesce(name,'')),'symbology') THEN 0 ELSE 1 END, res_ord) = 1),
scanned AS (SELECT s.layer_id, s.layer_name, s.group_id, s.source, s.dataset_id, s.old_file,
    CASE WHEN l.version_id IS NULL THEN 'error' WHEN n.file_name IS NULL THEN 'missing' WHEN n.file_name = s.old_file THEN 'current' ELSE 'update' END AS status,
    n.file_name AS new_file, n.download_url AS new_url, c.version_number AS from_version, c.detected AS from_detected, c.total_rows AS rows_before,
    l.version_number AS to_version, CASE WHEN l.version_id IS NOT NULL THEN substr(coalesce(l.detected_at,''),1,10) END AS to_detected,
    l.total_rows AS rows_after, b.sym_url,
    CASE WHEN l.version_id IS NULL THEN 'לא ניתן לקרוא את גרסאות המאגר' WHEN n.file_name IS NULL THEN 'המשאב אינו קיים בגרסה האחרונה' ELSE '' END AS message
    FROM saved s LEFT JOIN latest l USING (dataset_id) LEFT JOIN version_files n ON n.version_id = l.version_id AND n.suffix = s.suffix
    LEFT JOIN current_version c ON c.dataset_id = s.dataset_id AND c.file_name = s.old_file LEFT JOIN bundles b ON b.version_id = l.version_id),
drift AS (SELECT layer_id, string_agg(field_name, ', ' ORDER BY field_ord) AS renamed FROM
    (SELECT s.layer_id, f.field_ord, f.field_name FROM scanned s JOIN layer_fields f USING (layer_id)
     WHERE s.status = 'update' AND s.new_url IN (SELECT download_url FROM file_fields)
       AND NOT EXISTS (SELECT 1 FROM file_fields n WHERE n.download_url = s.new_url AND n.field_name = f.field_name)) d GROUP BY layer_id)"""

SCAN_NEEDS = ("versions", "resources", "layers", "layer_fields", "file_fields")

# catalog: table-backed and file-only datasets.
CATALOG = f"""
t AS (SELECT ct.*, coalesce(s.sp, false) AS sp, coalesce(ct.table_name,'') <> '' AS named FROM catalog_tables ct
      LEFT JOIN (SELECT table_ord, bool_or(lower(column_type) = 'geometry') AS sp FROM catalog_columns GROUP BY table_ord) s USING (table_ord)
      WHERE coalesce(ct.dataset_id,'') <> ''),
head AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY table_ord) = 1),
prim AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY CASE WHEN named THEN 0 ELSE 1 END, CASE WHEN named THEN table_ord ELSE -table_ord END) = 1),
spat AS (SELECT * FROM t WHERE sp QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY CASE WHEN named THEN 0 ELSE 1 END, CASE WHEN named THEN table_ord ELSE -table_ord END) = 1),
tot AS (SELECT dataset_id, bool_or(sp) AS is_spatial, cast(sum(coalesce(est_rows,0)) AS bigint) AS est_rows, count(*) AS table_count FROM t GROUP BY dataset_id),
backed AS (SELECT h.dataset_id, coalesce(h.title,'') AS title, h.organization, h.source_type, h.ckan_id, h.versions_url, tot.is_spatial, true AS has_openable,
    s.table_name AS spatial_table, CASE WHEN s.dataset_id IS NOT NULL THEN coalesce(s.schema_name,'idx') END AS spatial_schema, s.table_ord AS spatial_ord,
    p.table_name AS primary_table, coalesce(p.schema_name,'idx') AS primary_schema, p.table_ord AS primary_ord,
    tot.est_rows, tot.table_count, false AS file_only, h.table_ord AS first_ord
    FROM head h JOIN tot USING (dataset_id) JOIN prim p USING (dataset_id) LEFT JOIN spat s USING (dataset_id)),
fmts AS (SELECT dataset_id, bool_or(lower(format) IN {SPATIAL_FORMATS}) AS sf, bool_or(lower(format) IN {OPENABLE_FORMATS}) AS opf
         FROM dataset_source_formats GROUP BY dataset_id),
flagged AS (SELECT l.*, coalesce(source_type IN ('govmap','scraper'), false) OR coalesce(sf, false) AS is_spatial,
    coalesce(source_type IN ('govmap','scraper'), false) OR coalesce(sf, false) OR coalesce(opf, false) AS has_openable
    FROM dataset_listing l LEFT JOIN fmts USING (dataset_id)),
filed AS (SELECT dataset_id, coalesce(title,'') AS title, organization, source_type, ckan_id, versions_url, is_spatial, has_openable,
    cast(NULL AS varchar) AS spatial_table, cast(NULL AS varchar) AS spatial_schema, cast(NULL AS bigint) AS spatial_ord,
    cast(NULL AS varchar) AS primary_table, cast(NULL AS varchar) AS primary_schema, cast(NULL AS bigint) AS primary_ord,
    cast(0 AS bigint) AS est_rows, cast(0 AS bigint) AS table_count, true AS file_only, listing_ord AS first_ord
    FROM flagged WHERE dataset_id NOT IN (SELECT dataset_id FROM backed)
    QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY listing_ord) = 1),
catalog AS (SELECT * FROM backed UNION ALL SELECT * FROM filed)"""

CATALOG_NEEDS = ("catalog_tables", "catalog_columns", "dataset_listing", "dataset_source_formats")
