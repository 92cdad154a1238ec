"""Input relations derived from the given tables, as SQL for Spark and for DuckDB.

Both engines read the same text; only a short list of constant rows is spelled by engine:
an exploded array in Spark, a VALUES list in DuckDB. No relation needs a window, so a hot
customer or order does not gather in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from mapledger.session import fresh_path, shuffles_dropped

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages",
)


def _fan(engine: str, alias: str, columns: str, *rows: str) -> str:
    """Constant rows next to every row of the tables before it in the FROM clause."""
    if engine == "spark":
        return f"LATERAL VIEW inline(array({', '.join(f'struct({r})' for r in rows)})) {alias} AS {columns}"
    return f"CROSS JOIN (VALUES {', '.join(f'({r})' for r in rows)}) AS {alias}({columns})"


def relation_sql(engine: str) -> dict[str, str]:
    """Text of every relation; later ones build on earlier ones."""

    def fan(alias: str, columns: str, *rows: str) -> str:
        return _fan(engine, alias, columns, *rows)

    return {
        "dataset_ids": """
SELECT n, substr(m,1,8)||'-'||substr(m,9,4)||'-'||substr(m,13,4)||'-'||substr(m,17,4)||'-'||substr(m,21,12) AS dataset_id
FROM (SELECT n, md5('ds'||cast(n AS string)) AS m
      FROM (SELECT cast(c_custkey AS bigint) AS n FROM customer
            UNION SELECT cast(p_partkey - p_partkey % 3 AS bigint) AS n FROM part) k) h""",
        "catalog_tables": """
SELECT cast(p.p_partkey AS bigint) AS table_ord,
       CASE WHEN p.p_partkey % 53 = 7 THEN '' ELSE 'tbl_'||cast(p.p_partkey AS string) END AS table_name,
       CASE p.p_partkey % 4 WHEN 0 THEN 'idx' WHEN 1 THEN 'public' END AS schema_name,
       CASE WHEN p.p_partkey % 97 = 5 THEN NULL ELSE d.dataset_id END AS dataset_id,
       'ckan-'||cast(d.n AS string) AS ckan_id,
       CASE WHEN p.p_partkey % 41 = 0 THEN NULL
            ELSE p.p_name||' '||CASE d.n % 5 WHEN 0 THEN 'אנדרטאות מ.א. רמת הנגב' WHEN 1 THEN 'Bus Terminals'
                                 WHEN 2 THEN 'תחנות אוטובוס' ELSE cast(d.n AS string) END END AS title,
       CASE WHEN p.p_size = 7 THEN NULL ELSE p.p_brand END AS organization,
       CASE p.p_type WHEN 'ECONOMY' THEN 'govmap' WHEN 'SMALL' THEN 'ckan' WHEN 'MEDIUM' THEN 'scraper'
                     WHEN 'PROMO' THEN 'cbs' WHEN 'STANDARD' THEN 'odata' END AS source_type,
       CASE WHEN p.p_size % 10 = 0 THEN NULL ELSE cast(p.p_size AS bigint) * 997 END AS est_rows,
       '/versions/'||cast(d.n AS string) AS versions_url
FROM part p JOIN dataset_ids d ON d.n = p.p_partkey - p.p_partkey % 3""",
        "catalog_columns": f"""
SELECT cast(p.p_partkey AS bigint) AS table_ord, cast(c.ord AS bigint) AS col_ord, c.name AS column_name,
       CASE WHEN c.name = 'geom' AND p.p_size % 4 = 0 THEN 'Geometry' ELSE c.type END AS column_type
FROM part p {fan('c', 'ord, name, type', "1, 'objectId', 'bigint'", "2, 'שם תחנה', 'text'", "3, 'value', 'numeric'",
                 "4, 'geometry_wkt', 'text'", "5, 'geom', 'geometry'")}
WHERE c.ord < 4 OR p.p_size % 2 = 0""",
        "dataset_listing": """
SELECT cast(c.c_custkey AS bigint) AS listing_ord, d.dataset_id, c.c_name||' '||c.c_mktsegment AS title,
       CASE WHEN c.c_nationkey = 3 THEN NULL ELSE 'org-'||cast(c.c_nationkey AS string) END AS organization,
       CASE c.c_custkey % 6 WHEN 0 THEN 'govmap' WHEN 1 THEN 'ckan' WHEN 2 THEN 'scraper' WHEN 3 THEN 'cbs'
                            WHEN 4 THEN 'odata' END AS source_type,
       'ckan-'||cast(d.n AS string) AS ckan_id, '/versions/'||cast(d.n AS string) AS versions_url
FROM customer c JOIN dataset_ids d ON d.n = c.c_custkey""",
        "dataset_source_formats": f"""
SELECT d.dataset_id, cast(f.ord AS bigint) AS fmt_ord, f.format
FROM customer c JOIN dataset_ids d ON d.n = c.c_custkey
{fan('f', 'ord, format', "0, 'PDF'", "1, 'CSV'", "2, 'GeoJSON'", "3, 'xlsx'", "4, 'zip'")}
WHERE f.ord = c.c_custkey % 5 OR f.ord = c.c_nationkey % 7""",
        "versions": """
SELECT cast(o.o_orderkey AS bigint) AS version_id, d.dataset_id,
       CASE WHEN o.o_orderkey % 37 = 0 THEN NULL
            ELSE (cast(substr(cast(o.o_orderdate AS string),1,4) AS bigint) - 1992) * 12
                 + cast(substr(cast(o.o_orderdate AS string),6,2) AS bigint) END AS version_number,
       cast(o.o_orderkey AS bigint) AS version_ord,
       substr(cast(o.o_orderdate AS string),1,10)||'T00:00:00' AS detected_at,
       CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE cast(floor(o.o_totalprice) AS bigint) END AS total_rows
FROM orders o JOIN dataset_ids d ON d.n = o.o_custkey""",
        "resources": """
SELECT x.version_id, x.dataset_id, x.res_ord, x.name, x.format,
       CASE WHEN x.k = 6 THEN NULL ELSE 'https://pub-0a1b2c.r2.dev/datasets/'||x.dataset_id||'/v1/'||x.file_name END AS download_url,
       CASE WHEN x.k = 6 THEN '/odata/'||cast(x.version_id AS string) END AS odata_url
FROM (SELECT y.*, y.hash8||'_'||CASE y.k WHEN 0 THEN 'geojson.gz' WHEN 1 THEN 'table.csv' WHEN 2 THEN 'layer.gpkg' WHEN 3 THEN 'layer.parquet'
                    WHEN 4 THEN 'symbology.zip' WHEN 5 THEN 'doc.pdf' ELSE 'odata' END AS file_name,
             CASE y.k WHEN 0 THEN '_geojson' WHEN 1 THEN 'נתוני הסורק' WHEN 2 THEN 'layer' WHEN 3 THEN 'layer' WHEN 4 THEN '_symbology' WHEN 5 THEN 'doc' END AS name,
             CASE y.k WHEN 0 THEN '' WHEN 1 THEN 'CSV' WHEN 2 THEN '.gpkg' WHEN 3 THEN 'GeoParquet' WHEN 4 THEN 'ZIP' WHEN 5 THEN NULL ELSE 'odata' END AS format
      FROM (SELECT v.version_id, v.dataset_id, cast(l.l_linenumber - 1 AS bigint) AS k,
                   substr(md5(v.dataset_id||cast(l.l_partkey % 3 AS string)),1,8) AS hash8,
                   cast(l.l_linenumber AS bigint) + 8 * (cast(l.l_quantity AS bigint) + 64 * (cast(l.l_suppkey AS bigint) + 1000003 * cast(l.l_partkey AS bigint))) AS res_ord
            FROM lineitem l JOIN versions v ON v.version_id = l.l_orderkey) y) x""",
        "resource_rows": """
SELECT version_id, res_ord AS row_ord,
       CASE WHEN (version_id + res_ord) % 3 = 0 THEN coalesce(name,'resource') ELSE 'old '||coalesce(name,'resource') END AS name,
       CASE WHEN res_ord % 5 = 0 THEN NULL ELSE (res_ord % 40) * 100 END AS rows_count
FROM resources""",
        "layer_groups": """
SELECT cast(0 AS bigint) AS group_id, cast(NULL AS bigint) AS parent_id, '' AS group_name
UNION ALL SELECT cast(1 + r_regionkey AS bigint), cast(0 AS bigint), r_name FROM region
UNION ALL SELECT cast(100 + n_nationkey AS bigint), cast(1 + n_regionkey AS bigint), n_name FROM nation""",
        "layers": """
SELECT 'L'||cast(version_id AS string)||'_'||cast(res_ord AS string) AS layer_id, 'layer '||cast(res_ord AS string) AS layer_name,
       CASE (version_id + res_ord) % 3 WHEN 0 THEN 100 + version_id % 25 WHEN 1 THEN 1 + version_id % 5 ELSE 0 END AS group_id,
       CASE WHEN version_id % 31 = 1 THEN '/data/local/file.gpkg'
            WHEN version_id % 31 = 2 THEN '/vsicurl/https://pub-0a1b2c.r2.dev/datasets/00000000-0000-0000-0000-000000000000/v1/00ff_geojson.gz'
            WHEN version_id % 31 = 3 THEN '/vsicurl/https://pub-0a1b2c.r2.dev/datasets/'||dataset_id||'/v1/deadbeef_geojson.gz'
            ELSE CASE WHEN name = '_geojson' THEN '/vsigzip/' WHEN format = 'CSV' THEN 'CSV:' ELSE '' END
                 ||'/vsicurl/'||download_url||CASE res_ord % 3 WHEN 0 THEN '|layername=a' WHEN 1 THEN '|subset="objectId" < 50 AND "מרחב" > 1' ELSE '' END END AS source
FROM resources WHERE download_url IS NOT NULL""",
        "layer_fields": f"""
SELECT l.layer_id, cast(f.ord AS bigint) AS field_ord, f.name AS field_name
FROM layers l {fan('f', 'ord, name', "1, 'objectId'", "2, 'התרעה'", "3, 'מרחב'", "4, 'term_name'")}
WHERE f.ord < 4 OR l.group_id % 2 = 0""",
        "file_fields": f"""
SELECT DISTINCT r.download_url, cast(f.ord AS bigint) AS field_ord,
       CASE WHEN substr(md5(r.download_url),1,1) IN ('0','1','2','3') THEN f.new_name ELSE f.name END AS field_name
FROM resources r {fan('f', 'ord, name, new_name', "1, 'objectId', 'objectId'", "2, 'התרעה', 'hatraha'",
                      "3, 'מרחב', 'merchav'", "4, 'term_name', 'term_name'")}
WHERE r.download_url IS NOT NULL""",
        "features": """
SELECT feature_ord, table_name, CASE WHEN geom_type IS NOT NULL THEN xmin END AS xmin, CASE WHEN geom_type IS NOT NULL THEN ymin END AS ymin,
       CASE WHEN geom_type IS NOT NULL THEN xmax END AS xmax, CASE WHEN geom_type IS NOT NULL THEN ymax END AS ymax, geom_type,
       CASE WHEN feature_ord % 11 = 0 THEN NULL
            WHEN feature_ord % 17 = 1 THEN '{"id":'||cast(feature_ord AS string)||',"value":null,"ok":true}'
            ELSE '{"id":'||cast(feature_ord AS string)||',"value":'||cast(val AS string)||',"name":"'||table_name||'","ok":false}' END AS properties,
       CASE geom_type
         WHEN 'Point' THEN '{"type":"Point","coordinates":['||cast(xmin AS string)||','||cast(ymin AS string)||']}'
         WHEN 'LineString' THEN '{"type":"LineString","coordinates":[['||cast(xmin AS string)||','||cast(ymin AS string)||'],['||cast(xmax AS string)||','||cast(ymax AS string)||']]}'
         WHEN 'Polygon' THEN '{"type":"Polygon","coordinates":[[['||cast(xmin AS string)||','||cast(ymin AS string)||'],['||cast(xmax AS string)||','||cast(ymin AS string)||'],['||cast(xmin AS string)||','||cast(ymax AS string)||'],['||cast(xmin AS string)||','||cast(ymin AS string)||']]]}'
       END AS geojson
FROM (SELECT cast(event_id AS bigint) AS feature_ord, event_type AS table_name, value AS val,
             cast((event_id * 37) % 1400 AS double) / cast(4 AS double) - cast(180 AS double) AS xmin,
             cast((event_id * 91) % 700 AS double) / cast(4 AS double) - cast(90 AS double) AS ymin,
             cast((event_id * 37) % 1400 + CASE WHEN event_id % 4 IN (1,2) THEN 8 + user_id % 20 ELSE 0 END AS double) / cast(4 AS double) - cast(180 AS double) AS xmax,
             cast((event_id * 91) % 700 + CASE WHEN event_id % 4 IN (1,2) THEN 4 + user_id % 15 ELSE 0 END AS double) / cast(4 AS double) - cast(90 AS double) AS ymax,
             CASE WHEN event_id % 4 = 1 THEN 'LineString' WHEN event_id % 4 = 2 THEN 'Polygon' WHEN event_id % 13 = 0 THEN NULL ELSE 'Point' END AS geom_type
      FROM events) e""",
        "extents": """
SELECT extent_id, crs, x * s AS xmin, y * s AS ymin, (x + w) * s AS xmax, (y + cast(9 AS double)) * s AS ymax
FROM (SELECT cast(c_custkey AS bigint) AS extent_id, CASE c_custkey % 2 WHEN 0 THEN 'EPSG:4326' ELSE 'EPSG:3857' END AS crs,
             cast((c_custkey * 53) % 420 AS double) - cast(210 AS double) AS x,
             cast((c_custkey * 29) % 200 AS double) - cast(100 AS double) AS y,
             cast(CASE WHEN c_custkey % 19 = 0 THEN 0 ELSE 12 END AS double) AS w,
             cast(CASE c_custkey % 2 WHEN 0 THEN 1 ELSE 100000 END AS double) AS s FROM customer) c""",
        "field_dictionary": f"""
SELECT r.download_url AS bundle_url, cast(f.ord AS bigint) AS line_no, f.machine_name, f.alias
FROM (SELECT DISTINCT download_url FROM resources WHERE name = '_symbology') r
{fan('f', 'ord, machine_name, alias', "1, ' objectId ', 'מזהה'", "2, 'hatraha', 'התרעה'", "3, 'merchav', ''",
     "4, 'hatraha', ' התרעה פעילה '", "5, '', 'ריק'")}""",
        "style_docs": """
SELECT r.download_url AS bundle_url,
       CASE WHEN h IN ('0','1','2') THEN NULL
            ELSE '<sld><ogc:PropertyName>objectId</ogc:PropertyName><PropertyName>Shape</PropertyName><PropertyName>'||
                 CASE WHEN h IN ('3','4','5','6') THEN 'stat1tendr' ELSE 'התרעה' END||'</PropertyName><a xlink:href="icons/x.svg"/><a xlink:href="https://e.org/y.svg"/></sld>' END AS sld,
       CASE WHEN h IN ('0','1') THEN '<qml attr="OBJECTID" fieldName="TERM_NAME" attr=""/>' END AS qml
FROM (SELECT DISTINCT download_url, substr(md5(download_url),2,1) AS h FROM resources WHERE name = '_symbology') r""",
    }


SPARK_SQL = relation_sql("spark")
# A name follows from address and number, so addresses alone are made distinct: a quarter of the rows, without names.
SPARK_SQL["file_fields"] = (
    SPARK_SQL["file_fields"].replace("SELECT DISTINCT r.", "SELECT r.")
    .replace("FROM resources r ", "FROM (SELECT DISTINCT download_url FROM resources WHERE download_url IS NOT NULL) r ")
)
DUCK_SQL = relation_sql("duckdb")


def _needed(names: list[str]) -> list[str]:
    """The relations behind ``names``, each after those it reads."""
    order = list(SPARK_SQL)
    wanted = set(names)
    for name in reversed(order):
        if name in wanted:
            wanted |= {other for other in order if re.search(rf"\b(FROM|JOIN) {other}\b", SPARK_SQL[name])}
    return [name for name in order if name in wanted]


# Relations that ask for few rows and columns of the ones behind them, which are not stored for their sake alone.
NARROW = ("field_dictionary", "style_docs")

# Relations that are rows of ``resources`` in other words: a query that reads resources itself derives them as it reads,
# and only queries without it store them.
RESTATED = ("layers", "layer_fields")

# Written relations by (application, data folder, name): path and schema.
_WRITTEN: dict[tuple[str, str, str], tuple[str, object]] = {}


class Relations:
    """Tables and relations of one data folder.

    A relation stands for a source table of the service. It is derived by Spark from the
    given tables, written once per application to the shared folder, and read from there by
    every query, so that filters and column selections reach a scan.

    ``needs`` are the relations that a query reads. What stands behind narrow ones only is derived together
    with them: rows and columns that they leave out are neither moved nor written. Restated ones are derived
    from the resources that the query reads anyway.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, needs: tuple[str, ...] = ()):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.stored = set(_needed([name for name in needs if name not in NARROW]))
        self.restated = RESTATED if "resources" in needs else ()

    def table(self, name: str) -> DataFrame:
        """A given table; one that sits in fewer splits than there are cores is spread."""
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, 64) else df

    def __call__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        key = self._key(name)
        if key not in _WRITTEN:
            if name in self.restated:
                return self._derived(name, False)
            _WRITTEN[key] = self._write(name)
        path, schema = _WRITTEN[key]
        return self.spark.read.schema(schema).parquet(path)

    def _key(self, name: str) -> tuple[str, str, str]:
        return self.spark.sparkContext.applicationId, self.sf_dir, name

    def _derived(self, name: str, narrow: bool) -> DataFrame:
        """A relation by its text; behind a narrow one, relations are derived too if they are not stored anyway."""
        text = SPARK_SQL[name]
        inputs = {
            other: self._derived(other, narrow)
            if narrow and other not in TABLES and other not in self.stored and self._key(other) not in _WRITTEN
            else self(other)
            for other in (*TABLES, *SPARK_SQL)
            if re.search(rf"\b(FROM|JOIN) {other}\b", text)
        }
        text = text.replace("{", "{{").replace("}", "}}")
        for other in inputs:
            text = re.sub(rf"\b(FROM|JOIN) {other}\b", rf"\1 {{{other}}}", text)
        return self.spark.sql(text, **inputs)

    def _write(self, name: str) -> tuple[str, object]:
        df = self._derived(name, name in NARROW)
        path = fresh_path(self.spark, name)
        with shuffles_dropped(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return path, df.schema


def duck_query(sql: str, *relations: str) -> str:
    """DuckDB text that defines the named relations, and those behind them, before ``sql``."""
    chain = [f"{name} AS ({DUCK_SQL[name]})" for name in _needed(list(relations))]
    if not chain:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(chain)}, {body[5:]}"
    return f"WITH {', '.join(chain)} {body}"
