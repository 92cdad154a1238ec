"""Queries over feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger.functions import fixed, geometry
from mapledger.operators import features as ops
from mapledger.operators import ranks
from mapledger.operators.boxjoin import bbox_join
from mapledger.plans import loads
from mapledger.session import fresh_path
from mapledger.sources import results

from .registry import registered

BOX = (-60.25, -30.0, 75.5, 41.75)
COLUMNS = [("id", "BIGINT"), ("value", "DOUBLE"), ("name", "STRING"), ("ok", "BOOLEAN")]

X0, Y0, X1, Y1 = BOX
OVERLAP = f"geojson IS NOT NULL AND xmin <= {X1} AND xmax >= {X0} AND ymin <= {Y1} AND ymax >= {Y0}"


def touches(x0: str, y0: str, x1: str, y1: str) -> str:
    """Exact test by shape: a point, a line from corner to corner, or a right triangle."""
    def side(x, y):
        return f"((xmax - xmin) * ({y} - ymin) - (ymax - ymin) * ({x} - xmin))"

    corners = ", ".join(side(x, y) for x in (x0, x1) for y in (y0, y1))
    nearest = f"((greatest({x0}, xmin) - xmin) * (ymax - ymin) + (greatest({y0}, ymin) - ymin) * (xmax - xmin))"
    return (
        f"CASE geom_type WHEN 'Point' THEN true WHEN 'LineString' THEN least({corners}) <= 0 AND greatest({corners}) >= 0"
        f" ELSE {nearest} <= (xmax - xmin) * (ymax - ymin) END"
    )


EXACT = f"{OVERLAP} AND {touches(str(X0), str(Y0), str(X1), str(Y1))}"


@registered("bbox_overlap", f"SELECT feature_ord, table_name, geojson FROM features WHERE {OVERLAP}", ("features",))
def _(r):
    return ops.bbox_overlap(r("features"), BOX).select("feature_ord", "table_name", "geojson")


@registered("bbox_overlap_stored", f"SELECT feature_ord, table_name, geojson FROM features WHERE {OVERLAP}", ("features",))
def _(r):
    path = fresh_path(r.spark, "features-by-cell")
    ops.store_features(r("features"), path)
    return ops.bbox_overlap(r.spark.read.parquet(path), BOX).select("feature_ord", "table_name", "geojson")


@registered("intersects_box", f"SELECT feature_ord, table_name, geojson FROM features WHERE {EXACT}", ("features",))
def _(r):
    return ops.intersects_box(r("features"), BOX).select("feature_ord", "table_name", "geojson")


@registered(
    "geometry_box",
    """SELECT feature_ord, CASE WHEN geojson IS NOT NULL THEN xmin END AS xmin, CASE WHEN geojson IS NOT NULL THEN ymin END AS ymin,
       CASE WHEN geojson IS NOT NULL THEN xmax END AS xmax, CASE WHEN geojson IS NOT NULL THEN ymax END AS ymax FROM features""",
    ("features",),
)
def _(r):
    return ops.with_box(r("features").select("feature_ord", "geojson")).drop("geojson")


@registered(
    "where_fragment",
    """SELECT feature_ord, table_name, xmin FROM features WHERE "table_name" = 'purchase' OR ("xmin" > 100 AND geom_type = 'Point')""",
    ("features",),
)
def _(r):
    kept = ops.where_fragment(r("features"), """ "table_name" = 'purchase' OR ("xmin" > 100 AND geom_type = 'Point') """)
    return kept.select("feature_ord", "table_name", "xmin")


@registered("drop_null_geometry", "SELECT feature_ord, geojson FROM features WHERE coalesce(geojson,'') <> ''", ("features",))
def _(r):
    return ops.drop_null_geometry(r("features"), spatial=True).select("feature_ord", "geojson")


@registered(
    "geometry_family",
    """SELECT feature_ord, CASE geom_type WHEN 'Point' THEN 'point' WHEN 'LineString' THEN 'line' WHEN 'Polygon' THEN 'polygon' ELSE 'collection' END AS family
       FROM features""",
    ("features",),
)
def _(r):
    return r("features").select("feature_ord", geometry.geometry_family(F.col("geom_type")).alias("family"))


@registered(
    "clamp_box",
    """SELECT *, xmin >= xmax OR ymin >= ymax AS is_empty FROM (SELECT extent_id, greatest(xmin,-180.0::double) AS xmin,
       greatest(ymin,-90.0::double) AS ymin, least(xmax,180.0::double) AS xmax, least(ymax,90.0::double) AS ymax FROM extents) x""",
    ("extents",),
)
def _(r):
    cut = geometry.clamp_box(*[F.col(c) for c in geometry.BOX])
    return r("extents").select("extent_id", *[c.alias(name) for name, c in cut.items()])


LONLAT = """
lonlat AS (SELECT extent_id, CASE crs WHEN 'EPSG:4326' THEN xmin ELSE degrees(xmin / 6378137.0::double) END AS xmin,
    CASE crs WHEN 'EPSG:4326' THEN ymin ELSE degrees(2 * atan(exp(ymin / 6378137.0::double)) - pi() / 2) END AS ymin,
    CASE crs WHEN 'EPSG:4326' THEN xmax ELSE degrees(xmax / 6378137.0::double) END AS xmax,
    CASE crs WHEN 'EPSG:4326' THEN ymax ELSE degrees(2 * atan(exp(ymax / 6378137.0::double)) - pi() / 2) END AS ymax FROM extents)"""


def lonlat_extents(r):
    box = geometry.reproject_box(*[F.col(c) for c in geometry.BOX], F.col("crs"))
    return r("extents").select("extent_id", *[c.alias(name) for name, c in box.items()])


@registered(
    "reproject_extent",
    f"WITH {LONLAT} SELECT extent_id, round(xmin,6) AS xmin, round(ymin,6) AS ymin, round(xmax,6) AS xmax, round(ymax,6) AS ymax FROM lonlat",
    ("extents",),
)
def _(r):
    return lonlat_extents(r).select("extent_id", *[F.round(c, 6).alias(c) for c in geometry.BOX])


@registered(
    "page", "SELECT feature_ord, table_name, properties FROM features ORDER BY feature_ord LIMIT 500 OFFSET 300", ("features",)
)
def _(r):
    return ops.page(r("features"), 500, 300).select("feature_ord", "table_name", "properties")


@registered(
    "page_stored",
    """SELECT feature_ord, table_name, properties, row_number() OVER (ORDER BY feature_ord) - 1 AS position
       FROM features ORDER BY feature_ord LIMIT 500 OFFSET 300""",
    ("features",),
)
def _(r):
    path = ranks.store_in_order(r("features"), "feature_ord", rows_per_file=400)
    return ranks.stored_page(r.spark, path, 500, 300).select("feature_ord", "table_name", "properties", "position")


@registered(
    "capped_features",
    "SELECT feature_ord, table_name, (SELECT count(*) FROM features) > 700 AS truncated FROM features ORDER BY feature_ord LIMIT 700",
    ("features",),
)
def _(r):
    return ops.capped(r("features"), 700, "features").select("feature_ord", "table_name", "truncated")


@registered(
    "capped_sql",
    "SELECT feature_ord, table_name, (SELECT count(*) FROM features) >= 1500 AS truncated FROM features ORDER BY feature_ord LIMIT 1500",
    ("features",),
)
def _(r):
    return ops.capped(r("features"), 1500, "sql").select("feature_ord", "table_name", "truncated")


FIRST = """
first_rec AS (SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY feature_ord) = 1)"""

FIELD_TYPES = """CASE json_type(v) WHEN 'BOOLEAN' THEN 'BOOLEAN' WHEN 'BIGINT' THEN 'BIGINT' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'DOUBLE' ELSE 'STRING' END"""


@registered(
    "infer_schema",
    f"""WITH {FIRST}, k AS (SELECT table_name, properties, unnest(json_keys(properties)) AS field_name, generate_subscripts(json_keys(properties),1) AS n FROM first_rec WHERE properties IS NOT NULL),
        t AS (SELECT table_name, cast(n - 1 AS bigint) AS field_ord, field_name, json_extract(properties, '$.'||field_name) AS v FROM k)
        SELECT table_name, field_ord, field_name, {FIELD_TYPES} AS field_type FROM t WHERE field_name NOT IN ('geom','_geojson','geometry_wkt')""",
    ("features",),
)
def _(r):
    return ops.infer_schema(r("features"))


def event_records(r):
    return r("events").select(
        F.col("event_id").alias("feature_ord"), F.col("event_type").alias("table_name"), F.col("props").alias("properties")
    )


@registered(
    "infer_schema_props",
    f"""WITH f AS (SELECT event_type AS table_name, props FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) = 1),
        k AS (SELECT table_name, props, unnest(json_keys(props)) AS field_name, generate_subscripts(json_keys(props),1) AS n FROM f),
        t AS (SELECT table_name, cast(n - 1 AS bigint) AS field_ord, field_name, json_extract(props, '$.'||field_name) AS v FROM k)
        SELECT table_name, field_ord, field_name, {FIELD_TYPES} AS field_type FROM t""",
)
def _(r):
    return ops.infer_schema(event_records(r))


@registered(
    "detect_geometry_type",
    """WITH f AS (SELECT table_name, geom_type FROM features WHERE geojson IS NOT NULL QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY feature_ord) = 1)
       SELECT t.table_name, coalesce(f.geom_type,'MultiPolygon') AS geometry_type FROM (SELECT DISTINCT table_name FROM features) t LEFT JOIN f USING (table_name)""",
    ("features",),
)
def _(r):
    return ops.detect_geometry_type(r("features"))


@registered(
    "first_geometry_type", f"WITH {FIRST} SELECT table_name, upper(geom_type) AS geometry_type FROM first_rec", ("features",)
)
def _(r):
    return ops.first_geometry_type(r("features"))


@registered(
    "layer_extent",
    """SELECT table_name, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax, count(*) AS n_features
       FROM features WHERE geojson IS NOT NULL GROUP BY table_name""",
    ("features",),
)
def _(r):
    return ops.layer_extent(r("features"))


BOXES = """
boxes AS (SELECT * FROM (SELECT extent_id, greatest(xmin,-180.0::double) AS bx0, greatest(ymin,-90.0::double) AS by0,
          least(xmax,180.0::double) AS bx1, least(ymax,90.0::double) AS by1 FROM {source}) c WHERE bx0 < bx1 AND by0 < by1)"""
MEET = "f.geojson IS NOT NULL AND f.xmin <= b.bx1 AND f.xmax >= b.bx0 AND f.ymin <= b.by1 AND f.ymax >= b.by0"


@registered(
    "bbox_join",
    f"WITH {LONLAT}, {BOXES.format(source='lonlat')} SELECT b.extent_id, count(*) AS n FROM boxes b JOIN features f ON {MEET} GROUP BY b.extent_id",
    ("extents", "features"),
)
def _(r):
    pairs = bbox_join(lonlat_extents(r), r("features"))
    return pairs.groupBy("extent_id").agg(F.count("*").alias("n"))


@registered(
    "bbox_join_exact",
    f"""WITH {LONLAT}, {BOXES.format(source='lonlat')}
        SELECT b.extent_id, count(*) AS n FROM boxes b JOIN features f ON {MEET} AND {touches('bx0', 'by0', 'bx1', 'by1')} GROUP BY b.extent_id""",
    ("extents", "features"),
)
def _(r):
    pairs = bbox_join(lonlat_extents(r), r("features"), exact=True)
    return pairs.groupBy("extent_id").agg(F.count("*").alias("n"))


TYPED = """CAST(json_extract(properties,'$.id') AS bigint) AS id, CAST(json_extract_string(properties,'$.value') AS double) AS value,
           json_extract_string(properties,'$.name') AS name, CAST(json_extract_string(properties,'$.ok') AS boolean) AS ok"""


@registered(
    "load_layer_where",
    f"""WITH typed AS (SELECT *, {TYPED} FROM features WHERE table_name = 'purchase' AND {EXACT})
        SELECT feature_ord, id, value, name, ok, geojson AS _geojson, count(*) OVER () >= 200 AS truncated FROM typed WHERE value > 20 AND NOT ok
        ORDER BY feature_ord LIMIT 200""",
    ("features",),
)
def _(r):
    return loads.load_layer(
        r("features"), "purchase", "purchases", bbox=BOX, where='"value" > 20 AND NOT "ok"', columns=COLUMNS, row_cap=200
    )


@registered(
    "load_layer_where_all",
    f"""WITH typed AS (SELECT *, {TYPED} FROM features WHERE table_name = 'purchase' AND {EXACT})
        SELECT feature_ord, id, value, name, ok, geojson AS _geojson, false AS truncated FROM typed WHERE id > 20 AND NOT ok""",
    ("features",),
)
def _(r):
    # The table's own columns, from its first record.
    return loads.load_layer(r("features"), "purchase", "purchases", bbox=BOX, where='"id" > 20 AND NOT "ok"')


@registered(
    "load_layer_box",
    f"""SELECT feature_ord, {TYPED}, geojson AS _geojson, (SELECT count(*) FROM features WHERE table_name = 'error' AND {OVERLAP}) > 150 AS truncated
        FROM features WHERE table_name = 'error' AND {OVERLAP} ORDER BY feature_ord LIMIT 150""",
    ("features",),
)
def _(r):
    return loads.load_layer(r("features"), "error", "errors", bbox=BOX, row_cap=150)


@registered(
    "load_layer_all",
    "SELECT feature_ord, geojson AS _geojson, false AS truncated FROM features WHERE table_name = 'error' AND geojson IS NOT NULL",
    ("features",),
)
def _(r):
    # The attributes are those of the first record, which may have none.
    return loads.load_layer(r("features"), "error", "errors").select("feature_ord", "_geojson", "truncated")


@registered(
    "load_table",
    """SELECT event_id AS feature_ord, CAST(json_extract(props,'$.k') AS bigint) AS k, (SELECT count(*) FROM events WHERE event_type = 'click') >= 300 AS truncated
       FROM events WHERE event_type = 'click' ORDER BY event_id LIMIT 300""",
)
def _(r):
    return loads.load_table(event_records(r), "click", "clicks", row_cap=300)


@registered(
    "load_table_all",
    """SELECT event_id AS feature_ord, CAST(json_extract(props,'$.k') AS bigint) AS k, false AS truncated FROM events WHERE event_type = 'click'""",
)
def _(r):
    return loads.load_table(event_records(r), "click", "clicks")


@registered(
    "load_table_where",
    f"""SELECT *, count(*) OVER () >= 100 AS truncated FROM (SELECT feature_ord, {TYPED} FROM features WHERE table_name = 'click') t WHERE value > 40
        ORDER BY feature_ord LIMIT 100""",
    ("features",),
)
def _(r):
    return loads.load_table(r("features"), "click", "clicks", where='"value" > 40', columns=COLUMNS, row_cap=100)


@registered(
    "materialize_result", "SELECT feature_ord, table_name, geojson AS _geojson FROM features WHERE geojson IS NOT NULL", ("features",)
)
def _(r):
    result = r("features").select("feature_ord", "table_name", F.col("geojson").alias("_geojson"))
    return results.materialize_result(result, "all_features")


@registered(
    "materialize_table_result",
    "SELECT table_name, event_days, n FROM (SELECT event_type AS table_name, count(DISTINCT cast(ts AS date)) AS event_days, count(*) AS n FROM events GROUP BY event_type) x",
)
def _(r):
    counted = r("events").groupBy(F.col("event_type").alias("table_name")).agg(
        F.countDistinct(F.to_date("ts")).alias("event_days"), F.count("*").alias("n")
    )
    return results.materialize_result(counted, "event_days")


def _public(r, *names):
    loads.register_tables(r.spark, {("public", n): f"{r.sf_dir}/{n}.parquet" for n in names})


REVENUE = """SELECT n.n_name, o.o_orderpriority, count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS total,
       rank() OVER (PARTITION BY o.o_orderpriority ORDER BY count(*) DESC, n.n_name) AS place
FROM {s}"orders" o JOIN {s}"customer" c ON o.o_custkey = c.c_custkey JOIN {s}"nation" n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, o.o_orderpriority"""


@registered("free_query_join", f"SELECT *, false AS truncated FROM ({REVENUE.format(s='')}) q")
def _(r):
    _public(r, "orders", "customer", "nation")
    # Ranks and counts are compared as they are; the sum is rounded by the query itself.
    return loads.load_free_query(r.spark, REVENUE.format(s='"public".') + ";", "revenue").select(
        "n_name", "o_orderpriority", F.col("n_orders"), "total", F.col("place").cast("bigint"), "truncated"
    )


WIDE = """WITH big AS (SELECT l_orderkey, sum(l_quantity) AS quantity, count(*) AS n FROM {s}lineitem GROUP BY l_orderkey)
SELECT l_orderkey, quantity, n FROM big ORDER BY quantity DESC, l_orderkey"""


@registered("free_query_capped", f"SELECT *, true AS truncated FROM ({WIDE.format(s='')} LIMIT 1000) q")
def _(r):
    _public(r, "lineitem")
    return loads.load_free_query(r.spark, WIDE.format(s="public."), "large_orders", fixed.FREE_QUERY_CAP)


@registered("free_query_all", f"SELECT *, false AS truncated FROM ({WIDE.format(s='')}) q")
def _(r):
    _public(r, "lineitem")
    return loads.load_free_query(r.spark, WIDE.format(s="public."), "all_orders")


@registered(
    "free_query_names",
    """SELECT cast(o_orderkey AS bigint) AS row_no, 'mine' AS truncated, cast(o_custkey AS bigint) AS id, cast(o_custkey AS bigint) + 1 AS "ID_2",
       false AS truncated_2 FROM orders""",
)
def _(r):
    _public(r, "orders")
    sql = """SELECT cast(o_orderkey AS bigint) AS row_no, 'mine' AS truncated, cast(o_custkey AS bigint) AS id, cast(o_custkey AS bigint) + 1 AS ID
             FROM "public"."orders" """
    return loads.load_free_query(r.spark, sql, "own_names")


@registered(
    "free_query_spatial",
    f"""SELECT feature_ord, geojson AS _geojson, (SELECT count(*) FROM features WHERE {EXACT}) > 1000 AS truncated FROM features
        WHERE {EXACT} ORDER BY feature_ord LIMIT 1000""",
    ("features",),
)
def _(r):
    loads.register_spatial_functions(r.spark)
    path = fresh_path(r.spark, "idx-features")
    r("features").withColumnRenamed("geojson", "geom").write.parquet(path)
    loads.register_tables(r.spark, {("idx", "features"): path})
    sql = f"""SELECT feature_ord, extensions.ST_AsGeoJSON(geom) AS _geojson FROM "idx"."features"
              WHERE extensions.ST_Intersects(geom, extensions.ST_MakeEnvelope({X0},{Y0},{X1},{Y1}, 4326)) ORDER BY feature_ord"""
    return loads.load_free_query(r.spark, sql, "in_view", fixed.FREE_QUERY_CAP)
