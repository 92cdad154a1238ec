"""Operators on small tables with known answers."""

from __future__ import annotations

import pytest

from mapledger.functions import fixed
from mapledger.operators import catalog, features, fields, layers, resources, search, styles, versions
from mapledger.plans import loads, refresh
from mapledger.session import written

UID = "0a0b0c0d-0000-1111-2222-333344445555"
BASE = f"https://pub-9z.r2.dev/datasets/{UID}/v1/"

VERSIONS = "dataset_id string, version_id bigint, version_number bigint, version_ord bigint, detected_at string, total_rows bigint"
RESOURCES = "version_id bigint, dataset_id string, res_ord bigint, name string, format string, download_url string, odata_url string"
TABLES = (
    "table_ord bigint, table_name string, schema_name string, dataset_id string, ckan_id string, title string,"
    " organization string, source_type string, est_rows bigint, versions_url string"
)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_latest_and_previous_versions(spark):
    df = spark.createDataFrame(
        [("a", 1, 2, 0, "d", 1), ("a", 2, 2, 1, "d", 1), ("a", 3, None, 2, "d", 1), ("b", 4, 1, 0, "d", 1), ("b", 5, 1, 1, "d", 1),
         ("c", 6, None, 0, "d", 1)],
        VERSIONS,
    )
    assert rows(versions.latest_version(df).select("dataset_id", "version_id"), "dataset_id") == [("a", 1), ("b", 4), ("c", 6)]
    # Listed in order; datasets on version 1 have no history.
    assert rows(versions.previous_versions(df).select("dataset_id", "version_id", "rank"), "rank") == [("a", 2, 1), ("a", 3, 2)]


def test_row_counts(spark):
    res = spark.createDataFrame(
        [(1, "a", 0, "x", "csv", "u", None), (1, "a", 1, "y", "csv", "u", None), (1, "a", 2, None, "csv", "u", None), (1, "a", 3, "z", "csv", "u", None)],
        RESOURCES,
    )
    listed = spark.createDataFrame(
        [(1, 0, "x", 5), (1, 1, "x", 0), (1, 2, "y", None), (1, 3, "resource", 7)],
        "version_id bigint, row_ord bigint, name string, rows_count bigint",
    )
    ver = spark.createDataFrame([("a", 1, 1, 0, "d", 99)], VERSIONS)
    got = rows(resources.attach_row_counts(res, listed, ver).select("res_ord", "rows"), "res_ord")
    assert got == [(0, 0), (1, 99), (2, 7), (3, 99)]


def test_pick_default_and_bundle(spark):
    res = spark.createDataFrame(
        [(1, "a", 0, "t", "csv", "u", None), (1, "a", 1, "m", "tif", "u", None), (1, "a", 2, "data", "zip", "u/symbology.zip", None),
         (1, "a", 3, "My Symbology", "zip", "u", None), (2, "a", 0, "d", "zip", "u", None), (3, "a", 0, "d", "zip", None, "o")],
        RESOURCES,
    )
    kinds = resources.classify_resources(res)
    assert rows(resources.pick_default(kinds).select("version_id", "res_ord"), "version_id") == [(1, 1), (2, 0), (3, 0)]
    assert rows(resources.pick_default(kinds, False).select("version_id", "res_ord"), "version_id") == [(1, 0), (2, 0), (3, 0)]
    # The address does not make an archive a named bundle, though it makes it no layer.
    assert rows(resources.pick_bundle(kinds).select("version_id", "res_ord"), "version_id") == [(1, 3), (2, 0)]
    got = rows(kinds.select("version_id", "res_ord", "category", "layer_kind", "container", "kind"), "version_id", "res_ord")
    assert got[2] == (1, 2, "spatial", None, False, "other")
    assert got[4] == (2, 0, "spatial", "vector", True, "vector")
    assert got[5] == (3, 0, "other", None, False, "odata")


def test_build_catalog(spark):
    tables = spark.createDataFrame(
        [(0, "", None, "a", "k", None, "o", "ckan", None, "v"), (1, "t1", "", "a", "k", "x", "p", "cbs", 5, "w"),
         (2, "t2", "s", "a", "k", "x", "p", "cbs", 6, "w"), (3, "", "s3", "b", "k", "B", None, None, 1, "v"),
         (4, "", None, "b", "k", "B", None, None, 1, "v"), (5, "t5", "s", "", "k", "B", None, None, 1, "v")],
        TABLES,
    )
    cols = spark.createDataFrame([(2, 0, "geom", "GEOMETRY"), (3, 0, "g", "geometry"), (4, 0, "g", "geometry")],
                                 "table_ord bigint, col_ord bigint, column_name string, column_type string")
    got = {r.dataset_id: r for r in catalog.build_catalog(tables, cols).collect()}
    a, b = got["a"], got["b"]
    assert (a.title, a.organization, a.source_type, a.est_rows, a.table_count) == ("", "o", "ckan", 11, 3)
    assert (a.primary_table, a.primary_schema, a.spatial_table, a.spatial_schema) == ("t1", "idx", "t2", "s")
    # Without any table name the last row stays.
    assert (b.primary_table, b.primary_ord, b.primary_schema, b.spatial_ord, b.is_spatial) == ("", 4, "idx", 4, True)
    assert set(got) == {"a", "b"}
    assert catalog.pick_gateway(tables).collect()[0].gateway_id == "a"


def catalog_of(spark, *records):
    names = "dataset_id string, title string, organization string, source_type string, is_spatial boolean, has_openable boolean, file_only boolean, first_ord bigint"
    return spark.createDataFrame(list(records), names)


def test_search(spark):
    rec = [
        ("A" * 3, "אנדרטאות מ.א. רמת הנגב", "o", "ckan", True, True, False, 2),
        ("bbb", "Bus Stops", None, None, False, True, False, 1),
        ("0a0b0c0d-0000-1111-2222-33334444ABCD", "bus lines", "o", "ckan", True, True, True, 0),
    ]
    cat = catalog_of(spark, *rec)
    ids = lambda df: [r.dataset_id for r in df.collect()]
    assert ids(catalog.search_titles(cat, "אנדרטאות רמת הנגב")) == ["AAA"]
    assert ids(catalog.search_titles(cat, "BUS")) == ["bbb", rec[2][0]]
    assert ids(catalog.search_titles(cat, "bus", limit=1)) == ["bbb"]
    assert ids(catalog.search_titles(cat, "bus", spatial_only=True)) == [rec[2][0]]
    assert ids(catalog.search_titles(cat, " \t ")) == []
    assert ids(catalog.route_search(cat, "b")) == []
    assert ids(catalog.route_search(cat, f" {rec[2][0]} ")) == [rec[2][0]]
    # The lookup keeps case, and an id never falls back to titles.
    assert ids(catalog.route_search(cat, rec[2][0].lower())) == []
    # A missing source type is shown by a dash and not matched by it.
    assert [r[0] for r in catalog.source_types(cat).collect()] == ["ckan", "—"]
    assert ids(catalog.datasets(cat, source_type="—")) == []
    assert ids(catalog.datasets(cat, organization="—")) == ["bbb"]
    assert [r.organization for r in catalog.organizations(cat, "ckan").collect()] == ["o"]


def test_sort_by_title_is_stable(spark):
    cat = catalog_of(
        spark, ("x", "B", "o", "s", True, True, True, 0), ("y", "a", "o", "s", True, True, False, 9),
        ("z", "b", "o", "s", True, True, False, 3), ("w", None, "o", "s", True, True, False, 5),
    )
    assert [r.dataset_id for r in catalog.sort_by_title(cat).collect()] == ["w", "y", "z", "x"]


def test_top_datasets_counts_the_rest(spark):
    cat = catalog_of(spark, *[(f"d{i}", f"t{i % 10}", "o", "s", True, True, False, i) for i in range(500)], ("e", "t", None, "s", True, True, False, 600))
    top = rows(catalog.top_datasets(cat, cap=60).select("organization", "rank", "dataset_id", "overflow"), "organization", "rank")
    assert len(top) == 61 and top[0] == ("o", 1, "d0", 440) and top[59] == ("o", 60, "d91", 440)
    assert top[60] == ("—", 1, "e", 0)


def test_display_mode(spark):
    assert [catalog.display_mode(v) for v in ("1", 3, "x", None)] == [1, 3, 2, 2]


def numbered(spark, n):
    return spark.range(n).selectExpr("id * 3 AS feature_ord")


@pytest.mark.parametrize("n, cap, route, kept, cut", [
    (100, 100, "sql", 100, True), (100, 100, "features", 100, False), (101, 100, "features", 100, True),
    (99, 100, "sql", 99, False), (1, 100, "features", 1, False), (200_000, 50_000, "sql", 50_000, True),
])
def test_capped(spark, n, cap, route, kept, cut):
    got = features.capped(numbered(spark, n), cap, route)
    assert rows(got.groupBy("truncated").count()) == [(cut, kept)]
    assert got.agg({"feature_ord": "max"}).collect()[0][0] == (kept - 1) * 3


def test_capped_of_nothing(spark):
    assert features.capped(numbered(spark, 0), 5, "sql").collect() == []


FEATURES = "feature_ord bigint, table_name string, properties string, geojson string, xmin double, ymin double, xmax double, ymax double"


def feature_rows(spark, *records):
    return spark.createDataFrame([(i, "t", p, g, 0.0, 0.0, 0.0, 0.0) for i, (p, g) in enumerate(records)], FEATURES)


POINT = '{"type":"Point","coordinates":[0,0]}'


def test_schema_follows_the_first_record(spark):
    df = feature_rows(
        spark, ('{"z":1,"a":null,"f":1.0,"e":1e3,"t":true,"n":{"x":1},"l":[1],"geom":"g","s":"5","geometry_wkt":1}', POINT),
        ('{"a":5,"b":1}', POINT),
    )
    got = rows(features.infer_schema(df).select("field_ord", "field_name", "field_type"), "field_ord")
    assert [(n, t) for _, n, t in got] == [
        ("z", "BIGINT"), ("a", "STRING"), ("f", "DOUBLE"), ("e", "DOUBLE"), ("t", "BOOLEAN"), ("n", "STRING"),
        ("l", "STRING"), ("s", "STRING"),
    ]
    loaded = loads.load_layer(df, "t", "small")
    assert "b" not in loaded.columns and [r.a for r in loaded.orderBy("feature_ord").collect()] == [None, "5"]


def test_geometry_types(spark):
    df = feature_rows(spark, ("{}", None), ("{}", ""), ("{}", "not json"), ("{}", POINT))
    assert features.detect_geometry_type(df).collect()[0].geometry_type == fixed.DEFAULT_GEOMETRY_TYPE
    assert features.first_geometry_type(df).collect()[0].geometry_type is None
    other = feature_rows(spark, ("{}", None), ("{}", POINT))
    assert features.detect_geometry_type(other).collect()[0].geometry_type == "Point"
    assert features.first_geometry_type(other).collect()[0].geometry_type is None


def test_load_errors(spark):
    df = feature_rows(spark, ("{}", POINT))
    with pytest.raises(loads.LoadError):
        loads.load_layer(df, "", "x")
    with pytest.raises(loads.LoadError):
        loads.load_layer(df, "other", "x")
    with pytest.raises(loads.LoadError):
        loads.load_table(df, "t", "x", where='"feature_ord" > 5')


def test_free_query_takes_only_queries(spark):
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        loads.load_free_query(spark, "DROP TABLE x", "q")
    got = loads.load_free_query(spark, 'SELECT id AS "my id" FROM range(1000);', "q")
    assert got.columns == ["my id", "truncated"] and got.filter("truncated").isEmpty() and got.count() == 1000
    assert loads.load_free_query(spark, "SELECT id FROM range(1001)", "q", 1000).filter("truncated").count() == 1000
    assert loads.load_free_query(spark, "SELECT id FROM range(1001)", "q").filter("NOT truncated").count() == 1001
    own = loads.load_free_query(spark, "SELECT 7 AS row_no, 1 AS id, 2 AS id, 'mine' AS truncated, NULL AS nothing", "q")
    assert own.columns == ["row_no", "id", "id_2", "truncated", "nothing", "truncated_2"]
    assert rows(own) == [(7, 1, 2, "mine", None, False)]


def test_values_of_other_types_stay(spark):
    df = feature_rows(
        spark, ('{"v":5,"d":5,"b":true,"n":1,"id":1,"ID":2,"feature_ord":3,"table_name":"x","big":9007199254740993}', POINT),
        ('{"v":"x","d":5.5,"b":"yes","n":"7","id":2,"ID":4,"feature_ord":4,"table_name":"y","big":9007199254740995}', POINT),
        ('{"v":{"a":1},"d":7.0,"b":null,"n":7.0}', POINT),
    )
    got = loads.load_table(df, "t", "mixed").orderBy("feature_ord")
    assert got.columns == ["feature_ord", "v", "d", "b", "n", "id", "ID_2", "feature_ord_2", "table_name", "big", "truncated"]
    assert [tuple(r) for r in got.select("v", "d", "b", "n", "id", "ID_2", "feature_ord_2", "table_name", "big").collect()] == [
        ("5", 5.0, "true", 1, 1, 2, 3, "x", 9007199254740993), ("x", 5.5, "yes", 7, 2, 4, 4, "y", 9007199254740995),
        ('{"a":1}', 7.0, None, 7, None, None, None, None, None),
    ]
    assert loads.load_table(df, "t", "some", where='"n" = 7 AND "d" > 6').count() == 1
    assert loads.load_table(df, "t", "some", where="\"table_name\" = 'y'").count() == 1
    assert rows(loads.load_table(df, "t", "cut", row_cap=2).select("feature_ord", "truncated"), "feature_ord") == [(0, True), (1, True)]


def test_values_come_back_as_they_were(spark):
    """Whole numbers beyond doubles, leading zeros, texts that look like numbers, many digits, and repeated keys."""
    df = feature_rows(
        spark, ('{"big":5.5,"code":5,"odd":1.5,"long":1.25,"two":1,"two":2,"e":1,"small":0.5}', POINT),
        ('{"big":9007199254740993,"code":"007","odd":"1e400","long":0.1234567890123456789012,"two":3,"e":1e3,"small":"0.30000000000000004"}', POINT),
        ('{"odd":"3d","e":2.5,"big":-3}', POINT),
    )
    got = loads.load_table(df, "t", "true").orderBy("feature_ord")
    assert dict(got.dtypes) == {
        "feature_ord": "bigint", "big": "decimal(38,18)", "code": "string", "odd": "string", "long": "string", "two": "bigint",
        "e": "double", "small": "double", "truncated": "boolean",
    }
    values = [tuple(r) for r in got.drop("feature_ord", "truncated").collect()]
    assert [(int(b) if b == int(b) else float(b), *rest) for b, *rest in values] == [
        (5.5, "5", "1.5", "1.25", 2, 1.0, 0.5), (9007199254740993, "007", "1e400", "0.1234567890123456789012", 3, 1000.0, 0.30000000000000004),
        (-3, None, "3d", None, None, 2.5, None),
    ]
    assert loads.load_table(df, "t", "some", where='"big" > 9007199254740992').count() == 1


def test_capped_of_wide_keys(spark):
    wide = spark.createDataFrame([(-9 * 10**18,), (0,), (9 * 10**18,)], "feature_ord bigint")
    assert rows(features.capped(wide, 2, "features"), "feature_ord") == [(-9 * 10**18, True), (0, True)]


def test_deep_pages(spark):
    got = [r.feature_ord for r in features.page(numbered(spark, 5000), 7, 4321).collect()]
    assert got == [3 * i for i in range(4321, 4328)]
    cat = catalog_of(spark, *[(f"d{i}", "t", "o", "s", True, True, False, i) for i in range(300)])
    assert [r.dataset_id for r in catalog.list_datasets(cat, 3, 250).collect()] == ["d250", "d251", "d252"]
    assert catalog.list_datasets(cat, offset=250).count() == 50 and catalog.list_datasets(cat).count() == 300
    assert [r.rank for r in catalog.top_datasets(cat).orderBy("first_ord").collect()] == list(range(1, 301))


def test_lost_filters_by_quoted_and_bare_names(spark):
    filters = {
        "quoted": '"gone" = 5', "bare": "gone = 5", "kept": '"kept" = \'say "x" and gone\'', "any case": "KEPT > 1 AND kept IS NOT NULL",
        "exact": '"KEPT" = 1', "call": "lower(kept) LIKE 'a%' OR kept IN (1, 2)",
        "types": "CAST(kept AS INTEGER) = 5 AND kept < CURRENT_DATE AND kept IS UNKNOWN AND kept::text = 'a' AND kept::numeric(5, 2) > 1",
        "words": "CAST(kept AS double precision) > 1 OR kept::timestamp(3) with time zone < now() OR kept::\"Own\"[] IS NULL",
        "long": "kept = '" + "it''s " * 200_000 + "'", "open": "kept = '" + "it''s " * 20_000,
    }
    scan = spark.createDataFrame([(k, "update", "u", f"/x|subset={v}") for k, v in filters.items()], "layer_id string, status string, new_url string, source string")
    fields_of = spark.createDataFrame([("u", 0, "kept")], "download_url string, field_ord bigint, field_name string")
    # A literal that never ends is no literal, so its words are names.
    assert {r.layer_id for r in refresh.lost_filter_fields(scan, fields_of).collect()} == {"quoted", "bare", "exact", "open"}


def test_refresh_statuses(spark):
    ver = spark.createDataFrame(
        [(UID, 1, 1, 1, "2020-01-02T00:00:00", 10), (UID, 2, 3, 2, "2021-01-02T00:00:00", 0)], VERSIONS
    )
    res = spark.createDataFrame(
        [(1, UID, 0, "g", "", BASE + "aa_geojson.gz", None), (1, UID, 1, "c", "csv", BASE + "bb_t.csv", None),
         (2, UID, 0, "g", "", BASE + "cc_geojson.gz", None), (2, UID, 1, "g", "", BASE + "dd_geojson.gz", None),
         (2, UID, 2, "s", "zip", BASE + "ee_symbology.zip", None)],
        RESOURCES,
    )
    other = UID.replace("0a", "1a")
    source = {
        "update": f"/vsicurl/{BASE}aa_geojson.gz|subset=\"התרעה\" = 1", "current": f"/vsicurl/{BASE}dd_geojson.gz",
        "replaced": f"/vsicurl/{BASE}cc_geojson.gz", "missing": f"/vsicurl/{BASE}bb_t.csv",
        "unknown": f"/vsicurl/{BASE}99_geojson.gz", "error": f"/vsicurl/{BASE.replace(UID, other)}aa_geojson.gz", "local": "/a/b.gpkg",
    }
    lay = spark.createDataFrame([(k, k, 0, v) for k, v in source.items()], "layer_id string, layer_name string, group_id bigint, source string")
    old = spark.createDataFrame(
        [("update", i, n) for i, n in enumerate(["objectId", "התרעה", "מרחב"])], "layer_id string, field_ord bigint, field_name string"
    )
    new = spark.createDataFrame(
        [(BASE + "dd_geojson.gz", i, n) for i, n in enumerate(["objectId", "hatraha", "merchav"])],
        "download_url string, field_ord bigint, field_name string",
    )
    scan = refresh.refresh_scan(lay, ver, res, old, new)
    got = {r.layer_id: r for r in scan.collect()}
    assert {k: r.status for k, r in got.items()} == {
        "update": "update", "current": "current", "replaced": "update", "missing": "missing", "unknown": "update", "error": "error",
    }
    assert (got["update"].from_version, got["update"].to_version, got["update"].rows_after) == (1, 3, 0)
    assert got["update"].missing_fields == ["התרעה", "מרחב"] and got["update"].sym_url.endswith("ee_symbology.zip")
    # A file that lost its suffix within its version is known to no version.
    assert got["replaced"].from_version is None and got["unknown"].from_version is None
    assert (got["missing"].from_version, got["missing"].to_version) == (1, 3)
    planned = {r.layer_id: r for r in refresh.plan_updates(scan, new).collect()}
    assert planned["update"].new_source == f"/vsicurl/{BASE}dd_geojson.gz" and planned["update"].filter_lost
    assert planned["update"].result == "would update: aa_geojson.gz -> dd_geojson.gz"
    assert planned["unknown"].carried_filter is None and not planned["unknown"].filter_lost
    groups = spark.createDataFrame([(0, None, "")], "group_id bigint, parent_id bigint, group_name string")
    applied = refresh.plan_updates(scan, new, dry_run=False)
    report = {r.layer: r for r in refresh.refresh_report(applied, groups).collect()}
    assert report["unknown"].result == "vNone → v3" and report["unknown"].from_version == ""
    assert report["update"].renamed_fields == "התרעה, מרחב" and report["update"].rows_after == "0"
    assert rows(refresh.refresh_summary(scan)) == [(3, 1, 2, 6, 3)]


def test_group_paths_of_any_depth(spark):
    deep = [(0, None, "root")] + [(i, i - 1, f"g{i}") for i in range(1, 8)]
    groups = spark.createDataFrame(deep, "group_id bigint, parent_id bigint, group_name string")
    got = dict(rows(layers.group_paths(groups)))
    assert got[0] is None and got[7] == " / ".join(f"g{i}" for i in range(1, 8))


def test_group_paths_take_few_rounds(spark, monkeypatch):
    """A chain of 1,000 groups, a circle, and a group whose parent is not there."""
    rounds = []
    monkeypatch.setattr(layers, "written", lambda df, label: rounds.append(label) or written(df, label))
    deep = [(0, None, "root")] + [(i, i - 1, f"g{i}") for i in range(1, 1001)] + [(2001, 2002, "a"), (2002, 2001, "b"), (3000, 4000, "c")]
    groups = spark.createDataFrame(deep, "group_id bigint, parent_id bigint, group_name string")
    got = dict(rows(layers.group_paths(groups)))
    assert len(got) == 1001 and got[1000] == " / ".join(f"g{i}" for i in range(1, 1001))
    assert len(rounds) <= 13


def test_field_case(spark):
    own = spark.createDataFrame(
        [("l", 0, "term_name"), ("l", 1, "Term_Name"), ("l", 2, "stat1tendrtext"), ("l", 3, "X")], "layer_id string, field_ord bigint, field_name string"
    )
    refs = spark.createDataFrame(
        [("l", r) for r in ("TERM_NAME", "term_name", "stat1tendr", "shape", "", "X")] + [("none", "a")], "layer_id string, ref string"
    )
    got = {(r.layer_id, r.ref): (r.mapped, r.is_missing) for r in fields.reconcile_field_case(refs, own).collect()}
    assert got == {
        ("l", "TERM_NAME"): ("Term_Name", False), ("l", "term_name"): ("term_name", False), ("l", "stat1tendr"): ("stat1tendr", True),
        ("l", "shape"): ("shape", False), ("l", ""): ("", False), ("l", "X"): ("X", False), ("none", "a"): ("a", True),
    }


def test_style_outcomes(spark):
    sld = "<PropertyName>{}</PropertyName>"
    docs = spark.createDataFrame(
        [("fits", sld.format("a"), None), ("near", sld.format("stat1tendr"), '<q attr="a"/>'), ("lyr", None, '<q attr="A"/>'),
         ("lost", None, '<q attr="gone"/>'), ("captions", None, None)],
        "bundle_url string, sld string, qml string",
    )
    words = spark.createDataFrame([("captions", "a", "x"), ("only", "a", "x")], "bundle_url string, machine_name string, alias string")
    bundles = ["fits", "near", "lyr", "lost", "captions", "only", "nothing"]
    pairs = spark.createDataFrame([(b, b) for b in bundles], "layer_id string, bundle_url string")
    own = spark.createDataFrame(
        [(b, i, n) for b in bundles for i, n in enumerate(("a", "stat1tendrtext"))], "layer_id string, field_ord bigint, field_name string"
    )
    got = dict(rows(styles.style_outcome(pairs, docs, words, own).select("layer_id", "outcome")))
    assert got == {
        "fits": "styled", "near": "skipped", "lyr": "styled_lyr", "lost": "skipped", "captions": "aliases",
        "only": "aliases", "nothing": "none",
    }
    without = dict(rows(styles.style_outcome(pairs, docs, words, own, converter_available=False).select("layer_id", "outcome")))
    assert without["lyr"] == without["lost"] == "needs_slyr" and without["fits"] == "styled"


def test_last_registration_wins(spark):
    lay = spark.createDataFrame([("a", " /x.csv |layername=1"), ("b", "/y")], "layer_id string, source string")
    reg = spark.createDataFrame([("/x.csv", "old", 1), ("/x.csv|layerid=2", "new", 2), ("/x.csv", "", 3), ("", "z", 4)],
                                "uri string, bundle_url string, reg_ord bigint")
    assert rows(layers.layer_bundle(lay, reg).select("layer_id", "bundle_url"), "layer_id") == [("a", "new"), ("b", None)]


def test_search_by_a_table_of_texts(spark):
    """The same rows and ranks as one search for each text, among titles with odd letters, and without a cross join."""
    titles = ["Red Ring", "red herring", "אנדרטאות מ.א. רמת הנגב", "ab", "a", None, "", "ring of red rings", "İstanbul ring", "x.y (z)", "red ring"]
    cat = catalog_of(spark, *[(f"d{i}", t, "o", "s", True, True, False, i) for i, t in enumerate(titles * 3)])
    asked = ["red ring", " RING  red ", "אנדרטאות רמת הנגב", "a", "b", "", None, "  ", "zzz", "red zzz", "x.y", ".", "ring ring", "(z", "rin"]
    texts = spark.createDataFrame(list(enumerate(asked)), "text_id long, text string")
    for limit in (None, 2):
        got = search.search_table(cat, texts, limit)
        assert sorted((r.text_id, r.rank, r.dataset_id) for r in got.collect()) == sorted(
            (i, rank + 1, r.dataset_id) for i, text in enumerate(asked) for rank, r in enumerate(catalog.search_titles(cat, text or "", limit).collect())
        )
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
