"""Reading real files and writing results."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from mapledger import session
from mapledger.functions import fixed
from mapledger.sources import payloads, results, snapshots


def texts(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_payload_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"tables": [\n {"table": "t", "columns": [{"name": "geom", "type": "geometry"}]}]}')
    with gzip.open(tmp_path / "b.json.gz", "wt") as f:
        f.write('[{"table": "u", "organization": "o"}, {"table": "v"}]')
    answers = payloads.read_payloads(spark, str(tmp_path)).withColumn("payload_no", F.col("file_name"))
    got = payloads.catalog_tables(answers).orderBy("place").collect()
    assert [r.table_name for r in got] == ["t", "u", "v"] and got[0].columns[0].name == "geom" and got[1].organization == "o"
    empty = texts(spark, [(0, "{}"), (1, '{"tables": null}')], "payload_no bigint, payload string")
    assert payloads.catalog_tables(empty).collect() == []


def test_dataset_pages_keep_all_pages(spark):
    def page(*ids, wrap=True):
        items = [{"id": i, "organization": {"name": "N"} if i == "a" else "plain", "new_resources_at_source": [{"format": "PDF"}]} for i in ids]
        return json.dumps({"items": items} if wrap else items)

    answers = texts(spark, [(4, page("d")), (0, page("a", "b")), (2, page("c", wrap=False))], "page_offset bigint, payload string")
    got = payloads.dataset_pages(answers).orderBy("listing_ord").collect()
    assert [(r.listing_ord, r.dataset_id, r.organization, r.formats) for r in got] == [
        (0, "a", "N", ["PDF"]), (1, "b", "plain", ["PDF"]), (2, "c", "plain", ["PDF"]),
        (4, "d", "plain", ["PDF"]),
    ]
    full = texts(spark, [(0, page("a", "b")), (2, '{"items": []}'), (4, page("e"))], "page_offset bigint, payload string")
    assert payloads.dataset_pages(full).count() == 3


def test_tables_by_header(spark, tmp_path):
    """Columns are matched by name, and a large file is read by several tasks."""
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n2,1\n")
    (tmp_path / "c.csv").write_text("a,c\n1,3\n")
    got = snapshots.read_resource(spark, str(tmp_path), "csv").select("a", "b", "c").collect()
    assert sorted((r.a, r.b, r.c) for r in got if r.b) == [("1", "2", None)] * 2 and [r.c for r in got if r.c] == ["3"]
    large = tmp_path / "large"
    large.mkdir()
    (large / "x.csv").write_text("a,b\n" + "1,2\n" * 300_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        read = snapshots.read_resource(spark, str(large), "csv")
        assert read.rdd.getNumPartitions() > 4 and read.count() == 300_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_versions_in_any_wrapper(spark):
    version = {"version_number": 2, "change_summary": {"total_rows": 7, "resources": [{"name": "x", "rows": 0}]},
               "resources": [{"name": "x", "download_url": "u"}, {"odata_resource_url": "o"}]}
    answers = texts(
        spark,
        [("list", json.dumps([version])), ("second", json.dumps({"versions": {}, "items": [version]})),
         ("last", json.dumps({"results": [version]})), ("none", json.dumps({"detail": "gone"}))],
        "dataset_id string, payload string",
    )
    parsed = payloads.versions(answers)
    assert sorted((r.dataset_id, r.version_number, r.total_rows) for r in parsed.collect()) == [
        ("last", 2, 7), ("list", 2, 7), ("second", 2, 7)
    ]
    assert payloads.version_resources(parsed).filter("odata_url = 'o'").count() == 3
    assert [r.rows_count for r in payloads.version_change_rows(parsed).collect()] == [0, 0, 0]


def test_geojson_and_records(spark):
    page = '{"features": [{"properties": {"b": 1.50, "a": "x"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"geometry": {}}, {"properties": null, "geometry": null}]}'
    got = payloads.geojson_features(texts(spark, [("t", 0, page)], "table_name string, page_no bigint, payload string")).collect()
    assert json.loads(got[0].geojson)["type"] == "Point" and list(json.loads(got[0].properties)) == ["b", "a"]
    assert [(r.properties, r.geojson) for r in got[1:]] == [("{}", None), ("{}", None)]
    answers = texts(
        spark,
        [(0, '{"result": {"records": [{"z": 1, "a": 2}], "truncated": true}}'), (1, '{"records": [1]}'), (2, '{"result": [2, 3]}'), (3, "[4]"), (4, "{}")],
        "payload_no bigint, payload string",
    )
    rows = payloads.search_records(answers).orderBy("payload_no", "pos").collect()
    assert [(r.payload_no, r.truncated) for r in rows] == [(0, True), (1, False), (2, False), (2, False), (3, False)]
    assert list(json.loads(rows[0].record)) == ["z", "a"]


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "a_fields.csv").write_bytes(
        '\ufeffis_served,hebrew_alias,machine_name\r\n1,"שם, ארוך\nבשתי שורות"," x "\r\n1,ראשון,y\r\n1,אחרון,y\r\n1,,z\r\n'.encode()
    )
    got = {(r.bundle_url, r.machine_name): r.alias for r in snapshots.read_field_dictionary(spark, str(tmp_path)).collect()}
    assert got == {("a_fields.csv", "x"): "שם, ארוך\nבשתי שורות", ("a_fields.csv", "y"): "אחרון"}


def test_archives(spark):
    members = {
        "both.zip": ["icons", "s.SLD", "t.sld", "x_fields.csv", "a.lyr"], "lyr.zip": ["a.shp", "b.LYRX"],
        "nested.zip": ["sub"], "case.zip": ["X_FIELDS.CSV"],
    }
    rows = [(url, pos, name) for url, names in members.items() for pos, name in enumerate(names)]
    listed = spark.createDataFrame(rows, "bundle_url string, pos long, member string")
    got = {r.bundle_url: (r.sld, r.fields_csv, r.lyr) for r in snapshots.bundle_manifest(listed).collect()}
    assert got == {"both.zip": ("s.SLD", "x_fields.csv", None), "lyr.zip": (None, None, "b.LYRX")}


def test_long_dictionaries_and_headers(spark, tmp_path):
    """100,000 quoted lines in one file, and a header of 5,000 quoted names, are walked through once."""
    lines = "".join(f'"name, {i} ""q""\nline two",x{i},1\r\n' for i in range(100_000))
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "long_fields.csv").write_text("hebrew_alias,machine_name,is_served\r\n" + lines, newline="")
    rows = snapshots.read_field_dictionary(spark, str(tmp_path / "a"))
    assert rows.count() == 100_000
    assert rows.filter("machine_name = 'x99999'").first().alias == 'name, 99999 "q"\nline two'
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "wide.csv").write_text(",".join(f'"f ""{i}"", x"' for i in range(5000)) + "\n1\n")
    names = snapshots.file_field_names(spark, str(tmp_path / "b")).orderBy("field_ord").collect()
    assert [r.field_name for r in names] == [f'f "{i}", x' for i in range(5000)]


def test_cells(spark):
    texts = ['a,b', 'a,,', '', '"a,b" ,c', 'x"y,z', '"open, and\nnever closed', ' "q""" ,', '"" ,""', 'a,"b\r\nc"\r\nd,"e"\r\n\r\nf']
    table = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = table.orderBy("i").select(F.transform(snapshots._records(F.col("t")), lambda x: snapshots._cells(x)).alias("r")).collect()
    assert [r.r for r in got] == [
        [["a", "b"]], [["a", "", ""]], [], [["a,b", "c"]], [['x"y', "z"]], [["open, and\nnever closed"]], [['q"', ""]], [["", ""]],
        [["a", "b\r\nc"], ["d", "e"], ["f"]],
    ]


def test_report_and_results(spark, tmp_path):
    report = spark.createDataFrame([tuple(None if c == "to_version" else c for c in fixed.REPORT_COLUMNS)], ", ".join(f"{c} string" for c in fixed.REPORT_COLUMNS))
    for fmt in ("parquet", "csv"):
        results.write_refresh_report(report, str(tmp_path / fmt), fmt)
    assert spark.read.parquet(str(tmp_path / "parquet")).collect()[0].to_version == ""
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == list(fixed.REPORT_COLUMNS)
    mixed = spark.createDataFrame([(1, "{}"), (2, None), (3, "")], "a int, _geojson string")
    assert results.materialize_result(mixed, "mixed").count() == 1 and spark.table("mixed").count() == 1
    bare = spark.createDataFrame([(1, None), (2, "")], "a int, _geojson string")
    assert results.materialize_result(bare, "bare").count() == 2
    assert results.materialize_result(mixed, "plain", spatial=False).columns == ["a"]


def test_large_collection_is_cut_among_tasks(spark, tmp_path):
    def features(n, extra):
        geometry = [None, {}, {"type": "Point", "coordinates": [1, 1.5]}]
        tricky = 'a}"{,[\\"features":[' + extra
        return [{"type": "Feature", "properties": {"i": i, "t": tricky, "n": {"x": [{"y": 1}], "features": [{"z": 1}]}}, "geometry": geometry[i % 3]}
                for i in range(n)]

    crs = {"type": "name", "properties": {"name": "x", "features": [{"q": 1}]}}
    wanted = {"large": features(3000, "ש"), "indented": features(40, "b")}
    large = {"links": [{"a": {"b": [1]}}], "crs": crs, "note": '"features":[', "features": wanted["large"]}
    (tmp_path / "large").write_text(json.dumps(large, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "indented").write_text(json.dumps({"features": wanted["indented"], "crs": crs, "more": [{"a": {}}]}, indent=2))
    (tmp_path / "none").write_text('{"features": [ ]  , "other":[{"features":[{"a":{}}]}]}')
    (tmp_path / "single").write_text(json.dumps(features(1, "c")[0]))
    (tmp_path / "blank").write_text("")
    (tmp_path / "broken").write_text('{"features":[{"properties":{"i":0}},{"properties":{"i":1}')
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(tmp_path / "large"), lineSep="}").rdd.getNumPartitions() > 20
        got = snapshots.read_resource(spark, str(tmp_path), "geojson").orderBy("table_name", "page_pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert {r.table_name for r in got} == {"large", "indented", "broken"}
    for name, items in wanted.items():
        rows = [r for r in got if r.table_name == name]
        assert [r.page_pos for r in rows] == list(range(len(items)))
        assert [json.loads(r.properties) for r in rows] == [f["properties"] for f in items]
        assert [json.loads(r.geojson) if r.geojson else None for r in rows] == [f["geometry"] or None for f in items]
    assert [r.properties for r in got if r.table_name == "broken"] == ['{"i":0}']


def test_stored_tables_end_with_their_job(spark, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr(session, "shared_folder", lambda _: str(shared))
    rows = spark.range(10).selectExpr("id", "CASE WHEN id < 3 THEN '{}' END AS _geojson")
    with session.job(spark):
        session.written(rows, "outer")
        with session.job(spark):
            assert session.written(rows, "inner").count() == 10
            results.materialize_result(rows, "kept_result")
        assert sorted(p.name.split("-")[0] for p in shared.iterdir()) == ["free", "outer"]
    with pytest.raises(KeyError), session.job(spark):
        session.written(rows, "failed")
        raise KeyError("a job that fails")
    assert [p.name.split("-")[0] for p in shared.iterdir()] == ["free"] and spark.table("kept_result").count() == 3
    results.drop_result(spark, "kept_result")
    results.drop_result(spark, "kept_result")
    assert list(shared.iterdir()) == [] and not spark.catalog.tableExists("kept_result")
