"""Column expressions on cases that are easy to get wrong."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mapledger.functions import addresses, documents, files, geometry
from mapledger.functions.text import stripped


def values(spark, rows, names, *columns):
    df = spark.createDataFrame(rows, names)
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize(
    "url, ext",
    [
        ("https://h/a/8cef55fe_geojson.gz", "geojson"),
        ("https://h/a/x.GeoJSON.gz?download=1#top", "geojson"),
        ("https://h/a/x.csv///", "csv"),
        ("https://h/a/name", ""),
        ("https://h/a/name.gz", ""),
        ("https://h/a/name.gz.gz", "gz"),
        ("https://h/a/name_gz", "gz"),
        ("https://h/a/x.waytoolongext", ""),
        ("https://h/a/x_tab.waytoolongext", ""),
        ("https://h/a/report_v1.a-b", ""),
        ("https://h/a/my_file.x_table", "table"),
        ("https://h/a.b/c", ""),
        ("https://h/a?file=x.csv", ""),
        ("https://h/קובץ.שכבה", "שכבה"),
        ("https://h/a.geojson/.gz", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_ext_from_url(spark, url, ext):
    assert values(spark, [(url,)], "url string", files.ext_from_url(F.col("url"))) == [(ext,)]


@pytest.mark.parametrize(
    "fmt, url, ext",
    [
        ("", "https://h/8cef55fe_geojson.gz", "geojson"),
        (" .GeoParquet ", None, "parquet"),
        ("FlatGeobuf", "https://h/x.csv", "fgb"),
        ("JSON", None, "geojson"),
        (None, "https://h/x.json", "geojson"),
        ("..csv", None, "csv"),
        (" . ", "https://h/x.kml", "kml"),
    ],
)
def test_resource_ext(spark, fmt, url, ext):
    got = values(spark, [(fmt, url)], "fmt string, url string", files.resource_ext(F.col("fmt"), F.col("url")))
    assert got == [(ext,)]


def test_file_class(spark):
    rows = [("gpkg",), ("png",), ("shp",), ("lyrx",), ("ods",), ("pdf",), ("",)]
    got = values(spark, rows, "ext string", files.file_class(F.col("ext")).alias("c"))
    assert [tuple(r[0]) for r in got] == [
        ("spatial", "vector", True), ("spatial", "raster", False), ("spatial", "vector", False),
        ("spatial", None, False), ("data", "table", False), ("other", None, False), ("other", None, False),
    ]
    styled = values(spark, [("zip",), ("csv",)], "ext string", files.file_class(F.col("ext"), F.lit(True)).alias("c"))
    assert [tuple(r[0]) for r in styled] == [("spatial", None, False), ("data", "table", False)]


def test_open_attempts(spark):
    rows = [("u.geojson.gz", "geojson"), ("u", "geojson"), ("u", "gpkg"), ("u", "csv"), ("u", "kmz"), ("u", "zip")]
    got = values(spark, rows, "url string, ext string", files.open_attempts(F.col("url"), F.col("ext")))
    assert [r[0] for r in got] == [
        ["/vsigzip//vsicurl/u.geojson.gz", "/vsicurl/u.geojson.gz"],
        ["/vsicurl/u", "/vsigzip//vsicurl/u"],
        ["/vsicurl/u", "GPKG:/vsicurl/u"],
        ["CSV:/vsicurl/u", "/vsicurl/u"],
        ["/vsicurl/u", "KML:/vsicurl/u"],
        ["/vsicurl/u"],
    ]


def test_resource_suffix(spark):
    rows = [("8cef55fe_geojson.gz",), ("plain.csv",), ("a_b.csv",), ("ff_",), ("_x",), (None,)]
    got = values(spark, rows, "name string", addresses.resource_suffix(F.col("name")))
    assert [r[0] for r in got] == ["geojson.gz", "plain.csv", "b.csv", "ff_", "_x", ""]


def test_bucket_address(spark):
    uid = "0a0b0c0d-0000-1111-2222-333344445555"
    rows = [
        (f"/vsigzip//vsicurl/https://pub-9z.r2.dev/datasets/{uid}/v12/ab_geojson.gz|layername=x",),
        (f"https://PUB-9z.r2.dev/datasets/{uid}/v1/ab.csv",),
        (f"https://pub-9z.r2.dev/datasets/{uid}/v1/ab.csv?x=1",),
        (None,),
    ]
    source = F.col("s")
    got = values(spark, rows, "s string", addresses.bucket_dataset(source), addresses.bucket_file(source))
    assert got == [(uid, "ab_geojson.gz"), (None, None), (uid, "ab.csv"), (None, None)]


def test_retarget_source(spark):
    rows = [("x/ab.csv|layer=ab.csv|subset=\"a\" < 1\nAND ab.csv", "ab.csv", "c$1.csv"), (None, "a", "b")]
    column = addresses.retarget_source(F.col("s"), F.col("o"), F.col("n"))
    assert values(spark, rows, "s string, o string, n string", column) == [("x/c$1.csv|layer=c$1.csv",), ("",)]


def test_stripped(spark):
    rows = [("\u3000 a b\t\n",), ("\xa0x",), ("",)]
    assert [r[0] for r in values(spark, rows, "t string", stripped(F.col("t")))] == ["a b", "x", ""]


def test_absolutize_hrefs(spark):
    doc = (
        '<a xlink:href="icons/x.svg"/><a xlink:href="/abs.svg"/><a xlink:href="C:/w.svg"/>'
        '<a xlink:href="https://e.org/y.svg"/><a xlink:href="file:z"/><a xlink:href=""/>'
    )
    got = values(spark, [(doc,)], "d string", documents.absolutize_hrefs(F.col("d"), F.lit("/cache/$1/")))[0][0]
    assert got == doc.replace("icons/x.svg", "/cache/$1/icons/x.svg")


def test_rewrite_attributes(spark):
    doc = '<q attr="A" fieldName="B"><r attr="" attr="A"/>tail'
    spelling = F.create_map(F.lit("A"), F.lit("a$"))
    got = values(spark, [(doc,)], "d string", documents.rewrite_attributes(F.col("d"), spelling))[0][0]
    assert got == '<q attr="a$" fieldName="B"><r attr="" attr="a$"/>tail'
    nothing = F.create_map().cast("map<string,string>")
    assert values(spark, [("plain",)], "d string", documents.rewrite_attributes(F.col("d"), nothing)) == [("plain",)]


def test_property_refs(spark):
    doc = "<ogc:PropertyName>a</ogc:PropertyName><PropertyName>Shape</PropertyName><PropertyName>a</PropertyName>"
    assert values(spark, [(doc,)], "d string", documents.property_refs(F.col("d"))) == [(["a"],)]


def test_geometry_family(spark):
    rows = [("MULTIPOINT",), ("CompoundCurve",), ("PolyhedralSurface",), ("GeometryCollection",), (None,)]
    got = values(spark, rows, "k string", geometry.geometry_family(F.col("k")))
    assert [r[0] for r in got] == ["point", "line", "polygon", "collection", "collection"]


def test_clamp_box(spark):
    rows = [(-200.0, -95.0, 200.0, 95.0), (181.0, 0.0, 190.0, 1.0), (0.0, 0.0, 0.0, 1.0)]
    cut = geometry.clamp_box(*[F.col(c) for c in geometry.BOX])
    got = values(spark, rows, [*geometry.BOX], *cut.values())
    assert got[0] == (-180.0, -90.0, 180.0, 90.0, False)
    assert got[1][4] and got[2][4]
    assert geometry.clamp_literal((181, 0, 190, 1)) is None


SHAPES = {
    "point": '{"type":"Point","coordinates":[1,1]}',
    "points": '{"type":"MultiPoint","coordinates":[[9,9],[1,1]]}',
    "line across": '{"type":"LineString","coordinates":[[-5,1],[5,1]]}',
    "line past corner": '{"type":"LineString","coordinates":[[2.5,0],[0,2.5]]}',
    "line beyond corner": '{"type":"LineString","coordinates":[[5,0],[0,5]]}',
    "lines": '{"type":"MultiLineString","coordinates":[[[9,9],[8,8]],[[0,0],[1,1]]]}',
    "around": '{"type":"Polygon","coordinates":[[[-9,-9],[9,-9],[9,9],[-9,9],[-9,-9]]]}',
    "hole": '{"type":"Polygon","coordinates":[[[-9,-9],[9,-9],[9,9],[-9,9],[-9,-9]],[[-5,-5],[5,-5],[5,5],[-5,5],[-5,-5]]]}',
    "polygons": '{"type":"MultiPolygon","coordinates":[[[[20,20],[21,20],[20,21],[20,20]]],[[[-9,-9],[9,-9],[9,9],[-9,9],[-9,-9]]]]}',
    "away": '{"type":"Polygon","coordinates":[[[3,3],[4,3],[4,4],[3,3]]]}',
    "none": None,
}


def test_exact_box_test(spark):
    rows = list(SHAPES.items())
    sql = geometry.intersects_sql("g", "0D", "0D", "2D", "2D")
    got = dict(values(spark, rows, "name string, g string", "name", F.expr(sql)))
    assert got == {
        "point": True, "points": True, "line across": True, "line past corner": True, "line beyond corner": False,
        "lines": True, "around": True, "hole": False, "polygons": True, "away": False, "none": None,
    }
