"""What a query may write, move or keep when the data grows."""

from __future__ import annotations

import os
import re
import time

import duckdb
from pyspark.sql import functions as F

from checks import queries as registered, source_queries
from checks.compare import TESTDATA, compare
from checks.registry import ORACLES, QUERIES
from checks.relations import _WRITTEN, Relations
from mapledger.functions import geometry
from mapledger.operators import fields, joins, ranks, search
from mapledger.operators.boxjoin import bbox_join
from mapledger.plans import refresh
from mapledger.session import fresh_path, shared_folder, written
from mapledger.sources import snapshots

SF_DIR = f"{TESTDATA}/sf0.001"


def exchanges(df) -> int:
    return df._jdf.queryExecution().sparkPlan().toString().count("Exchange") + df._jdf.queryExecution().executedPlan().toString().count("Exchange hash")


def test_exact_pairs_are_not_moved(spark):
    """The look at the geometry costs no exchange: pairs may be far more than rows."""
    r = Relations(spark, SF_DIR)
    extents = r("extents").filter("crs = 'EPSG:4326'")
    assert exchanges(bbox_join(extents, r("features"), exact=True)) == exchanges(bbox_join(extents, r("features")))
    shapes = r("features").select("feature_ord", *geometry.BOX, F.lit(None).cast("string").alias("geojson"))
    got = bbox_join(extents, shapes, exact=True)
    assert got.join(bbox_join(extents, shapes), ["extent_id", "feature_ord"], "left_anti").isEmpty()


def stored_sizes(spark, label):
    """Rows of every table stored under a label, by its path."""
    folder = shared_folder(spark).removeprefix("file://")
    return {n: spark.read.parquet(f"{folder}/{n}").count() for n in os.listdir(folder) if n.startswith(f"{label}-")}


def test_equal_texts_are_one_question(spark):
    """What is compared grows with the titles and with the different texts, not with their product with equal ones."""
    titles = spark.range(0, 300).select(F.col("id").alias("ord"), F.concat(F.lit("Red ring "), F.col("id").cast("string")).alias("title"))
    texts = spark.range(0, 200).select(F.col("id").alias("text_id"), F.when(F.col("id") % 2 == 0, "ring RED").otherwise(" red  ring red").alias("text"))
    before = set(stored_sizes(spark, "search-candidates"))
    for limit, wanted in ((None, 300), (3, 3)):
        got = search.search_table(titles, texts, limit, order=("ord",))
        assert got.columns == ["ord", "text_id", "title", "rank"]
        assert got.groupBy("text_id").agg(F.countDistinct("ord").alias("n"), F.max("rank").alias("m")).filter(f"n = {wanted} AND m = {wanted}").count() == 200
    made = {n: rows for n, rows in stored_sizes(spark, "search-candidates").items() if n not in before}
    assert list(made.values()) == [300, 300]


def test_frequent_names_stay_where_they_are(spark):
    rows = spark.range(0, 60).select("id", F.when(F.col("id") % 4 < 3, F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None)), (F.col("id") % 4 + 1).cast("int")))
                                     .otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("name"))
    rows = rows.unionAll(rows)
    known = spark.createDataFrame([("a",), ("a",), ("n3",), (None,)], "name string")
    want = sorted(map(str, rows.join(known, "name", "left_anti").select("id", "name").collect()))
    for hot in (5, 100):
        assert sorted(map(str, fields.names_difference(rows, known, ["name"], hot).collect())) == want


def test_features_lie_in_few_files(spark):
    """Files are as many as spans of half a million keys, not as pages; each is a whole collection."""
    path = fresh_path(spark, "collections")
    rows = spark.range(0, 5_000, 1, 8).unionAll(spark.range(700_000, 700_003)).select(F.col("id").alias("o"))
    source_queries.feature_files(rows, "o", F.to_json(F.struct("o"))).write.partitionBy("file_no").text(path)
    assert len(spark.read.text(path).inputFiles()) == 2
    got = snapshots.read_resource(spark, path, "geojson").agg(
        F.count("*").alias("n"), F.sum(F.get_json_object("properties", "$.o").cast("bigint")).alias("s")
    ).first()
    assert (got.n, got.s) == (5_003, sum(range(5_000)) + 2_100_003)


def test_answers_hold_all_versions(spark):
    """An answer is of a whole dataset, however far its versions lie apart, under the dataset's own id."""
    r = Relations(spark, SF_DIR)
    for name, rows in (("version_resources", r("resources")), ("version_change_rows", r("resource_rows"))):
        got = QUERIES[name](spark, SF_DIR)
        assert got.count() == rows.count()
        assert got.select("dataset_id").distinct().join(r("versions"), "dataset_id", "left_anti").isEmpty()


def test_stored_answers_are_compressed(spark):
    path = source_queries.stored(spark.range(10).select(F.repeat(F.lit("a"), 10_000).alias("payload")), "answers-test")
    assert path.count() == 10 and all(f.endswith(".json.gz") for f in path.inputFiles())


def test_repeated_text_ids_are_ranked_together(spark):
    titles = spark.createDataFrame([(i, f"red ring {i}") for i in range(4)], "ord int, title string")
    texts = spark.createDataFrame([(1, "red"), (1, "red"), (2, "ring"), (None, "ring")], "text_id int, text string")
    got = [(r.text_id, r.rank) for r in search.search_table(titles, texts, 5, order=("ord",)).collect()]
    assert sorted(got) == [(1, n) for n in range(1, 6)] + [(2, n) for n in range(1, 5)]


def test_fields_of_a_file_lie_together(spark):
    """Addresses are made distinct before they get their fields, so the fields of one are never spread again."""
    r = Relations(spark, SF_DIR)
    fields_of = r("file_fields").withColumn("part", F.input_file_name())
    assert fields_of.groupBy("download_url").agg(F.countDistinct("part").alias("n")).filter("n > 1").isEmpty()
    assert fields_of.select("download_url", "field_ord").distinct().count() == fields_of.count() > 0


def test_layers_meet_their_file_once(spark):
    """Names of filters and files are lists: one join, and one exchange of the layers for it."""
    url = spark.sparkContext.parallelize([("u", n) for n in ("A", "b", None)] + [("empty", None)]).toDF("download_url string, field_name string")
    rows = [("kept", "u", 'x|subset="A" = 1 AND B = 2'), ("case", "u", 'x|subset="a" = 1'), ("gone", "u", "x|subset=c > 1"),
            ("unread", "v", "x|subset=c > 1"), ("nameless", "empty", "x|subset=c > 1"), ("plain", "u", "x"), ("plain", None, "x|subset=c > 1")]
    scan = spark.sparkContext.parallelize([(*r, "update") for r in rows]).toDF("layer_id string, new_url string, source string, status string")
    lost = refresh.lost_filter_fields(scan, url)
    assert sorted(r.layer_id for r in lost.collect()) == ["case", "gone", "nameless"]
    assert refresh.lost_filter_fields(scan, url)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 4


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_picks_move_what_is_read(spark):
    """A pick of one row per version sorts and shuffles only the columns that are read afterwards."""
    for name in ("pick_default", "pick_default_first"):
        assert "/vsicurl/" not in optimized(registered.QUERIES[name](spark, SF_DIR))
    plan = optimized(registered.QUERIES["layer_current_version"](spark, SF_DIR))
    assert "max_by(" in plan and not re.search(r"max_by\([^)]*download_url", plan)


def test_picks_take_one_row(spark):
    """Equal orders, missing values and missing keys: all columns come from the same row, as from one struct."""
    rows = spark.createDataFrame(
        [(1, 5, "a", None), (1, 5, None, "b"), (1, 7, "c", "c"), (None, 1, "d", None), (None, None, None, "e"), (2, None, "f", "g")],
        "k int, o int, x string, y string",
    ).coalesce(1)
    for pick in (F.min_by, F.max_by):
        for order in (F.struct("o"), F.col("o")):
            whole = rows.groupBy("k").agg(pick(F.struct("o", "x", "y"), order).alias("r")).select("k", "r.*")
            got = joins.picked(rows, ["k"], pick, order)
            assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_long_addresses_meet_by_digest(spark):
    """Sources, files and captions meet under 16 bytes; missing and run-together names do not meet."""
    named = spark.createDataFrame([(1, "b1", "x"), (2, "b", "1x"), (3, None, "x"), (4, "b1", None), (5, "b1", "y")], "i int, bundle_url string, field_name string")
    words = spark.createDataFrame([("b1", "x", "X"), (None, "x", "N")], "bundle_url string, machine_name string, alias string")
    captioned = fields.apply_captions(named, words)
    assert captioned.columns == ["bundle_url", "field_name", "i", "caption"]
    got = {r.i: r.caption for r in captioned.collect()}
    assert got == {1: "X", 2: "1x", 3: "x", 4: None, 5: "y"}
    for name in ("layer_bundle", "layer_current_version", "apply_captions"):
        assert "sha2(" in optimized(registered.QUERIES[name](spark, SF_DIR))


def test_versions_meet_files_once(spark):
    """Files of all versions are shuffled for one join, with what is known of their version."""
    spark_limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = optimized(registered.QUERIES["dataset_contents"](spark, SF_DIR))
        newest = plan[plan.index("Join LeftSemi"):].splitlines()
        assert "Aggregate" in newest[1]
        plan = optimized(registered.QUERIES["layer_latest_file"](spark, SF_DIR))
        assert plan.count("Join LeftSemi") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", spark_limit)


def tables_with_odd_keys(spark, label):
    """Customers, parts, orders and lines with keys that repeat, are missing or meet nothing; returns folder and DuckDB views."""
    folder = fresh_path(spark, label).removeprefix("file://")
    key = F.when(F.col("id") % 11 != 10, F.col("id") % 20)
    made = {
        "customer": spark.range(25).select(key.alias("c_custkey")),
        "part": spark.range(30).select(key.alias("p_partkey")),
        "orders": spark.range(60).select(
            F.when(F.col("id") % 13 != 12, F.col("id") % 50).alias("o_orderkey"), F.when(F.col("id") % 7 != 6, F.col("id") % 23).alias("o_custkey"),
            F.lit("O").alias("o_orderstatus"), F.lit(1.5).alias("o_totalprice"), F.lit("1995-03-01 00:00:00").cast("timestamp").alias("o_orderdate"),
        ),
        "lineitem": spark.range(900).select(
            F.when(F.col("id") % 17 != 16, F.col("id") % 53).alias("l_orderkey"), F.when(F.col("id") % 19 != 18, F.col("id") % 30).alias("l_partkey"),
            (F.col("id") % 5).alias("l_suppkey"), (F.col("id") % 8).cast("int").alias("l_linenumber"), (F.col("id") % 40).cast("double").alias("l_quantity"),
        ),
    }
    con = duckdb.connect()
    for name, rows in made.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return folder, con


def test_tables_behind_narrow_ones_are_not_stored(spark):
    """Dictionaries and styles are derived from the tables at once; what another relation of the query needs is stored."""
    of_layers = {"dataset_ids", "versions", "resources", "layers", "layer_fields"}
    for name, stored in (
        ("clean_dictionary", {"field_dictionary"}), ("absolutize_styles", {"style_docs"}), ("bundle_manifest", {"field_dictionary", "style_docs"}),
        ("names_difference", {"field_dictionary", *of_layers}),
    ):
        folder, con = tables_with_odd_keys(spark, f"odd-{name}")
        good, text = compare(spark, con, name, QUERIES[name], ORACLES[name], folder)
        assert good and not text.startswith("0 rows"), text
        assert {relation for _, at, relation in _WRITTEN if at == folder} == stored


def test_pieces_of_collections_are_not_broadcast(spark, tmp_path):
    """Stored pieces are compressed and look small; what has a row for each of them never goes through the driver."""
    (tmp_path / "c.geojson").write_text('{"features":[' + ",".join('{"properties":{"a":%d}}' % n for n in range(200)) + "]}")
    got = snapshots.read_resource(spark, str(tmp_path), "geojson")
    assert got.count() == 200
    plan = got._jdf.queryExecution().sparkPlan().toString()
    # The bounds alone, a row for each file, may be.
    assert "block" not in "".join(re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan))


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return files.count("/shuffle_")


def test_stored_tables_leave_no_shuffles(spark):
    """The shuffles behind a table go as soon as it is written, and the session's setting is as before."""
    rows = spark.range(0, 1_000, 1, 4).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    before = shuffle_files(spark)
    assert written(rows, "no-shuffles").count() == 7
    kept = [1]
    for _ in range(50):
        kept.append(shuffle_files(spark) - before)
        if kept[-1] <= 8:
            break
        time.sleep(0.1)
    assert kept[-1] <= 8  # those of the count
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_resolved_steps_are_removed(spark, monkeypatch):
    """The refresh scan is made in stored steps; what they stored is gone when the scanned layers are stored."""
    at = []
    monkeypatch.setattr(refresh, "written", lambda df, label, path=None: at.append((label, path or fresh_path(spark, label))) or written(df, label, at[-1][1]))
    r = Relations(spark, SF_DIR)
    scan = refresh.refresh_scan(*[r(name) for name in ("layers", "versions", "resources", "layer_fields", "file_fields")])
    assert scan.count() == r("layers").filter("source LIKE '%r2.dev%'").count() > 0
    left = {label for label, path in at if os.path.exists(path.removeprefix("file:").replace("//", "/", 1))}
    assert left == {"scanned-layers", "drifted-layers"} < {label for label, _ in at}


def test_rows_that_meet_nothing_stay(spark, monkeypatch):
    """Only rows whose key may be known are moved; keys that repeat, are missing or share a mark join as in a left join."""
    left = spark.range(400).select(F.when(F.col("id") % 9 != 8, F.concat(F.lit("L"), (F.col("id") % 150).cast("string"))).alias("k"), F.col("id").alias("wide"))
    right = spark.createDataFrame([("L3", 1), ("L3", 2), ("L140", 3), (None, 4), ("none", 5)], "k string, v int")
    want = sorted(map(str, left.join(right, "k", "left").select("k", "wide", "v").collect()))
    for marks in (joins.MARKS, 16):
        monkeypatch.setattr(joins, "MARKS", marks)
        assert sorted(map(str, joins.seldom_join(left, right, "k").select("k", "wide", "v").collect())) == want
        nothing = joins.seldom_join(left, right.limit(0), "k")
        assert nothing.count() == 400 and nothing.filter("v IS NOT NULL").isEmpty()
    monkeypatch.setattr(joins, "MARKS", 1 << 25)
    moved = optimized(joins.seldom_join(left, right, "k")).split("Join LeftOuter, ((")[1]
    assert "getbit" in moved


def test_layers_of_read_resources_are_not_stored(spark):
    """A query that reads resources derives layers and their fields from them as it reads."""
    folder, con = tables_with_odd_keys(spark, "odd-restated")
    for name in ("style_missing_refs", "refresh_scan"):
        good, text = compare(spark, con, name, QUERIES[name], ORACLES[name], folder)
        assert not text.startswith("0 rows"), text
    stored = {relation for _, at, relation in _WRITTEN if at == folder}
    assert "resources" in stored and not stored & {"layers", "layer_fields"}


def test_captions_meet_by_bundle(spark):
    """The fields of a layer are moved together, to the captions of their bundle; repeated captions make as many rows."""
    named = spark.createDataFrame([(f"l{n % 5}", None if n % 5 == 4 else "b", f"f{n // 5}") for n in range(50)], "layer_id string, bundle_url string, field_name string")
    words = spark.createDataFrame([("b", "f1", "one"), ("b", "f1", "uno"), ("b", None, "x"), (None, "f2", "y")], "bundle_url string, machine_name string, alias string")
    got = fields.apply_captions(named, words)
    assert sorted(r.caption for r in got.filter("field_name = 'f1'").collect()) == ["f1"] + ["one"] * 4 + ["uno"] * 4
    assert got.count() == 54 and "bundle_key" in optimized(got)


def test_searched_rows_are_narrow(spark, monkeypatch):
    """Ranked matches are stored with the columns that are searched and shown only."""
    kept = []
    monkeypatch.setattr(ranks, "written", lambda df, label: kept.extend(df.columns) or written(df, label))
    assert registered.QUERIES["search_table_all"](spark, SF_DIR).count() > 0
    assert "table_ord" in kept and not {"dataset_id", "versions_url", "organization"} & set(kept)
