"""Plans and hot keys: what has to hold when the data grows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.compare import TESTDATA
from checks.relations import Relations
from mapledger.functions import geometry
from mapledger.operators import features, ranks
from mapledger.operators.boxjoin import bbox_join
from mapledger.operators.catalog import first_per_group
from mapledger.operators.joins import split_join
from mapledger.session import fresh_path, shared_folder

SF_DIR = f"{TESTDATA}/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_box_filter_reaches_the_scan(spark, capsys):
    path = fresh_path(spark, "cells")
    features.store_features(Relations(spark, SF_DIR)("features"), path, cell_degrees=45.0)
    stored = spark.read.parquet(path)
    features.bbox_overlap(stored, (0, 0, 10, 10)).select("feature_ord").explain("formatted")
    plan = capsys.readouterr().out
    for pushed in ("LessThanOrEqual(xmin,10.0)", "GreaterThanOrEqual(xmax,0.0)", "LessThanOrEqual(ymin,10.0)"):
        assert pushed in plan
    assert "ReadSchema: struct<feature_ord:bigint,xmin:double,ymin:double,xmax:double,ymax:double>" in plan


HOT_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
}


@pytest.fixture
def splitting(spark):
    """Thresholds at which small tables have hot partitions."""
    before = {k: spark.conf.get(k, None) for k in HOT_SETTINGS}
    for k, v in HOT_SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_is_split(spark, splitting):
    left = spark.range(0, 400_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    right = spark.range(0, 400_000, 1, 8).select("id", F.col("id").alias("k")).repartition(8).groupBy("k").agg(F.max_by(F.col("id").cast("string"), "id").alias("w"))
    plans = []
    for joined in (split_join(left, right, ["k"], "left"), left.join(right, "k", "left")):
        total = joined.agg(F.count("w"), F.countDistinct("v"))
        assert tuple(total.collect()[0]) == (400_000, 400_000)
        plans.append("skew=true" in plan_of(total))
    # The plain join on the aggregate's own keys is not split.
    assert plans == [True, False]


def test_hot_group_of_ranks_is_split(spark, splitting):
    rows = spark.range(300_000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    rows = rows.withColumn("v", F.md5(F.col("id").cast("string")))
    total = ranks.ranked_in_groups(rows, ["g"], ["id"]).agg(F.max("rank"), F.count("rank"), F.countDistinct("v"))
    assert tuple(total.collect()[0]) == (200_000, 300_000, 300_000)
    assert re.search(r"SortMergeJoin\(skew=true\) \[g#", plan_of(total))


class Settings:
    """A session as far as the shared folder looks at it."""

    def __init__(self, master, **settings):
        self.sparkContext = self
        self.master, self.applicationId, self.conf = master, f"app-{master}", self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder():
    assert shared_folder(Settings("yarn", **{"spark.checkpoint.dir": "hdfs:///c/"})) == "hdfs:///c"
    assert shared_folder(Settings("local[2]", **{"spark.checkpoint.dir": "/c"})) == "/c"
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Settings(master, **{"spark.sql.warehouse.dir": "hdfs:///w"}))
    local = Settings("local[2]")
    assert shared_folder(local) == shared_folder(local) and "mapledger-" in shared_folder(local)


def brute_force(extents, shapes, exact):
    e = extents.select("extent_id", *[F.col(c).alias(f"e_{c}") for c in geometry.BOX])
    pairs = e.crossJoin(shapes).filter(
        "xmin <= least(e_xmax, 180) AND xmax >= greatest(e_xmin, -180) AND ymin <= least(e_ymax, 90) AND ymax >= greatest(e_ymin, -90)"
        " AND greatest(e_xmin, -180) < least(e_xmax, 180) AND greatest(e_ymin, -90) < least(e_ymax, 90) AND geojson <> ''"
    )
    if exact:
        cut = ["greatest(e_xmin, -180D)", "greatest(e_ymin, -90D)", "least(e_xmax, 180D)", "least(e_ymax, 90D)"]
        pairs = pairs.filter(F.expr(geometry.intersects_sql("geojson", *cut)))
    return sorted(tuple(r) for r in pairs.select("extent_id", "feature_ord").collect())


@pytest.mark.parametrize("exact", [False, True])
def test_box_join_equals_all_pairs(spark, exact):
    shapes = Relations(spark, SF_DIR)("features")
    # A third of the features sit in one small cell; some extents span the world.
    x = F.when((F.col("feature_ord") % 3 == 0) & F.col("xmin").isNotNull(), 10.1).otherwise(F.col("xmin"))
    shapes = shapes.withColumns({"xmin": x, "xmax": F.greatest("xmax", x)}).withColumn(
        "geojson", F.when(F.col("geojson") != "", F.concat(F.lit('{"type":"LineString","coordinates":[['), "xmin", F.lit(","), "ymin", F.lit("],["), "xmax", F.lit(","), "ymax", F.lit("]]}")))
    )
    extents = spark.createDataFrame(
        [(1, -200.0, -95.0, 200.0, 95.0), (2, 10.0, -20.0, 10.3, 35.0), (3, 181.0, 0.0, 190.0, 5.0), (4, -3.5, -3.5, 3.5, 3.5),
         (5, 10.1, -90.0, 10.2, 90.0), (6, 0.0, 0.0, 64.0, 64.0), (7, -64.0, -64.0, 0.0, 0.0), (8, 5.0, 5.0, 5.0, 9.0)],
        ["extent_id", *geometry.BOX],
    )
    got = sorted(tuple(r) for r in bbox_join(extents, shapes, exact=exact, rows_per_slice=20).collect())
    assert got == brute_force(extents, shapes, exact) and len(got) > 1000


def test_crowded_city_is_not_paired_up(spark):
    """Small extents and points in one spot: pairs compared are a small multiple of those that match."""
    spread = lambda n, salt: (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(250_000)) / 1_000_000.0)
    x, y = F.col("x"), F.col("y")
    extents = spark.range(2000).select(F.col("id").alias("extent_id"), (34 + spread(0, 1)).alias("x"), (32 + spread(0, 2)).alias("y"))
    extents = extents.select("extent_id", x.alias("xmin"), y.alias("ymin"), (x + 0.0005).alias("xmax"), (y + 0.0005).alias("ymax"))
    points = spark.range(20_000).select(F.col("id").alias("feature_ord"), (34 + spread(0, 3)).alias("x"), (32 + spread(0, 4)).alias("y"))
    points = points.select("feature_ord", *[c.alias(n) for c, n in zip((x, y, x, y), geometry.BOX)])
    got = bbox_join(extents, points).collect()
    e, p = extents.toPandas(), points.toPandas().sort_values("xmin")
    want = 0
    for row in e.itertuples():
        a, b = p.xmin.searchsorted(row.xmin, "left"), p.xmin.searchsorted(row.xmax, "right")
        want += int(p.ymin.iloc[a:b].between(row.ymin, row.ymax).sum())
    assert len(got) == len(set(got)) == want > 50


def test_exact_is_within_overlap(spark):
    shapes = Relations(spark, SF_DIR)("features")
    box = (-60.25, -30.0, 75.5, 41.75)
    assert features.intersects_box(shapes, box).join(features.bbox_overlap(shapes, box), "feature_ord", "left_anti").isEmpty()


def test_stored_box_is_the_box_of_the_geometry(spark):
    shapes = Relations(spark, SF_DIR)("features").filter("geojson IS NOT NULL")
    computed = features.with_box(shapes.select("feature_ord", "geojson"))
    same = shapes.join(computed, ["feature_ord", *geometry.BOX], "left_semi")
    assert same.count() == shapes.count()


def test_hot_group_top(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    top = first_per_group(df, ["g"], ["id"], 1500)
    hot = [r.id for r in top.filter("g = 'hot'").orderBy("rank").collect()]
    assert hot == [i for i in range(100_000) if i % 3 < 2][:1500]
    assert top.filter("g <> 'hot'").count() == len([i for i in range(100_000) if i % 3 == 2])


def test_stored_page_opens_its_own_files(spark):
    rows = spark.range(20_000).select((F.col("id") * 7 % 20_000).alias("k"), F.lit("x").alias("range"))
    path = ranks.store_in_order(rows, "k", rows_per_file=500)
    assert ranks.stored_total(spark, path).collect() == [(20_000,)]
    for offset, limit in ((0, 30), (1_234, 700), (19_990, 50), (20_000, 5)):
        page = ranks.stored_page(spark, path, limit, offset)
        want = list(range(offset, min(offset + limit, 20_000)))
        assert [(r.k, r.position) for r in page.collect()] == [(i, i) for i in want]
        opened = [f for f in page.inputFiles() if "/rows/" in f]
        assert len(opened) <= limit // 500 + 3 or not want
    nothing = ranks.store_in_order(rows.limit(0), "k")
    assert ranks.stored_page(spark, nothing, 5).collect() == [] and ranks.stored_total(spark, nothing).collect() == [(0,)]
