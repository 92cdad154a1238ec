"""Queries that read answers and files of the service, written by Spark from the relations first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.operators.fields import clean_dictionary
from mapledger.session import fresh_path
from mapledger.sources import payloads, snapshots

from .registry import registered

PAGE = 500


def stored(answers: DataFrame, label: str) -> DataFrame:
    """Answers as JSON lines in the shared folder, read back."""
    path = fresh_path(answers.sparkSession, label)
    answers.write.option("compression", "gzip").json(path)
    return answers.sparkSession.read.schema(answers.schema).json(path)


def paged(rows: DataFrame, ordinal: str, item, keys: list[str] | None = None) -> DataFrame:
    """At most one page of items per row, in order; ``item`` is a JSON text column."""
    keys = keys or []
    numbered = rows.select(
        *keys, (F.col(ordinal) - F.col(ordinal) % PAGE).alias("page_offset"),
        F.struct(F.col(ordinal).alias("o"), item.alias("item")).alias("i"),
    )
    grouped = numbered.groupBy(*keys, "page_offset").agg(F.sort_array(F.collect_list("i")).alias("items"))
    listed = F.concat(F.lit("["), F.array_join(F.transform("items", lambda i: i["item"]), ","), F.lit("]"))
    return grouped.withColumn("list", listed).drop("items")


@registered(
    "read_catalog_tables",
    """SELECT t.table_ord - t.table_ord % 500 AS payload_no, row_number() OVER (PARTITION BY t.table_ord - t.table_ord % 500 ORDER BY t.table_ord) - 1 AS pos,
       t.table_name, t.schema_name, t.dataset_id, t.ckan_id, t.title, t.organization, t.source_type, t.est_rows, t.versions_url, c.names
       FROM catalog_tables t LEFT JOIN (SELECT table_ord, string_agg(column_name||':'||column_type, ',' ORDER BY col_ord) AS names FROM catalog_columns GROUP BY table_ord) c USING (table_ord)""",
    ("catalog_tables", "catalog_columns"),
)
def _(r):
    # A table has at most five columns here.
    columns = r("catalog_columns").groupBy("table_ord").agg(
        F.sort_array(F.collect_list(F.struct("col_ord", F.col("column_name").alias("name"), F.col("column_type").alias("type"))))
        .alias("columns")
    )
    tables = r("catalog_tables").join(columns, "table_ord")
    fields = ["dataset_id", "ckan_id", "title", "organization", "source_type", "est_rows", "versions_url", "columns"]
    item = F.to_json(F.struct(F.col("table_name").alias("table"), F.col("schema_name").alias("schema"), *fields))
    pages = paged(tables, "table_ord", item)
    bare = F.col("page_offset") % (2 * PAGE) == 0
    answers = pages.select(
        F.col("page_offset").alias("payload_no"),
        F.when(bare, F.col("list")).otherwise(F.concat(F.lit('{"tables":'), "list", F.lit("}"))).alias("payload"),
    )
    rows = payloads.catalog_tables(stored(answers, "answers-tables"))
    names = F.array_join(F.transform("columns", lambda c: F.concat(c["name"], F.lit(":"), c["type"])), ",")
    return rows.select(
        "place.payload_no", F.col("place.pos").cast("bigint").alias("pos"), "table_name", "schema_name", *fields[:-1],
        names.alias("names"),
    )


@registered(
    "read_dataset_pages",
    """SELECT l.listing_ord, l.dataset_id, l.title, l.organization, l.source_type, l.ckan_id, l.versions_url, coalesce(f.formats,'') AS formats
       FROM dataset_listing l LEFT JOIN (SELECT dataset_id, string_agg(format, ',' ORDER BY fmt_ord) AS formats FROM dataset_source_formats GROUP BY dataset_id) f USING (dataset_id)""",
    ("dataset_listing", "dataset_source_formats"),
)
def _(r):
    # A dataset offers at most five formats here.
    formats = r("dataset_source_formats").groupBy("dataset_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("fmt_ord", "format"))), lambda f: F.struct(f["format"].alias("format")))
        .alias("new_resources_at_source")
    )
    named = F.when(
        F.col("listing_ord") % 2 == 0, F.parse_json(F.to_json(F.struct(F.col("organization").alias("name"))))
    ).otherwise(F.parse_json(F.concat(F.lit('"'), "organization", F.lit('"'))))
    listing = r("dataset_listing").join(formats, "dataset_id", "left")
    item = F.to_json(F.struct(
        F.col("dataset_id").alias("id"), "title", named.alias("organization"), "source_type", "ckan_id", "versions_url",
        "new_resources_at_source",
    ))
    pages = paged(listing, "listing_ord", item)
    answers = pages.select("page_offset", F.concat(F.lit('{"limit":500,"items":'), "list", F.lit("}")).alias("payload"))
    rows = payloads.dataset_pages(stored(answers, "answers-datasets"))
    return rows.withColumn("formats", F.coalesce(F.array_join("formats", ","), F.lit("")))


@registered(
    "read_versions",
    """SELECT r.dataset_id, r.version_id, v.version_number, v.detected_at, v.total_rows, r.name, r.format, r.download_url, r.odata_url, x.name AS counted_name, x.rows_count
       FROM resources r JOIN versions v USING (version_id) JOIN resource_rows x ON x.version_id = r.version_id AND x.row_ord = r.res_ord""",
    ("resources", "versions", "resource_rows"),
)
def _(r):
    # One answer per resource: a version with that resource and its row count.
    # Counts are a list of their version, as long as its answer, so that the wide resources are shuffled once, by version.
    counts = r("resource_rows").groupBy("version_id").agg(
        F.collect_list(F.struct("row_ord", F.col("name").alias("counted"), "rows_count")).alias("counts")
    )
    counts = r("versions").drop("dataset_id", "version_ord").join(counts, "version_id")
    rows = r("resources").join(counts, "version_id").withColumn(
        "c", F.explode(F.filter("counts", lambda c: c["row_ord"] == F.col("res_ord")))
    ).select("*", "c.counted", "c.rows_count")
    version = F.to_json(F.struct(
        "version_number", "detected_at",
        F.struct("total_rows", F.array(F.struct(F.col("counted").alias("name"), F.col("rows_count").alias("rows"))).alias("resources"))
        .alias("change_summary"),
        F.array(F.struct("name", "format", "download_url", F.col("odata_url").alias("odata_resource_url"))).alias("resources"),
    ))
    listed = F.concat(F.lit("["), version, F.lit("]"))
    wrapped = F.lit(None).cast("string")
    for number, key in enumerate(("versions", "items", "results"), 1):
        wrapped = F.when(F.col("version_id") % 4 == number, F.concat(F.lit(f'{{"{key}":'), listed, F.lit("}"))).otherwise(wrapped)
    answers = rows.select(
        F.concat_ws("/", "dataset_id", "version_id").alias("dataset_id"), F.coalesce(wrapped, listed).alias("payload")
    )
    parsed = payloads.versions(stored(answers, "answers-versions"))
    one = parsed.select(
        F.split("dataset_id", "/")[0].alias("dataset_id"), F.split("dataset_id", "/")[1].cast("bigint").alias("version_id"),
        "version_number", "detected_at", "total_rows", F.explode("resources").alias("f"), F.col("change_rows")[0].alias("c"),
    )
    return one.select(
        "dataset_id", "version_id", "version_number", "detected_at", "total_rows", "f.name", "f.format", "f.download_url",
        F.col("f.odata_resource_url").alias("odata_url"), F.col("c.name").alias("counted_name"), F.col("c.rows").alias("rows_count"),
    )


LISTED_VERSIONS = """
WITH v AS (SELECT dataset_id, version_id, row_number() OVER (PARTITION BY dataset_id ORDER BY version_ord) - 1 AS version_ord FROM versions)"""


def listed_versions(r) -> DataFrame:
    """Parsed answers, one per dataset with all its versions, of several resources and row counts."""
    def parts(rows: DataFrame, order: str, name: str, *fields) -> DataFrame:
        # A version has a handful of resources here.
        item = F.struct(F.col(order).alias("o"), F.struct(*fields).alias("item"))
        listed = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["item"])
        return rows.groupBy("version_id").agg(listed.alias(name))

    files = parts(r("resources"), "res_ord", "resources", "name", "format", "download_url", F.col("odata_url").alias("odata_resource_url"))
    counts = parts(r("resource_rows"), "row_ord", "counts", "name", F.col("rows_count").alias("rows"))
    versions = r("versions").join(files, "version_id", "left").join(counts, "version_id", "left")
    version = F.to_json(F.struct(
        "version_number", "detected_at", F.struct("total_rows", F.col("counts").alias("resources")).alias("change_summary"), "resources"
    ))
    answers = versions.groupBy("dataset_id").agg(
        F.sort_array(F.collect_list(F.struct("version_ord", version.alias("item")))).alias("items")
    )
    listed = F.concat(F.lit('{"versions":['), F.array_join(F.transform("items", lambda i: i["item"]), ","), F.lit("]}"))
    return payloads.versions(stored(
        answers.select("dataset_id", listed.alias("payload")), "answers-listed-versions"
    ))


@registered(
    "version_resources",
    f"""{LISTED_VERSIONS} SELECT v.dataset_id, v.version_ord, row_number() OVER (PARTITION BY version_id ORDER BY r.res_ord) - 1 AS res_ord,
        r.name, r.format, r.download_url, r.odata_url FROM resources r JOIN v USING (version_id)""",
    ("resources", "versions"),
)
def _(r):
    return payloads.version_resources(listed_versions(r))


@registered(
    "version_change_rows",
    f"""{LISTED_VERSIONS} SELECT v.dataset_id, v.version_ord, row_number() OVER (PARTITION BY version_id ORDER BY x.row_ord) - 1 AS row_ord,
        x.name, x.rows_count FROM resource_rows x JOIN v USING (version_id)""",
    ("resource_rows", "versions"),
)
def _(r):
    return payloads.version_change_rows(listed_versions(r))


@registered(
    "read_geojson_features",
    """SELECT table_name, feature_ord - feature_ord % 500 AS page_no,
       row_number() OVER (PARTITION BY table_name, feature_ord - feature_ord % 500 ORDER BY feature_ord) - 1 AS page_pos,
       coalesce(properties,'{}') AS properties, geojson FROM features""",
    ("features",),
)
def _(r):
    item = F.concat(
        F.lit('{"type":"Feature","properties":'), F.coalesce("properties", F.lit("null")),
        F.lit(',"geometry":'), F.coalesce("geojson", F.lit("null")), F.lit("}"),
    )
    pages = paged(r("features"), "feature_ord", item, ["table_name"])
    answers = pages.select(
        "table_name", F.col("page_offset").alias("page_no"),
        F.concat(F.lit('{"type":"FeatureCollection","features":'), "list", F.lit(',"exceededTransferLimit":true}')).alias("payload"),
    )
    return payloads.geojson_features(stored(answers, "answers-features"))


@registered(
    "read_search_records",
    """SELECT event_id - event_id % 500 AS payload_no, row_number() OVER (PARTITION BY event_id - event_id % 500 ORDER BY event_id) - 1 AS pos,
       event_id, event_type, (event_id - event_id % 500) % 2000 = 0 AS truncated FROM events""",
)
def _(r):
    item = F.to_json(F.struct("event_id", "event_type"))
    pages = paged(r("events"), "event_id", item)
    place = F.col("page_offset") % (4 * PAGE)
    payload = (
        F.when(place == 0, F.concat(F.lit('{"success":true,"result":{"truncated":true,"records":'), "list", F.lit("}}")))
        .when(place == PAGE, F.concat(F.lit('{"records":'), "list", F.lit("}")))
        .when(place == 2 * PAGE, F.concat(F.lit('{"result":'), "list", F.lit("}")))
        .otherwise(F.col("list"))
    )
    answers = pages.select(F.col("page_offset").alias("payload_no"), payload.alias("payload"))
    rows = payloads.search_records(stored(answers, "answers-records"))
    record = F.from_json("record", "event_id BIGINT, event_type STRING")
    return rows.select("payload_no", "pos", record.event_id.alias("event_id"), record.event_type.alias("event_type"), "truncated")


# Large collections, so that the files of a table are few: every file costs the driver memory for each scan of it.
FEATURES_PER_FILE = 500_000


def feature_files(rows: DataFrame, ordinal: str, properties) -> DataFrame:
    """Lines of FeatureCollection files, each in one task and in order, with their ``file_no``; a line holds one feature."""
    number = F.coalesce(F.floor(F.col(ordinal) / FEATURES_PER_FILE), F.lit(-1))
    item = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":null}'))
    body = rows.select(number.alias("file_no"), F.lit(1).alias("part"), item.alias("value"))
    ends = body.select("file_no").distinct()
    head, tail = (
        ends.select("file_no", F.lit(part).alias("part"), F.lit(text).alias("value")) for part, text in ((0, '{"features":['), (2, "null]}"))
    )
    lines = body.withColumn("value", F.concat("value", F.lit(","))).unionByName(head).unionByName(tail)
    return lines.repartition("file_no").sortWithinPartitions("file_no", "part").drop("part")


@registered(
    "read_resource",
    """SELECT x.ext, count(*) AS n, cast(sum(o_orderkey) AS bigint) AS key_sum FROM orders, (VALUES ('csv'), ('tsv'), ('txt'), ('parquet'), ('geojson')) AS x(ext) GROUP BY x.ext""",
)
def _(r):
    orders = r("orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    results = []
    for ext in ("csv", "tsv", "txt", "parquet", "geojson"):
        path = fresh_path(r.spark, f"snapshot-{ext}")
        if ext in ("csv", "tsv"):
            orders.write.csv(path, header=True, sep="," if ext == "csv" else "\t")
        elif ext == "txt":
            orders.select(F.col("o_orderkey").cast("string")).write.text(path)
        elif ext == "parquet":
            orders.write.parquet(path)
        else:
            feature_files(orders, "o_orderkey", F.to_json(F.struct("o_orderkey"))).write.partitionBy("file_no").text(path)
        rows = snapshots.read_resource(r.spark, path, ext)
        key = {
            "txt": "value", "geojson": "get_json_object(properties, '$.o_orderkey')",
        }.get(ext, "o_orderkey")
        results.append(rows.agg(
            F.lit(ext).alias("ext"), F.count("*").alias("n"), F.sum(F.expr(key).cast("bigint")).alias("key_sum")
        ))
    first, *rest = results
    for other in rest:
        first = first.unionByName(other)
    return first


def dictionary_files(r) -> DataFrame:
    """The field dictionary of every bundle as CSV bytes; a dictionary has five lines here."""
    line = F.concat_ws(",", *[F.concat(F.lit('"'), c, F.lit('"')) for c in ("alias", "machine_name")], F.lit("yes"))
    lines = r("field_dictionary").groupBy("bundle_url").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("line_no", line.alias("line")))), lambda x: x["line"]).alias("lines")
    )
    text = F.concat(F.lit("﻿hebrew_alias,machine_name,is_served\r\n"), F.array_join("lines", "\r\n"))
    return lines.select("bundle_url", F.encode(text, "UTF-8").alias("content"))


@registered(
    "read_field_dictionary",
    """SELECT bundle_url, trim(machine_name) AS machine_name, trim(alias) AS alias FROM field_dictionary
       WHERE trim(machine_name) <> '' AND trim(alias) <> '' QUALIFY row_number() OVER (PARTITION BY bundle_url, trim(machine_name) ORDER BY line_no DESC) = 1""",
    ("field_dictionary",),
)
def _(r):
    path = fresh_path(r.spark, "dictionaries")
    dictionary_files(r).write.parquet(path)
    return clean_dictionary(snapshots.field_dictionary_lines(r.spark.read.parquet(path)))


def bundle_members(r) -> DataFrame:
    """The top-level names of an archive per bundle: notes, icons, and the styles and dictionary it has."""
    captions = r("field_dictionary").groupBy("bundle_url").agg(F.bool_or(F.trim("alias") != "").alias("named"))
    docs = r("style_docs").join(captions, "bundle_url", "left")
    names = F.array_compact(F.array(
        F.lit("README.txt"), F.lit("icons"), F.when(F.col("sld").isNotNull(), "layer_1.SLD"), F.when(F.col("qml").isNotNull(), "layer.lyr"),
        # Half of the bundles get a dictionary, so that some archives hold nothing of use.
        F.when(F.col("named") & (F.sha1("bundle_url") < "8"), "layer_fields.csv"),
    ))
    return docs.select("bundle_url", F.posexplode(names).alias("pos", "member"))


@registered(
    "bundle_manifest",
    """SELECT d.bundle_url, CASE WHEN d.sld IS NOT NULL THEN 'layer_1.SLD' END AS sld, CASE WHEN f.bundle_url IS NOT NULL THEN 'layer_fields.csv' END AS fields_csv,
       CASE WHEN d.sld IS NULL AND d.qml IS NOT NULL THEN 'layer.lyr' END AS lyr
       FROM style_docs d LEFT JOIN (SELECT bundle_url FROM field_dictionary WHERE substr(sha1(bundle_url),1,1) < '8' GROUP BY bundle_url HAVING bool_or(trim(alias) <> '')) f
       USING (bundle_url) WHERE d.sld IS NOT NULL OR d.qml IS NOT NULL OR f.bundle_url IS NOT NULL""",
    ("style_docs", "field_dictionary"),
)
def _(r):
    return snapshots.bundle_manifest(bundle_members(r))


@registered(
    "file_field_names",
    """SELECT head, row_number() OVER (PARTITION BY head ORDER BY p_type) - 1 AS field_ord, p_type||', "'||lower(p_type)||'"' AS field_name
       FROM (SELECT DISTINCT regexp_extract(p_brand,'[0-9]+')||'-'||cast(p_size AS string) AS head, p_type FROM part) h""",
)
def _(r):
    # A file for every brand and size; its header names the types of its parts, with commas and quotes, and a row follows.
    head = F.concat_ws("-", F.regexp_extract("p_brand", "[0-9]+", 0), F.col("p_size").cast("string")).alias("head")
    heads = r("part").groupBy(head).agg(F.sort_array(F.collect_set("p_type")).alias("types"))
    quoted = F.transform("types", lambda t: F.concat(F.lit('"'), t, F.lit(', ""'), F.lower(t), F.lit('"""')))
    path = fresh_path(r.spark, "headers")
    files = heads.select("head", F.concat(F.array_join(quoted, ","), F.lit("\nx")).alias("value"))
    files.write.partitionBy("head").text(path)
    names = snapshots.file_field_names(r.spark, path)
    return names.select(F.regexp_extract("file", "head=([^/]+)", 1).alias("head"), "field_ord", "field_name")
