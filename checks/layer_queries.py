"""Queries over saved layers and the refresh job."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger.functions import addresses
from mapledger.operators import fields as field_ops
from mapledger.operators import layers as ops
from mapledger.operators import resources as resource_ops
from mapledger.operators import versions as version_ops
from mapledger.plans import refresh
from mapledger.session import fresh_path, written
from mapledger.sources import results

from . import duck
from .registry import registered


def scan(r):
    return refresh.refresh_scan(
        r("layers"), r("versions"), r("resources"), r("layer_fields"), r("file_fields")
    )


def scan_table(r):
    """The scan as a table, which planning reads several times."""
    return written(scan(r), "refresh-scan")


@registered(
    "parse_bucket_source",
    f"SELECT layer_id, {duck.bucket('source', 1)} AS dataset_id, {duck.bucket('source', 2)} AS old_file FROM layers",
    ("layers",),
)
def _(r):
    source = F.col("source")
    return r("layers").select(
        "layer_id", addresses.bucket_dataset(source).alias("dataset_id"), addresses.bucket_file(source).alias("old_file")
    )


@registered(
    "retarget_source",
    f"""WITH {duck.SAVED} SELECT layer_id, CASE WHEN contains(s,'|subset=') THEN substr(s,1,strpos(s,'|subset=')-1) ELSE s END AS new_source
        FROM (SELECT layer_id, replace(source, old_file, 'ffff_'||suffix) AS s FROM saved) x""",
    ("layers",),
)
def _(r):
    saved = ops.bucket_layers(r("layers"))
    new_file = F.concat(F.lit("ffff_"), addresses.resource_suffix(F.col("old_file")))
    return saved.select(
        "layer_id", addresses.retarget_source(F.col("source"), F.col("old_file"), new_file).alias("new_source")
    )


@registered("norm_source", "SELECT layer_id, trim(split_part(source,'|',1)) AS source_key FROM layers", ("layers",))
def _(r):
    return r("layers").select("layer_id", addresses.norm_source(F.col("source")).alias("source_key"))


GROUP_PATHS = """
walk AS (SELECT group_id, cast(NULL AS varchar) AS path FROM layer_groups WHERE parent_id IS NULL
         UNION ALL SELECT g.group_id, concat_ws(' / ', w.path, g.group_name) FROM layer_groups g JOIN walk w ON g.parent_id = w.group_id)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def recursive_query(sql: str, *needs: str) -> str:
    """A twin whose chain holds a recursive relation."""
    from .relations import duck_query

    return _recursive(duck_query(sql, *needs))


@registered("group_path")
def _(r):
    return ops.layer_paths(r("layers"), r("layer_groups")).select("layer_id", "path")


@registered(
    "layer_current_version",
    f"WITH {duck.SCAN} SELECT s.layer_id, c.version_number AS from_version, c.detected AS from_detected, c.total_rows AS rows_before"
    " FROM saved s LEFT JOIN current_version c ON c.dataset_id = s.dataset_id AND c.file_name = s.old_file",
    duck.SCAN_NEEDS,
)
def _(r):
    files = resource_ops.files_by_suffix(r("resources"))
    found = ops.layer_current_version(r("layers"), files, r("versions"))
    return found.select("layer_id", "from_version", "from_detected", "rows_before")


@registered(
    "layer_latest_file",
    f"WITH {duck.SCAN} SELECT s.layer_id, n.file_name AS new_file, n.download_url AS new_url FROM saved s LEFT JOIN latest l USING (dataset_id)"
    " LEFT JOIN version_files n ON n.version_id = l.version_id AND n.suffix = s.suffix",
    duck.SCAN_NEEDS,
)
def _(r):
    latest = version_ops.latest_version(r("versions"))
    newest = r("resources").join(latest.select("version_id"), "version_id", "left_semi")
    found = ops.layer_latest_file(r("layers"), resource_ops.files_by_suffix(newest), latest)
    return found.select("layer_id", "new_file", "new_url")


@registered(
    "schema_drift",
    f"WITH {duck.SCAN} SELECT layer_id, renamed FROM drift",
    duck.SCAN_NEEDS,
)
def _(r):
    stale = refresh.refresh_scan(r("layers"), r("versions"), r("resources")).filter("status = 'update'")
    drift = field_ops.schema_drift(stale, r("layer_fields"), r("file_fields"))
    return drift.select("layer_id", F.array_join("missing_fields", ", ").alias("renamed"))


@registered(
    "names_difference",
    """SELECT l.layer_id, l.field_ord, l.field_name FROM layer_fields l
       WHERE l.field_name NOT IN (SELECT trim(machine_name) FROM field_dictionary)""",
    ("layer_fields", "field_dictionary"),
)
def _(r):
    captioned = r("field_dictionary").select(F.trim("machine_name").alias("field_name")).distinct()
    return field_ops.names_difference(r("layer_fields"), captioned, ["field_name"])


SCAN_COLUMNS = (
    "layer_id", "dataset_id", "old_file", "status", "new_file", "from_version", "from_detected", "rows_before",
    "to_version", "to_detected", "rows_after", "sym_url", "message",
)


@registered(
    "refresh_scan",
    f"WITH {duck.SCAN} SELECT {', '.join('s.' + c for c in SCAN_COLUMNS)}, coalesce(d.renamed,'') AS renamed FROM scanned s LEFT JOIN drift d USING (layer_id)",
    duck.SCAN_NEEDS,
)
def _(r):
    return scan(r).select(*SCAN_COLUMNS, F.array_join("missing_fields", ", ").alias("renamed"))


@registered(
    "chosen_layers",
    f"""WITH {duck.SAVED} SELECT s.layer_id, s.old_file FROM saved s WHERE EXISTS (SELECT 1 FROM layer_fields f WHERE f.layer_id = s.layer_id AND f.field_name = 'term_name')""",
    ("layers", "layer_fields"),
)
def _(r):
    wanted = r("layer_fields").filter("field_name = 'term_name'")
    return ops.chosen_layers(ops.bucket_layers(r("layers")), wanted).select("layer_id", "old_file")


PLANNED = f"""{duck.SCAN},
filters AS (SELECT layer_id, CASE WHEN contains(source,'|subset=') THEN substr(source, strpos(source,'|subset=') + 8) END AS f FROM scanned),
named AS (SELECT s.layer_id, s.new_url, unnest(regexp_extract_all(x.f, '"([^"]+)"', 1)) AS field_name FROM scanned s JOIN filters x USING (layer_id) WHERE s.status = 'update'),
lost AS (SELECT DISTINCT n.layer_id FROM named n WHERE n.new_url IN (SELECT download_url FROM file_fields)
         AND NOT EXISTS (SELECT 1 FROM file_fields f WHERE f.download_url = n.new_url AND f.field_name = n.field_name)),
planned AS (SELECT s.*, x.f AS layer_filter, z.layer_id IS NOT NULL AS filter_lost,
    CASE WHEN s.new_file IS NOT NULL THEN replace(CASE WHEN x.f IS NULL THEN s.source ELSE substr(s.source,1,strpos(s.source,'|subset=')-1) END, s.old_file, s.new_file) END AS new_source
    FROM scanned s JOIN filters x USING (layer_id) LEFT JOIN lost z USING (layer_id))"""


@registered(
    "plan_updates_dry",
    f"""WITH {PLANNED} SELECT layer_id, status, new_source, CASE WHEN status = 'update' THEN layer_filter END AS carried_filter, filter_lost,
        CASE WHEN status = 'update' THEN 'would update: '||old_file||' -> '||new_file ELSE message END AS result FROM planned""",
    duck.SCAN_NEEDS,
)
def _(r):
    planned = refresh.plan_updates(scan_table(r), r("file_fields"))
    return planned.select("layer_id", "status", "new_source", "carried_filter", "filter_lost", "result")


@registered(
    "plan_updates",
    f"""WITH {PLANNED} SELECT layer_id, status, new_source, filter_lost,
        CASE WHEN status = 'update' THEN 'v'||coalesce(cast(from_version AS varchar),'None')||' → v'||coalesce(cast(to_version AS varchar),'None')
             ||CASE WHEN filter_lost THEN ' (הסינון לא הוחל מחדש — ייתכן ששם השדה השתנה)' ELSE '' END ELSE message END AS result FROM planned""",
    duck.SCAN_NEEDS,
)
def _(r):
    planned = refresh.plan_updates(scan_table(r), r("file_fields"), dry_run=False)
    return planned.select("layer_id", "status", "new_source", "filter_lost", "result")


REPORT = f"""{PLANNED}, {GROUP_PATHS},
report AS (SELECT concat_ws(' / ', w.path, p.layer_name) AS layer, p.dataset_id AS dataset, p.status,
    coalesce(cast(nullif(p.from_version,0) AS varchar),'') AS from_version, coalesce(p.from_detected,'') AS from_detected,
    coalesce(cast(nullif(p.to_version,0) AS varchar),'') AS to_version, coalesce(p.to_detected,'') AS to_detected,
    coalesce(cast(p.rows_before AS varchar),'') AS rows_before, coalesce(cast(p.rows_after AS varchar),'') AS rows_after,
    coalesce(d.renamed,'') AS renamed_fields,
    CASE WHEN p.status = 'update' THEN 'would update: '||p.old_file||' -> '||p.new_file ELSE p.message END AS result
    FROM planned p LEFT JOIN walk w USING (group_id) LEFT JOIN drift d USING (layer_id))"""


def report(r):
    return refresh.refresh_report(refresh.plan_updates(scan_table(r), r("file_fields")), r("layer_groups"))


@registered("refresh_report")
def _(r):
    return report(r)


@registered("write_refresh_report")
def _(r):
    path = fresh_path(r.spark, "refresh-report")
    results.write_refresh_report(report(r), path)
    return r.spark.read.parquet(path)


@registered(
    "refresh_summary",
    f"""WITH {duck.SCAN} SELECT count(*) FILTER (WHERE status = 'update') AS updated, count(*) FILTER (WHERE status = 'current') AS current,
        count(*) FILTER (WHERE status IN ('missing','error')) AS skipped, count(*) AS total, count(*) FILTER (WHERE status = 'update') AS updatable FROM scanned""",
    duck.SCAN_NEEDS,
)
def _(r):
    return refresh.refresh_summary(refresh.refresh_scan(r("layers"), r("versions"), r("resources")))


def _add_recursive_twins():
    from .registry import ORACLES

    needs = (*duck.SCAN_NEEDS, "layer_groups")
    ORACLES["group_path"] = recursive_query(
        f"WITH {GROUP_PATHS} SELECT l.layer_id, concat_ws(' / ', w.path, l.layer_name) AS path FROM layers l LEFT JOIN walk w USING (group_id)",
        "layers", "layer_groups",
    )
    ORACLES["refresh_report"] = recursive_query(f"WITH {REPORT} SELECT * FROM report", *needs)
    ORACLES["write_refresh_report"] = ORACLES["refresh_report"]


_add_recursive_twins()
