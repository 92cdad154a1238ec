"""Queries over style documents, field dictionaries and captions."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger.functions import documents
from mapledger.operators import fields as field_ops
from mapledger.operators import layers as layer_ops
from mapledger.operators import resources as resource_ops
from mapledger.operators import styles as ops
from mapledger.plans.styles import style_audit
from mapledger.session import written

from . import duck
from .registry import registered

CACHE = "/cache/styles"


def links_made_absolute(doc: str, attribute: str, base: str) -> str:
    """DuckDB text: absolute links are marked, the others get the base, the mark goes away."""
    marked = f"""regexp_replace({doc}, '{attribute}="((?:[A-Za-z]:|/|https?://|file:)[^"]*)"', '{attribute}=' || chr(1) || '"\\1"', 'g')"""
    based = f"""regexp_replace({marked}, '{attribute}="([^"]+)"', '{attribute}="{base}/\\1"', 'g')"""
    return f"""replace({based}, '{attribute}=' || chr(1) || '"', '{attribute}="')"""


@registered(
    "absolutize_styles",
    f"SELECT bundle_url, {links_made_absolute('sld', 'xlink:href', CACHE)} AS sld FROM style_docs WHERE sld IS NOT NULL",
    ("style_docs",),
)
def _(r):
    docs = r("style_docs").filter("sld IS NOT NULL")
    return docs.select("bundle_url", documents.absolutize_hrefs(F.col("sld"), F.lit(CACHE)).alias("sld"))


@registered(
    "absolutize_pages", f"SELECT page_id, {links_made_absolute('html', 'href', CACHE)} AS html FROM pages"
)
def _(r):
    pages = r("pages")
    return pages.select("page_id", documents.absolutize_hrefs(F.col("html"), F.lit(CACHE + "/"), "href").alias("html"))


@registered(
    "page_attribute_refs",
    """SELECT ref, count(*) AS pages FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?:class|href)="([^"]+)"', 1)) AS ref FROM pages) x GROUP BY ref""",
)
def _(r):
    refs = documents.attribute_refs(F.col("html"), r'(?:class|href)="([^"]+)"')
    return r("pages").select(F.explode(refs).alias("ref")).groupBy("ref").agg(F.count("*").alias("pages"))


DICTIONARY = """
dictionary AS (SELECT bundle_url, trim(machine_name) AS machine_name, trim(alias) AS alias FROM field_dictionary
    WHERE trim(machine_name) <> '' AND trim(alias) <> ''
    QUALIFY row_number() OVER (PARTITION BY bundle_url, trim(machine_name) ORDER BY line_no DESC) = 1)"""


@registered("clean_dictionary", f"WITH {DICTIONARY} SELECT * FROM dictionary", ("field_dictionary",))
def _(r):
    return field_ops.clean_dictionary(r("field_dictionary"))


BUNDLED = f"""{duck.CLASSIFIED},
archives AS (SELECT version_id, download_url AS bundle_url FROM classified WHERE ext = 'zip' AND download_url IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY version_id ORDER BY CASE WHEN contains(lower(name),'symbology') THEN 0 ELSE 1 END, res_ord) = 1),
known AS (SELECT c.uri AS source_key, a.bundle_url FROM classified c JOIN archives a USING (version_id) JOIN versions v USING (version_id)
    WHERE c.layer_kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c.uri ORDER BY v.version_ord DESC, c.res_ord DESC) = 1),
pairs AS (SELECT l.layer_id, l.group_id, k.bundle_url FROM layers l LEFT JOIN known k ON k.source_key = trim(split_part(l.source,'|',1)))"""
BUNDLE_NEEDS = ("resources", "versions", "layers")


def layer_bundles(r):
    classified = resource_ops.classify_resources(r("resources"))
    registered_files = layer_ops.bundle_registrations(classified, resource_ops.pick_bundle(classified), r("versions"))
    return layer_ops.layer_bundle(r("layers"), registered_files).select("layer_id", "bundle_url")


def stored_bundles(r):
    """The bundles of layers as a table, so that the shuffles behind it are gone before fields and styles are moved."""
    return written(layer_bundles(r), "layer-bundles")


@registered("layer_bundle", f"WITH {BUNDLED} SELECT layer_id, bundle_url FROM pairs", BUNDLE_NEEDS)
def _(r):
    return layer_bundles(r)


REFS = rf"""
sld_refs AS (SELECT DISTINCT bundle_url, unnest(regexp_extract_all(sld, '<(?:ogc:)?PropertyName>([^<]+)</(?:ogc:)?PropertyName>', 1)) AS ref FROM style_docs WHERE sld IS NOT NULL),
sld_missing AS (SELECT p.layer_id, p.bundle_url, s.ref FROM pairs p JOIN sld_refs s USING (bundle_url) WHERE lower(s.ref) NOT IN {duck.PSEUDO}
    AND NOT EXISTS (SELECT 1 FROM layer_fields f WHERE f.layer_id = p.layer_id AND f.field_name = s.ref)),
qml_refs AS (SELECT DISTINCT bundle_url, unnest(regexp_extract_all(qml, '(?:attr|fieldName)="([^"]+)"', 1)) AS ref FROM style_docs WHERE qml IS NOT NULL),
reconciled AS (SELECT p.layer_id, p.bundle_url, q.ref, coalesce(
      (SELECT max(f.field_name) FROM layer_fields f WHERE f.layer_id = p.layer_id AND f.field_name = q.ref),
      (SELECT arg_max(f.field_name, f.field_ord) FROM layer_fields f WHERE f.layer_id = p.layer_id AND lower(f.field_name) = lower(q.ref)), q.ref) AS mapped
    FROM pairs p JOIN qml_refs q USING (bundle_url)),
checked AS (SELECT c.*, NOT EXISTS (SELECT 1 FROM layer_fields f WHERE f.layer_id = c.layer_id AND f.field_name = c.mapped) AND c.ref <> ''
    AND lower(c.ref) NOT IN {duck.PSEUDO} AS is_missing FROM reconciled c)"""
STYLE_NEEDS = (*BUNDLE_NEEDS, "style_docs", "field_dictionary", "layer_fields")


@registered(
    "style_missing_refs", f"WITH {BUNDLED}, {REFS} SELECT layer_id, bundle_url, ref FROM sld_missing", STYLE_NEEDS
)
def _(r):
    return ops.style_missing_refs(stored_bundles(r), ops.style_refs(r("style_docs")), r("layer_fields"))


@registered(
    "reconcile_field_case", f"WITH {BUNDLED}, {REFS} SELECT layer_id, bundle_url, ref, mapped, is_missing FROM checked", STYLE_NEEDS
)
def _(r):
    refs = stored_bundles(r).join(ops.attribute_refs(r("style_docs")), "bundle_url")
    return field_ops.reconcile_field_case(refs, r("layer_fields")).select(
        "layer_id", "bundle_url", "ref", "mapped", "is_missing"
    )


@registered(
    "remap_field_refs",
    f"""WITH {BUNDLED}, f AS (SELECT layer_id, max(CASE WHEN field_name = 'term_name' THEN 1 ELSE 0 END) AS has_term FROM layer_fields GROUP BY layer_id)
        SELECT p.layer_id, p.bundle_url, replace(replace(d.qml, 'attr="OBJECTID"', 'attr="objectId"'), 'fieldName="TERM_NAME"',
               CASE WHEN f.has_term = 1 THEN 'fieldName="term_name"' ELSE 'fieldName="TERM_NAME"' END) AS qml
        FROM pairs p JOIN style_docs d USING (bundle_url) JOIN f USING (layer_id) WHERE d.qml IS NOT NULL""",
    STYLE_NEEDS,
)
def _(r):
    return ops.remap_field_refs(layer_bundles(r), r("style_docs"), r("layer_fields"))


@registered(
    "apply_captions",
    f"""WITH {BUNDLED}, {DICTIONARY} SELECT p.layer_id, f.field_ord, f.field_name, coalesce(d.alias, f.field_name) AS caption
        FROM pairs p JOIN layer_fields f USING (layer_id) LEFT JOIN dictionary d ON d.bundle_url = p.bundle_url AND d.machine_name = f.field_name""",
    STYLE_NEEDS,
)
def _(r):
    named = stored_bundles(r).join(r("layer_fields"), "layer_id")
    captioned = field_ops.apply_captions(named, field_ops.clean_dictionary(r("field_dictionary")))
    return captioned.select("layer_id", "field_ord", "field_name", "caption")


def outcomes_twin(converter: bool) -> str:
    looked_at = "d.qml IS NOT NULL" if converter else "false"
    return f"""{BUNDLED}, {DICTIONARY}, {REFS},
sm AS (SELECT layer_id, count(*) AS n FROM sld_missing GROUP BY layer_id),
qm AS (SELECT layer_id, count(*) AS n FROM checked WHERE is_missing GROUP BY layer_id),
dc AS (SELECT bundle_url, count(*) AS n FROM dictionary GROUP BY bundle_url),
capt AS (SELECT p.layer_id, count(*) AS n FROM pairs p JOIN layer_fields f USING (layer_id)
    JOIN dictionary d ON d.bundle_url = p.bundle_url AND d.machine_name = f.field_name AND d.alias <> f.field_name GROUP BY p.layer_id),
judged AS (SELECT p.layer_id, p.bundle_url,
    CASE WHEN d.sld IS NOT NULL THEN coalesce(sm.n,0) WHEN {looked_at} THEN coalesce(qm.n,0) ELSE 0 END AS unmatched,
    CASE WHEN d.sld IS NOT NULL THEN CASE WHEN coalesce(sm.n,0) > 0 THEN 'skipped' ELSE 'styled' END
         WHEN d.qml IS NOT NULL THEN CASE WHEN NOT {str(converter).lower()} THEN 'needs_slyr' WHEN coalesce(qm.n,0) > 0 THEN 'skipped' ELSE 'styled_lyr' END
         WHEN coalesce(dc.n,0) > 0 THEN 'aliases' ELSE 'none' END AS outcome
    FROM pairs p LEFT JOIN style_docs d USING (bundle_url) LEFT JOIN dc USING (bundle_url) LEFT JOIN sm USING (layer_id) LEFT JOIN qm USING (layer_id))"""


@registered(
    "style_outcome",
    f"WITH {outcomes_twin(False)} SELECT layer_id, bundle_url, unmatched, outcome FROM judged WHERE bundle_url IS NOT NULL",
    STYLE_NEEDS,
)
def _(r):
    pairs = stored_bundles(r).filter("bundle_url IS NOT NULL")
    dictionary = field_ops.clean_dictionary(r("field_dictionary"))
    found = ops.style_outcome(pairs, r("style_docs"), dictionary, r("layer_fields"), converter_available=False)
    return found.drop("captioned")


@registered(
    "style_audit",
    f"WITH {outcomes_twin(True)} SELECT j.layer_id, j.bundle_url, j.outcome, j.unmatched, coalesce(c.n,0) AS captioned FROM judged j LEFT JOIN capt c USING (layer_id)",
    STYLE_NEEDS,
)
def _(r):
    return style_audit(
        r("layers"), r("resources"), r("versions"), r("style_docs"), r("field_dictionary"), r("layer_fields")
    )
