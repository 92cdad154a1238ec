"""Whether a style bundle fits a layer.

Documents have ``bundle_url, sld, qml``; pairs have ``layer_id, bundle_url``. References
are extracted once per document and meet the layers afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import documents, fixed
from .fields import field_lists, spelling_of
from .joins import split_join


def style_refs(docs: DataFrame) -> DataFrame:
    """Distinct published-field references per bundle: ``bundle_url, ref``."""
    return docs.filter(F.col("sld").isNotNull()).select(
        "bundle_url", F.explode(documents.property_refs(F.col("sld"))).alias("ref")
    )


def style_missing_refs(pairs: DataFrame, refs: DataFrame, layer_fields: DataFrame) -> DataFrame:
    """References of a layer's style that the layer does not publish; case matters."""
    published = layer_fields.select("layer_id", F.col("field_name").alias("ref"))
    wanted = split_join(pairs.select("layer_id", "bundle_url"), refs, ["bundle_url"])
    return wanted.join(published, ["layer_id", "ref"], "left_anti")


def attribute_refs(docs: DataFrame) -> DataFrame:
    """Distinct field attributes per converted style: ``bundle_url, ref``."""
    return docs.filter(F.col("qml").isNotNull()).select(
        "bundle_url", F.explode(documents.attribute_refs(F.col("qml"))).alias("ref")
    )


def _in_fields(pairs: DataFrame, refs: DataFrame, layer_fields: DataFrame) -> DataFrame:
    """Pairs with the columns of their bundle in ``refs`` and the field list of their layer."""
    return split_join(split_join(pairs, refs, ["bundle_url"], "left"), field_lists(layer_fields), ["layer_id"], "left")


def remap_field_refs(pairs: DataFrame, docs: DataFrame, layer_fields: DataFrame) -> DataFrame:
    """Converted styles of layers with their field attributes in the layer's spelling.

    The spelling map of a layer has an entry per reference that changes, so it is as long as
    its document has references. Documents meet the layers last.
    """
    styled = docs.filter(F.col("qml").isNotNull())
    refs = styled.select("bundle_url", documents.attribute_refs(F.col("qml")).alias("refs"))
    fields = F.coalesce("fields", F.array().cast("array<string>"))
    meant = F.transform("refs", lambda r: F.struct(r.alias("ref"), spelling_of(r, fields).alias("mapped")))
    changed = F.filter(meant, lambda m: m["mapped"] != m["ref"])
    spelled = _in_fields(pairs.select("layer_id", "bundle_url"), refs, layer_fields).filter("refs IS NOT NULL").select(
        "layer_id", "bundle_url", F.map_from_entries(changed).alias("spelling")
    )
    joined = split_join(spelled, styled.select("bundle_url", "qml"), ["bundle_url"])
    return joined.select("layer_id", "bundle_url", documents.rewrite_attributes(F.col("qml"), F.col("spelling")).alias("qml"))


def style_outcome(
    pairs: DataFrame,
    docs: DataFrame,
    dictionary: DataFrame,
    layer_fields: DataFrame,
    converter_available: bool = True,
) -> DataFrame:
    """What applying its bundle does to every layer: outcome, unmatched references, captioned fields.

    ``dictionary`` is cleaned. Without the converter a style that needs it is not looked at. References
    and captions are lists of a bundle and fields are a list of a layer, so a layer meets either once.
    """
    nothing = F.array().cast("array<string>")
    contents = docs.select(
        "bundle_url", F.col("sld").isNotNull().alias("has_sld"), F.col("qml").isNotNull().alias("has_qml"),
        F.coalesce(documents.property_refs(F.col("sld")), nothing).alias("sld_refs"),
        F.coalesce(documents.attribute_refs(F.col("qml")), nothing).alias("qml_refs"),
    )
    captions = dictionary.groupBy("bundle_url").agg(
        F.map_from_entries(F.collect_list(F.struct("machine_name", "alias"))).alias("captions")
    )
    rows = _in_fields(pairs, contents.join(captions, "bundle_url", "full"), layer_fields)
    fields = F.coalesce("fields", nothing)
    lost = F.filter(
        "qml_refs",
        lambda r: spelling_of(r, fields).isNull() & (r != "") & ~F.lower(r).isin(*fixed.PSEUDO_FIELDS),
    )
    named = F.filter(fields, lambda f: F.try_element_at("captions", f) != f)
    has_sld, has_qml = F.coalesce("has_sld", F.lit(False)), F.coalesce("has_qml", F.lit(False))
    unmatched = (
        F.when(has_sld, F.size(F.array_except("sld_refs", fields)))
        .when(has_qml & F.lit(converter_available), F.size(lost))
        .otherwise(0).cast("bigint")
    )
    skipped = unmatched > 0
    outcome = (
        F.when(has_sld, F.when(skipped, fixed.SKIPPED).otherwise(fixed.STYLED))
        .when(
            has_qml,
            F.when(~F.lit(converter_available), fixed.NEEDS_SLYR)
            .when(skipped, fixed.SKIPPED)
            .otherwise(fixed.STYLED_LYR),
        )
        .when(F.col("captions").isNotNull(), fixed.ALIASES)
        .otherwise(fixed.NO_BUNDLE)
    )
    captioned = F.coalesce(F.size(named), F.lit(0)).cast("bigint")
    return rows.select(*pairs.columns, unmatched.alias("unmatched"), outcome.alias("outcome"), captioned.alias("captioned"))
