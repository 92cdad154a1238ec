"""Comparing field names: between versions, and between styles and layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .joins import digest, split_join


def schema_drift(layer_targets: DataFrame, layer_fields: DataFrame, file_fields: DataFrame) -> DataFrame:
    """Field names of a layer that its new file lacks, in the layer's order.

    ``layer_targets`` has ``layer_id, new_url``. A file whose fields are unknown has no drift.
    The fields of a layer and of a file become one list each, as long as its schema; the
    wide address is attached to a layer's list afterwards.
    """
    published = file_fields.groupBy(F.col("download_url").alias("new_url")).agg(
        F.collect_set("field_name").alias("published")
    )
    listed = layer_targets.select("layer_id", "new_url").join(field_lists(layer_fields), "layer_id")
    compared = split_join(listed, published, ["new_url"]).select(
        "layer_id", F.filter("fields", lambda n: ~F.array_contains("published", n)).alias("missing_fields")
    )
    return compared.filter(F.size("missing_fields") > 0)


def field_lists(layer_fields: DataFrame) -> DataFrame:
    """(layer_id, fields): the names of a layer's fields in its order, as long as its schema."""
    ordered = F.sort_array(F.collect_list(F.struct("field_ord", "field_name")))
    return layer_fields.groupBy("layer_id").agg(F.transform(ordered, lambda f: f.field_name).alias("fields"))


def spelling_of(ref: Column, fields: Column) -> Column:
    """The field that a reference means: itself if there is one, else the last that is equal but for case."""
    alike = F.filter(fields, lambda f: F.lower(f) == F.lower(ref))
    return F.when(F.array_contains(fields, ref), ref).otherwise(F.try_element_at(alike, F.lit(-1)))


def names_difference(left: DataFrame, right: DataFrame, on: list[str], hot: int = 100_000) -> DataFrame:
    """Rows of ``left`` whose names are not in ``right``; repeats stay.

    Names that fill more than ``hot`` rows are looked up once each, and their rows stay where they are; the list of
    these names is shorter than ``left`` by that factor. Only rows of rarer names meet ``right``.
    """
    names = right.select(*on).distinct()
    often = left.groupBy(*on).agg(F.count("*").alias("n")).filter(F.col("n") > hot).select(*on)
    known = split_join(often, names.withColumn("known", F.lit(True)), on, "left")
    known = known.select(*[F.col(c).alias(f"often_{c}") for c in on], F.coalesce("known", F.lit(False)).alias("known"))
    # Null names are never found; they are compared as equal here, so that many of them are looked up once too.
    same = [F.col(c).eqNullSafe(F.col(f"often_{c}")) for c in on]
    marked = left.join(F.broadcast(known), same, "left").select(*left.columns, "known")
    rare = split_join(marked.filter("known IS NULL").drop("known"), names, on, "left_anti").select(*left.columns)
    return marked.filter(~F.col("known")).drop("known").unionByName(rare)


def clean_dictionary(lines: DataFrame) -> DataFrame:
    """One alias per bundle and machine name: both sides trimmed and filled, the last line wins."""
    from ..functions.text import stripped

    trimmed = lines.withColumns({
        "machine_name": stripped(F.col("machine_name")), "alias": stripped(F.col("alias")),
    }).filter("machine_name <> '' AND alias <> ''")
    return trimmed.groupBy("bundle_url", "machine_name").agg(F.max_by("alias", "line_no").alias("alias"))


def apply_captions(fields: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Fields with their caption; a field without one shows its name.

    ``fields`` has ``bundle_url, field_name``.
    """
    # Fields are many and addresses long: both meet under a digest of the address, so the fields of a layer, which stand
    # together, are moved together. The captions of a bundle are a list, as long as its dictionary.
    key = digest(F.col("bundle_url"))
    # Fields without a bundle are many too; eight bytes, which no digest equals, keep layers apart. They are of the texts
    # beside the field's own name, so that the fields of a layer stay together here too.
    texts = [c for c, kind in fields.dtypes if kind == "string" and c not in ("bundle_url", "field_name")]
    own = texts or [c for c, kind in fields.dtypes if "map<" not in kind and "variant" not in kind]
    keyed = fields.select("*", F.coalesce(key, F.unhex(F.hex(F.xxhash64(*own)))).alias("bundle_key"))
    captions = dictionary.filter("bundle_url IS NOT NULL").groupBy(key.alias("bundle_key")).agg(
        F.collect_list(F.struct("machine_name", "alias")).alias("captions")
    )
    met = split_join(keyed, captions, ["bundle_key"], "left")
    # A name that a dictionary has several times makes as many rows.
    named = F.explode_outer(F.filter("captions", lambda c: c["machine_name"] == F.col("field_name"))).alias("named")
    keys = ["bundle_url", "field_name"]
    rest = [c for c in fields.columns if c not in keys]
    return met.select(*keys, *rest, named).select(*keys, *rest, F.coalesce("named.alias", "field_name").alias("caption"))


def reconcile_field_case(refs: DataFrame, layer_fields: DataFrame) -> DataFrame:
    """Map references of a layer onto the spelling of its fields.

    ``refs`` has distinct rows with ``layer_id, ref``. An exact name stays, else a name equal but for case is
    taken (the last field among several), else the reference stays and is missing unless
    it is empty or a pseudo-field.
    """
    keyed = refs.withColumn("ref_key", F.lower("ref"))
    spelled = layer_fields.select("layer_id", F.lower("field_name").alias("ref_key"), "field_name", "field_ord")
    # Only fields that equal a reference but for case get past the join.
    found = keyed.join(spelled, ["layer_id", "ref_key"], "left").groupBy(*refs.columns).agg(
        F.bool_or(F.col("field_name") == F.col("ref")).alias("exact"),
        F.max_by("field_name", "field_ord").alias("spelling"),
    )
    known = F.col("spelling").isNotNull()
    return found.select(
        *refs.columns,
        F.when(known & ~F.col("exact"), F.col("spelling")).otherwise(F.col("ref")).alias("mapped"),
        (~known & (F.col("ref") != "") & ~F.lower("ref").isin(*fixed.PSEUDO_FIELDS)).alias("is_missing"),
    )
