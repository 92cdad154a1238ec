"""Saved layers: where they sit, which file they use, and which file is newest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import addresses, fixed
from ..functions.text import given
from ..session import written
from .joins import digest, picked, split_join
from .versions import version_rank


def bucket_layers(layers: DataFrame) -> DataFrame:
    """The layers served from a bucket, with dataset and file name."""
    found = F.filter(F.array(F.regexp_extract("source", fixed.BUCKET_TAIL_PATTERN, 1)), lambda t: t != "")
    parts = F.transform(found, lambda t: F.struct(
        F.substring(t, 1, 36).alias("dataset_id"), F.substring_index(t, "/", -1).alias("old_file")
    ))
    # Exploding a list of at most one keeps the pattern from being matched again per filter.
    return layers.select("*", F.inline(parts))


def chosen_layers(layers: DataFrame, chosen: DataFrame | None) -> DataFrame:
    """Only the chosen layers; all of them when none is chosen."""
    return layers if chosen is None else layers.join(chosen.select("layer_id"), "layer_id", "left_semi")


def group_paths(groups: DataFrame) -> DataFrame:
    """Names of a group and its ancestors joined by `` / ``; the root is left out.

    ``groups`` has ``group_id, parent_id, group_name``; the root has no parent. Each round puts the path of the
    ancestor a group has reached before its own and goes on from where that one is, so the reach doubles: a
    chain of any depth takes its logarithm in rounds, each written once. Groups without a way to a root, also
    those in a circle, have no path.
    """
    root = F.col("parent_id").isNull()
    state = written(groups.select("group_id", F.col("parent_id").alias("up"), F.when(~root, F.col("group_name")).alias("group_path")), "group-paths")
    done, rest = state.filter("up IS NULL"), state.filter("up IS NOT NULL")
    for _ in range(state.count().bit_length() + 1):
        ahead = done.unionByName(rest).select(F.col("group_id").alias("up"), F.col("up").alias("next"), F.col("group_path").alias("above"))
        state = split_join(rest, ahead, ["up"]).select(
            "group_id", F.col("next").alias("up"), F.concat_ws(" / ", "above", "group_path").alias("group_path")
        )
        state = written(state, "group-paths")
        done, rest = done.unionByName(state.filter("up IS NULL")), state.filter("up IS NOT NULL")
        if rest.isEmpty():
            break
    return done.select("group_id", "group_path")


def layer_paths(layers: DataFrame, groups: DataFrame) -> DataFrame:
    """Add ``path``: the group path and the layer's own name."""
    return (
        layers.join(group_paths(groups), "group_id", "left")
        .withColumn("path", F.concat_ws(" / ", "group_path", "layer_name"))
        .drop("group_path")
    )


def versioned_files(files: DataFrame, versions: DataFrame) -> DataFrame:
    """Files by suffix with the number, date and rank of their version."""
    info = versions.select(
        "version_id", "version_number", F.substring("detected_at", 1, 10).alias("detected"), "total_rows",
        version_rank().alias("rank"),
    )
    return files.join(info, "version_id")


def file_versions(ranked_files: DataFrame) -> DataFrame:
    """For every file the newest version that contains it."""
    newest = ranked_files.groupBy("dataset_id", "file_name").agg(
        F.max_by(F.struct("version_number", "detected", "total_rows"), "rank").alias("v")
    )
    return newest.select(
        "dataset_id", F.col("file_name").alias("old_file"),
        F.col("v.version_number").alias("from_version"),
        F.col("v.detected").alias("from_detected"),
        F.col("v.total_rows").alias("rows_before"),
    )


def layer_current_version(layers: DataFrame, files: DataFrame, versions: DataFrame) -> DataFrame:
    """The newest version that contains the file a layer points at; null when none does."""
    # Files and layers are many, and their names long: they meet under a digest of dataset and file name.
    def key(name: str) -> Column:
        return digest(F.concat(F.length("dataset_id").cast("string"), F.lit(":"), "dataset_id", name)).alias("file_key")

    ranked = versioned_files(files.select("version_id", key("file_name")), versions)
    info = {"version_number": "from_version", "detected": "from_detected", "total_rows": "rows_before"}
    found = picked(ranked.select("file_key", *info, "rank"), ["file_key"], F.max_by, F.col("rank"))
    found = found.select("file_key", *[F.col(c).alias(name) for c, name in info.items()])
    saved = bucket_layers(layers)
    keys = ["dataset_id", "old_file"]
    return split_join(saved.select("*", key("old_file")), found, ["file_key"], "left").select(
        *keys, *[c for c in saved.columns if c not in keys], *info.values()
    )


def layer_latest_file(layers: DataFrame, files: DataFrame, latest: DataFrame) -> DataFrame:
    """The file of the newest version that has the same suffix as the layer's file."""
    newest = files.join(latest.select("version_id"), "version_id", "left_semi").select(
        "dataset_id", "suffix", F.col("file_name").alias("new_file"), F.col("download_url").alias("new_url")
    )
    wanted = bucket_layers(layers).withColumn("suffix", addresses.resource_suffix(F.col("old_file")))
    return split_join(wanted, newest, ["dataset_id", "suffix"], "left")


def layer_bundle(layers: DataFrame, registrations: DataFrame) -> DataFrame:
    """The style bundle registered for a layer's source; the last registration wins.

    ``registrations`` has ``uri, bundle_url, reg_ord``, and may bring the ``source_key`` of the address.
    """
    known = registrations.filter(given(F.col("uri")).isNotNull() & given(F.col("bundle_url")).isNotNull())
    if "source_key" not in known.columns:
        known = known.withColumn("source_key", source_key(F.col("uri")))
    known = known.groupBy("source_key").agg(F.max_by("bundle_url", "reg_ord").alias("bundle_url"))
    keyed = layers.withColumn("source_key", source_key(F.col("source")))
    return split_join(keyed, known, ["source_key"], "left").drop("source_key")


def source_key(source: Column) -> Column:
    """What two ways to name a source have in common, as a digest: addresses are long, and there is one in every row."""
    return digest(addresses.norm_source(source))


def bundle_registrations(classified: DataFrame, bundles: DataFrame, versions: DataFrame) -> DataFrame:
    """Every loadable file of a version with the bundle of that version, in listing order.

    Files with a map-layer kind are registered; later versions come after earlier ones.
    """
    # What is known of a version is put together first, so the files, which are many, meet it in one join.
    styled = bundles.select("version_id", F.col("download_url").alias("bundle_url")).join(
        versions.select("version_id", "version_ord"), "version_id"
    )
    loadable = classified.filter(F.col("layer_kind").isNotNull()).select(
        "version_id", "res_ord", "uri", source_key(F.col("uri")).alias("source_key")
    )
    return split_join(loadable, styled, ["version_id"]).select(
        "uri", "source_key", "bundle_url", F.struct("version_ord", "res_ord").alias("reg_ord")
    )
