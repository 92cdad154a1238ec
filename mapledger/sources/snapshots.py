"""File snapshots, field dictionaries and style archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table_files(spark: SparkSession, path: str, sep: str, multi_line: bool = False) -> DataFrame:
    """Delimited files by the names in their headers.

    Files with one and the same header are read together; what a file lacks is null. Without
    ``multi_line`` a large file is split among tasks; with it, quoted line breaks are understood.
    """
    heads = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("place"),
    )
    # One row for each file.
    firsts = heads.filter("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    files = firsts.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    if len(files) <= 1:
        return spark.read.csv(path, header=True, sep=sep, multiLine=multi_line, escape='"')
    tables = [spark.read.csv(list(f.files), header=True, sep=sep, multiLine=multi_line, escape='"') for f in files]
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table, allowMissingColumns=True)
    return whole


def file_field_names(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The field lists of delimited files: ``file, file_name, field_ord, field_name`` from their headers, in one job."""
    heads = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), "value", F.monotonically_increasing_id().alias("place"),
    )
    firsts = heads.filter("start = 0").groupBy("file", "file_name").agg(F.min_by("value", "place").alias("header"))
    names = _cells(F.regexp_replace("header", "\\A\ufeff", ""), sep)
    rows = firsts.select("file", "file_name", F.posexplode(names).alias("field_ord", "field_name"))
    return rows.withColumn("field_ord", F.col("field_ord").cast("bigint"))


def read_resource(spark: SparkSession, path: str, ext: str, multi_line: bool = False) -> DataFrame:
    """Open files of one canonical extension: tables by header, GeoJSON as features."""
    if ext in ("csv", "tsv"):
        return read_table_files(spark, path, "," if ext == "csv" else "\t", multi_line)
    if ext == "txt":
        return spark.read.text(path)
    if ext == "parquet":
        return spark.read.parquet(path)
    if ext == "geojson":
        from .collections import collection_features

        return collection_features(spark, path)
    raise ValueError(f"no reader for extension {ext!r}")


def _cell(sep: str) -> str:
    """A cell, quoted or not, of a text delimited by ``sep``. All of it is possessive, so a text is walked through
    once, without a stack frame for each quote or line."""
    return rf'(?:[ \t]*+"[^"]*+(?:""[^"]*+)*+"?+)?+[^{sep}\n]*+'


def _records(text: Column, sep: str = ",") -> Column:
    """The lines of a delimited text that are not empty; a quoted cell may hold line breaks."""
    cell = _cell(sep)
    lines = F.regexp_extract_all(text, F.lit(rf"((?:{cell}{sep})*+{cell})(?:\n|\z)"), 1)
    return F.filter(F.transform(lines, lambda line: F.regexp_replace(line, r"\r\z", "")), lambda line: line != "")


def _cells(line: Column, sep: str = ",") -> Column:
    """The cells of a delimited line, without their quotes."""
    cells = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(rf"{sep}({_cell(sep)})"), 1)

    def bare(cell: Column) -> Column:
        return F.replace(F.regexp_replace(cell, r'\A[ \t]*+"|"[ \t]*+\z', ""), F.lit('""'), F.lit('"'))

    return F.transform(cells, lambda c: F.when(c.rlike(r'\A[ \t]*+"'), bare(c)).otherwise(c))


def field_dictionary_lines(files: DataFrame) -> DataFrame:
    """Lines of field dictionaries with ``bundle_url, content`` (the file's bytes).

    A dictionary has a line per field of one layer, so a file is taken apart at a time: quoted line
    breaks, a byte order mark and any order of columns are allowed.
    """
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\\A\ufeff", "")
    parsed = files.select("bundle_url", F.transform(_records(text), lambda line: _cells(line)).alias("rows"))
    rows = parsed.select("bundle_url", F.try_element_at("rows", F.lit(1)).alias("head"), F.posexplode("rows").alias("line_no", "cells"))

    def cell(name: str) -> Column:
        place = F.array_position("head", name)
        return F.when(place > 0, F.try_element_at("cells", F.greatest(place, F.lit(1)).cast("int")))

    return rows.filter("line_no > 0").select(
        "bundle_url", F.col("line_no").cast("bigint").alias("line_no"),
        cell("machine_name").alias("machine_name"), cell("hebrew_alias").alias("alias"),
    )


def read_field_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned captions of every dictionary file below ``path``, under the file's name."""
    from ..operators.fields import clean_dictionary

    files = spark.read.format("binaryFile").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("bundle_url"), "content")
    return clean_dictionary(field_dictionary_lines(named))


def bundle_manifest(members: DataFrame) -> DataFrame:
    """The style, dictionary and ESRI style of every archive that has one of them.

    The ESRI style counts only where there is no SLD.
    """
    name = F.lower("member")

    def first(match) -> Column:
        return F.min_by("member", F.when(match, F.col("pos")))

    found = members.groupBy("bundle_url").agg(
        first(name.endswith(".sld")).alias("sld"),
        first(F.col("member").endswith("_fields.csv")).alias("fields_csv"),
        first(name.endswith(".lyr") | name.endswith(".lyrx")).alias("lyr"),
    )
    return found.withColumn("lyr", F.when(F.col("sld").isNull(), F.col("lyr"))).filter(
        "coalesce(sld, fields_csv, lyr) IS NOT NULL"
    )
