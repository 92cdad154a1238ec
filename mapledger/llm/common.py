"""What several operators of this folder share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: Column | str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def utf8(column: Column | str = "text") -> Column:
    """The UTF-8 bytes of a text column, none for null; tasks read bytes without decoding them first."""
    return text_or_empty(column).cast("binary")


def importable(spark: SparkSession) -> SparkSession:
    """``spark``, with this package on the import path of Python workers that share the driver's disk.

    On a cluster the package is installed where executors run, or added with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def free_names(names: list[str], taken: list[str]) -> list[str]:
    """``names`` for new columns, with ``_2`` and so on where a column has the name but for case."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        free, n = name, 1
        while free.lower() in used:
            n += 1
            free = f"{name}_{n}"
        used.add(free.lower())
        out.append(free)
    return out
