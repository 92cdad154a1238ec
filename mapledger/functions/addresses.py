"""Parts of layer sources and bucket addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import given, stripped


def resource_suffix(file_name: Column) -> Column:
    """The part of a stored file name that stays the same across versions."""
    return F.regexp_replace(F.coalesce(file_name, F.lit("")), fixed.HASH_PATTERN, "")


def bucket_dataset(source: Column) -> Column:
    """Dataset id in a bucket address anywhere in ``source``; null when there is none."""
    return given(F.regexp_extract(source, fixed.BUCKET_PATTERN, 1))


def bucket_file(source: Column) -> Column:
    """File name in a bucket address anywhere in ``source``; null when there is none."""
    return given(F.regexp_extract(source, fixed.BUCKET_PATTERN, 2))


def retarget_source(source: Column, old_file: Column, new_file: Column) -> Column:
    """``source`` with the file name swapped and the embedded filter cut off."""
    swapped = F.replace(F.coalesce(source, F.lit("")), old_file, new_file)
    return F.regexp_replace(swapped, r"(?s)[|]subset=.*\z", "")


def source_filter(source: Column) -> Column:
    """The filter embedded in a layer source; null when there is none."""
    return given(F.regexp_extract(source, r"(?s)[|]subset=(.*)\z", 1))


def norm_source(uri: Column) -> Column:
    """A layer source without provider suffixes."""
    return stripped(F.substring_index(F.coalesce(uri, F.lit("")), "|", 1))


def bundle_key(url: Column) -> Column:
    """Short stable key of a bundle address."""
    return F.substring(F.sha1(F.coalesce(url, F.lit(""))), 1, 16)
