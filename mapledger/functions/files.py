"""What a published file is, judged from its declared format and its address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import stripped


# The last run of letters and digits after a dot or underscore of the last path segment. A
# query, a fragment, trailing slashes and one ".gz" are looked through.
_EXT_IN_URL = (
    r"(?s)\A[^?#]*(?:\.(?!gz/*(?:[?#]|\z))|_)([\p{L}\p{N}]{2,8})(?:\.gz)?/*(?:[?#].*)?\z"
)


def _looked_up(table: dict[str, str], key: Column) -> Column:
    """The entry of a small constant table; null when there is none. Names ``key`` once."""
    pairs = ", ".join(f"'{name}', '{entry}'" for name, entry in table.items())
    return F.try_element_at(F.expr(f"map({pairs})"), key)


def ext_from_url(url: Column) -> Column:
    """Extension in the last path segment of ``url``; ``''`` when there is none."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), _EXT_IN_URL, 1)


def canonical_ext(ext: Column) -> Column:
    """The one token used for all spellings of a format."""
    return F.coalesce(_looked_up(fixed.EXTENSION_ALIASES, ext), ext)


def resource_ext(fmt: Column, url: Column) -> Column:
    """Canonical extension: the declared format, else the one in the address."""
    declared = F.ltrim(stripped(F.lower(F.coalesce(fmt, F.lit("")))), F.lit("."))
    # The pattern runs only where no format is declared.
    return F.when(declared != "", canonical_ext(declared)).otherwise(canonical_ext(ext_from_url(url)))


def _classes() -> dict[str, tuple[str, str | None, bool]]:
    """Category, layer kind and container flag of every known extension."""
    return (
        dict.fromkeys(fixed.CONTAINER_EXTENSIONS, ("spatial", "vector", True))
        | dict.fromkeys(fixed.RASTER_EXTENSIONS, ("spatial", "raster", False))
        | dict.fromkeys(fixed.VECTOR_EXTENSIONS, ("spatial", "vector", False))
        | dict.fromkeys(fixed.STYLE_EXTENSIONS, ("spatial", None, False))
        | dict.fromkeys(fixed.TABLE_EXTENSIONS, ("data", "table", False))
    )


def file_class(ext: Column, styled: Column | None = None) -> Column:
    """``category, layer_kind, container`` of an extension as one struct.

    A ZIP that ``styled`` marks holds a style and is neither a layer nor a container. The
    extension is named once, so a filter on the class stays one lookup.
    """
    key, table = ext, _classes()
    if styled is not None:
        key = F.concat(F.when(styled, "styled ").otherwise(""), ext)
        table |= {f"styled {e}": c for e, c in table.items()} | {"styled zip": ("spatial", None, False)}
    rows = ", ".join(
        f"'{e}', named_struct('category', '{c}', 'layer_kind', {f"'{k}'" if k else 'CAST(NULL AS STRING)'},"
        f" 'container', {str(n).lower()})"
        for e, (c, k, n) in table.items()
    )
    unknown = F.expr("named_struct('category', 'other', 'layer_kind', CAST(NULL AS STRING), 'container', false)")
    return F.coalesce(F.try_element_at(F.expr(f"map({rows})"), key), unknown)


def is_symbology(name: Column, url: Column) -> Column:
    """True when the name or the address marks a style bundle."""
    return F.lower(F.concat_ws(" ", name, url)).contains("symbology")


def coarse_kind(kind: Column) -> Column:
    """``vector``, ``table`` or ``other`` from the layer kind."""
    return F.when(kind.isin("vector", "raster"), "vector").when(kind == "table", "table").otherwise("other")


def is_gzip(url: Column) -> Column:
    """True when the address says that the file is gzip-compressed."""
    return F.lower(url).endswith(".gz") | F.lower(url).contains(".geojson.gz")


def _remote(url: Column) -> Column:
    return F.concat(F.lit("/vsicurl/"), url)


def open_uri(url: Column, ext: Column) -> Column:
    """The best single way to open the file."""
    remote = _remote(url)
    return (
        F.when((ext == "geojson") & is_gzip(url), F.concat(F.lit("/vsigzip/"), remote))
        .when(ext == "csv", F.concat(F.lit("CSV:"), remote))
        .when(ext == "zip", F.concat(F.lit("/vsizip/"), remote))
        .otherwise(remote)
    )


def open_attempts(url: Column, ext: Column) -> Column:
    """Every way to open the file, best first, each once."""
    plain = _remote(url)
    packed = F.concat(F.lit("/vsigzip/"), plain)
    return F.array_distinct(
        F.when(ext == "geojson", F.when(is_gzip(url), F.array(packed, plain)).otherwise(F.array(plain, packed)))
        .when(ext == "gpkg", F.array(plain, F.concat(F.lit("GPKG:"), plain)))
        .when(ext == "csv", F.array(F.concat(F.lit("CSV:"), plain), plain))
        .when(ext.isin("kml", "kmz"), F.array(plain, F.concat(F.lit("KML:"), plain)))
        .otherwise(F.array(plain))
    )
