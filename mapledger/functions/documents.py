"""Field references and links inside style documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def property_refs(doc: Column) -> Column:
    """Distinct published-field references of an SLD document."""
    refs = F.regexp_extract_all(doc, F.lit(fixed.PROPERTY_PATTERN), 1)
    return F.array_distinct(F.filter(refs, lambda r: ~F.lower(r).isin(*fixed.PSEUDO_FIELDS)))


def attribute_refs(doc: Column, pattern: str = fixed.STYLE_ATTRIBUTE_PATTERN) -> Column:
    """Distinct values of a document's field attributes, pseudo-fields included."""
    return F.array_distinct(F.regexp_extract_all(doc, F.lit(pattern), 1))


def absolutize_hrefs(doc: Column, base: Column, attribute: str = "xlink:href") -> Column:
    """Put ``base`` before every relative link of ``doc``."""
    relative = f'{attribute}="(?!{fixed.ABSOLUTE_ADDRESS_PATTERN})([^"]+)"'
    # The base may hold '$' or '\', which a replacement text would interpret.
    quoted = F.regexp_replace(F.regexp_replace(base, r"/+\z", ""), r"([\\$])", r"\\$1")
    return F.regexp_replace(doc, F.lit(relative), F.concat(F.lit(f'{attribute}="'), quoted, F.lit('/$1"')))


def rewrite_attributes(doc: Column, spelling: Column) -> Column:
    """Rewrite field attributes of ``doc`` through the map ``spelling`` (reference -> field).

    References without an entry stay. The text between two references is kept as it is.
    """
    pattern = r'((?:attr|fieldName)=")([^"]+)"'
    heads = F.regexp_extract_all(doc, F.lit(pattern), 1)
    refs = F.regexp_extract_all(doc, F.lit(pattern), 2)
    between = F.split(doc, pattern, -1)
    rewritten = F.zip_with(
        heads, refs, lambda head, ref: F.concat(head, F.coalesce(F.try_element_at(spelling, ref), ref), F.lit('"'))
    )
    pieces = F.zip_with(between, rewritten, lambda text, ref: F.concat(text, F.coalesce(ref, F.lit(""))))
    return F.array_join(pieces, "")
