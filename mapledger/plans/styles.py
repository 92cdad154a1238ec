"""Which layers a style bundle fits, over all layers and bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import fields, layers as layer_ops, resources as resource_ops, styles as style_ops
from ..session import written


def style_audit(
    layers: DataFrame,
    resources: DataFrame,
    versions: DataFrame,
    docs: DataFrame,
    dictionary_lines: DataFrame,
    layer_fields: DataFrame,
    converter_available: bool = True,
) -> DataFrame:
    """Bundle, outcome, unmatched references and captioned fields of every layer."""
    classified = resource_ops.classify_resources(resources)
    registered = layer_ops.bundle_registrations(classified, resource_ops.pick_bundle(classified), versions)
    # The shuffles behind the pairs are gone before fields and styles are moved.
    pairs = written(layer_ops.layer_bundle(layers, registered).select("layer_id", "bundle_url"), "layer-bundles")
    dictionary = fields.clean_dictionary(dictionary_lines)
    return style_ops.style_outcome(pairs, docs, dictionary, layer_fields, converter_available).select(
        "layer_id", "bundle_url", "outcome", "unmatched", "captioned"
    )
