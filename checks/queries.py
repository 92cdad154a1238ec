"""All registered queries."""

from . import (  # noqa: F401
    catalog_queries,
    feature_queries,
    file_queries,
    layer_queries,
    source_queries,
    style_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
