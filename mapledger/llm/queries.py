"""Queries of this folder's operators over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate, html_extract, licences, packing, prefix_trie, retrieval_packing, secret_scan, simhash, token_alignment,
    token_counts, topk, toxicity, warc,
)
from .common import importable, table
from .oracles import ORACLES  # noqa: F401


def _over(report: Callable[..., DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query that applies a report to whole tables."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(*(table(importable(spark), sf_dir, name) for name in names))

    return query


QUERIES = {
    "op1_secret_scan": _over(secret_scan.secret_report, "documents"),
    "op2_toxicity": _over(toxicity.toxicity_report, "documents", "labels"),
    "op3_warc": _over(warc.capture_report, "pages"),
    "op4_simhash": _over(simhash.simhash_report, "documents"),
    "op5_licences": _over(licences.licence_report, "documents"),
    "op6_decontamination": _over(decontaminate.contamination_report, "documents", "benchmark"),
    "op7_token_counts": _over(token_counts.token_report, "documents"),
    "op8_html_text": _over(html_extract.text_report, "pages"),
    "op9_topk": _over(topk.topk_report, "embeddings"),
    "op10_packing": _over(packing.packing_report, "documents"),
    "op11_alignment": _over(token_alignment.alignment_report, "documents"),
    "op12_prefix_trie": _over(prefix_trie.trie_report, "conversations"),
    "op13_related_packing": _over(retrieval_packing.related_report, "documents"),
}


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline at the top of the repository."""
    import corpus_pipeline

    return corpus_pipeline.run(importable(spark), sf_dir)


if importlib.util.find_spec("corpus_pipeline"):
    QUERIES["pipeline"] = _pipeline
