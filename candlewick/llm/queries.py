"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    boosting, decontaminate, divergence, filteraudit, licenses, neardup, packing, perplexity, pii, repeats, tokens, toxicity, urls,
)
from .oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        repeats.op1_repeats, pii.op2_pii, toxicity.op3_toxicity, neardup.op4_near_duplicates, perplexity.op5_quality_rules,
        boosting.op6_quality_classifier, decontaminate.op7_decontamination, licenses.op8_license_scan, packing.op9_packing,
        tokens.op10_token_counts, urls.op11_url_filter, filteraudit.op12_filter_audit, divergence.op13_source_divergence,
    )
}

__all__ = ["ORACLES", "QUERIES"]
