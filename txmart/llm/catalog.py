"""The registered queries of the subpackage: importing the modules fills the registry."""

from __future__ import annotations

from txmart.llm import op01_url_filter, op02_jaccard_join, op03_quality_rules, op04_license_scan, op05_substring_dedup, op06_decontaminate, op07_secret_scan, op08_token_counts, op09_mix_sources, op10_quality_classifier, op11_token_alignment, op12_pii_spans, op13_spelling_variants  # noqa: F401  (registration side effects)
from txmart.llm.common import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
