"""All queries of this subpackage."""

from __future__ import annotations

from . import best_fit, capture_merge, decontaminate, language_id, quotation_links, simhash_forest, substring_dedup, topk_nra, toxicity, url_rules

MODULES = [best_fit, capture_merge, decontaminate, language_id, quotation_links, simhash_forest, substring_dedup, topk_nra, toxicity, url_rules]
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL = {k: v for m in MODULES for k, v in m.ORACLE_SQL.items()}
