"""All queries and oracles of this subpackage."""

from __future__ import annotations

from millrace.llm import bpe, decontaminate, line_dedup, pii, quality_classifier, quality_rules, sharding, simhash, token_counts, toxicity

_MODULES = [line_dedup, toxicity, token_counts, quality_classifier, simhash, pii, decontaminate, sharding, quality_rules, bpe]

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLE = {name: q for m in _MODULES for name, q in m.ORACLE.items()}
