"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

#: Query name to module.  Each module has ``query`` and, where SQL can express it, ``SQL``.
MODULES = {
    "op4_html_extraction": "html_extraction",
    "op7_secret_scan": "secret_scan",
    "op3_token_counts": "token_counts",
    "op8_url_filter": "url_filter",
    "op10_sharding": "sharding",
    "op1_sentencepiece": "sentencepiece_scan",
    "op6_warc": "warc",
    "op2_near_dedup": "near_dedup",
    "op5_decontamination": "decontamination",
    "op9_quality_rules": "quality_rules",
    "op11_periodic_runs": "periodic_runs",
    "op12_quality_classifier": "quality_classifier",
    "op13_conversation_trie": "conversation_trie",
}


#: More of what these operators do: query name to module, function and name of its SQL.
MORE = {
    "quality_ablation": ("quality_rules", "ablation_query", "ABLATION_SQL"),
    "small_shards": ("sharding", "small_shards", "SMALL_SQL"),
}


def _module(name: str):
    return importlib.import_module(f"tidemark.llm.{name}")


def queries() -> dict:
    return {name: _module(m).query for name, m in MODULES.items()} | {name: getattr(_module(m), f) for name, (m, f, _) in MORE.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(_module(m), "SQL", None) for name, m in MODULES.items()} | {name: getattr(_module(m), q) for name, (m, _, q) in MORE.items()}
    return {k: v for k, v in found.items() if v}
