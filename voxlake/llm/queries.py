"""Queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

#: query name -> module that holds a function of that name and, where SQL can express it, SQL.
MODULES = {
    "op1_sentencepiece": "pieces",
    "op2_line_dedup": "line_dedup",
    "op3_toxicity": "toxicity",
    "op4_packing": "packing",
    "op5_suffix_dedup": "suffix_dedup",
    "op6_quality_rules": "quality_rules",
    "op7_html_text": "html_text",
    "op8_fingerprints": "fingerprints",
    "op9_quality_classifier": "quality_classifier",
    "op10_minhash": "minhash",
    "op11_periodic_runs": "periodic_runs",
    "op12_importance_resampling": "resampling",
    "op13_slack_packing": "slack_packing",
}


def queries() -> dict:
    return {name: getattr(import_module(f"voxlake.llm.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"voxlake.llm.{module}"), "SQL", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
