"""Queries of this subpackage for the driver's contract, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, change_points, context_tree, decision_list, html_text, mixing, near_dups, pii, sharding, substrings, toxicity, warc, winnowing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": sharding.op1,
    "op2_warc": warc.op2,
    "op3_pii": pii.op3,
    "op4_toxicity": toxicity.op4,
    "op5_substring_dedup": substrings.op5,
    "op6_decontamination": winnowing.op6,
    "op7_near_dedup": near_dups.op7,
    "op8_lm_scoring": context_tree.op8,
    "op9_quality_rules": decision_list.op9,
    "op10_mixing": mixing.op10,
    "op11_centroids": centroids.op11,
    "op12_change_points": change_points.op12,
    "op13_html_text": html_text.op13,
}

ORACLE_SQL: dict[str, str] = {
    "op2_warc": warc.SQL,
    "op5_substring_dedup": substrings.SQL,
    "op6_decontamination": winnowing.SQL,
    "op7_near_dedup": near_dups.SQL,
    "op11_centroids": centroids.SQL,
    "op12_change_points": change_points.SQL,
    "op13_html_text": html_text.SQL,
}
