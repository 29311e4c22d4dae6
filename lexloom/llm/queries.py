"""Query catalogue of the sub-package: names to callables, and SQL where it can express them."""

from __future__ import annotations

from lexloom.llm import formatting_copies, groups, leakage, lookalikes, markup, quality, tokenize


def queries():
    return {
        "p1_found": markup.p1_found,
        "p1_clean": markup.p1_clean,
        "p2_found": lookalikes.p2_found,
        "p2_forms": lookalikes.p2_forms,
        "p2_classes": lookalikes.p2_classes,
        "p3_found": formatting_copies.p3_found,
        "p3_collapsed": formatting_copies.p3_collapsed,
        "p4_found": groups.p4_found,
        "p6_ids": tokenize.p6_ids,
        "p6_roundtrip": tokenize.p6_roundtrip,
        "p7_found": leakage.p7_found,
        "p7_near": leakage.p7_near,
        "p8_found": quality.p8_found,
        "p8_stats": quality.p8_stats,
    }


def oracle_sql():
    return {**formatting_copies.SQL}
