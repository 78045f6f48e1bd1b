"""Operator counts of a DataFrame's physical plan, from ``explain("formatted")``.

Used by tests and the benchmark to record how many exchanges, sorts and joins
a query plans (before adaptive re-planning, which can only remove work).
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

OPERATORS = {
    "exchanges": r"^\(\d+\) Exchange\b",
    "broadcasts": r"^\(\d+\) BroadcastExchange\b",
    "sorts": r"^\(\d+\) Sort\b",
    "sort_aggregates": r"^\(\d+\) SortAggregate\b",
    "hash_aggregates": r"^\(\d+\) (Object)?HashAggregate\b",
    "windows": r"^\(\d+\) Window\b",
    "sort_merge_joins": r"^\(\d+\) SortMergeJoin\b",
    "hash_joins": r"^\(\d+\) (ShuffledHashJoin|BroadcastHashJoin)\b",
    "scans": r"^\(\d+\) Scan\b",
    "python_udfs": r"^\(\d+\) (ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas)\b",
}


def plan_text(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def plan_shape(df: DataFrame) -> dict[str, int]:
    text = plan_text(df)
    # the formatted plan lists every operator once as "(n) Name ..." in its details
    return {k: len(re.findall(p, text, flags=re.MULTILINE)) for k, p in OPERATORS.items()}
