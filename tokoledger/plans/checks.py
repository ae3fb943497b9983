"""Physical-plan checks used by the tests and the bench notes.

A plan that would not survive a large cluster shows up here as text: a
cartesian product or broadcast nested-loop join (a range join that lost its
equi key), or a Python UDF in the hot path.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def scale_problems(df: DataFrame) -> list[str]:
    text = plan_text(df, "extended")
    return [op for op in FORBIDDEN if op in text]


def scans(df: DataFrame) -> list[dict[str, str]]:
    """Parquet scans of the formatted plan: location, pushed filters, read schema."""
    text = plan_text(df, "formatted")
    out = []
    for block in re.split(r"\n\(\d+\) ", text):
        if not block.startswith("Scan parquet"):
            continue
        info = {}
        for key in ("Location", "PushedFilters", "ReadSchema"):
            m = re.search(rf"{key}: (.*)", block)
            info[key] = m.group(1).strip() if m else ""
        out.append(info)
    return out
