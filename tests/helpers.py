"""Comparison of query results, independent of row and column order."""

from __future__ import annotations


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows]
    names = [columns[i] for i in order]
    return names, sorted(shown, key=lambda r: [(v is None, v or "") for v in r])


def frame(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def explain(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
