"""What several test modules use."""

from __future__ import annotations


def final_plan(df) -> str:
    """The physical plan after the query has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)
