"""Helpers for looking at physical plans in tests."""


def plan_of(df):
    """Physical plan text of a DataFrame."""
    return df._jdf.queryExecution().executedPlan().toString()
