"""The physical plan of a DataFrame as text."""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
