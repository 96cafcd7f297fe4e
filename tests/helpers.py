"""Small helpers for tests on hand-made rows."""


def rows(df, *columns):
    """All rows as sorted tuples; NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df):
    """The executed plan as text, final if the query has run."""
    return df._jdf.queryExecution().executedPlan().toString()
