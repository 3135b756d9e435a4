"""What several test modules use."""


def rows(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
