"""What test modules share: the smallest tables, rows as sets, plans as text."""

SF = "/root/testdata/sf0.001"


def sets(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
