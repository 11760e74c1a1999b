"""Small helpers of the tests."""


def rows(df, *columns):
    """Sorted tuples of a DataFrame."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
