"""Rows of a DataFrame in a form that tests compare."""


def rows(df, *cols):
    """Collected rows as sorted tuples of the given columns."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
