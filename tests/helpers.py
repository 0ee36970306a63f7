"""What several test modules share."""


def rows(df):
    """Rows as sorted text, columns in name order."""
    names = sorted(df.columns)
    return sorted(tuple("null" if r[n] is None else repr(r[n]) for n in names) for r in df.collect())
