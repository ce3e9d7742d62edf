"""Paths and helpers that several test modules use."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
