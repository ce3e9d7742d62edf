"""Column-name standardisation (PRJ-4)."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    """A plain identifier: the name's ASCII words in lower case, joined by underscores.

    A name without such words becomes ``column``; one that starts with a digit gets ``c_``
    in front, so the result can be used unquoted.
    """
    joined = "_".join(re.findall("[a-z0-9]+", name.lower())) or "column"
    return f"c_{joined}" if joined[0].isdigit() else joined


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with ``clean_name`` in one projection.

    Headers that clean to the same name (``Phone 1`` and ``phone-1``) would shadow each
    other, so they raise.
    """
    cleaned = [clean_name(c) for c in df.columns]
    clashes = {n for n, times in Counter(cleaned).items() if times > 1}
    if clashes:
        both = [c for c, n in zip(df.columns, cleaned) if n in clashes]
        raise ValueError(f"columns {both} clean to the same names: {sorted(clashes)}")
    return df.toDF(*cleaned)
