"""Date parsing and formatting (DAT-1..6).

Parsing uses the ``try_`` family: under ANSI mode the plain forms raise on the
first unparsable value, while the reference expects null.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date formats tried in order by the cleansing step (first success wins).
SUBSCRIPTION_DATE_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "MM/dd/yyyy", "dd/MM/yyyy")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date_multi(c, formats: Sequence[str] = SUBSCRIPTION_DATE_FORMATS) -> Column:
    """DAT-1: the first format that parses wins; null when none does.

    ``02/03/2024`` resolves as MM/dd because that format comes first.
    """
    c = _col(c)
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def year_month(c) -> Column:
    """DAT-3: ``yyyy-MM`` label."""
    return F.date_format(_col(c), "yyyy-MM")


def python_to_spark_format(fmt: str) -> str:
    """DAT-6: translate the common strftime directives into Spark datetime patterns."""
    # Strftime directive → Spark pattern letters.
    table = {"%d": "dd", "%m": "MM", "%Y": "yyyy", "%y": "yy", "%H": "HH", "%I": "hh",
             "%M": "mm", "%S": "ss", "%p": "a", "%b": "MMM", "%B": "MMMM", "%a": "EEE",
             "%A": "EEEE", "%j": "DDD", "%%": "%"}
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            out.append(table.get(fmt[i:i + 2], fmt[i:i + 2]))
            i += 2
        else:
            ch = fmt[i]
            out.append(f"'{ch}'" if ch.isalpha() else ch)
            i += 1
    return "".join(out)
