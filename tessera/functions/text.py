"""String, array and JSON column functions (STR-*, ARR-1, JSN-1, NUL-1).

All are built-in Spark expressions (JVM side, whole-stage codegen); no Python UDF.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The mail providers that count as public (STR-13), in the reference's order.
PUBLIC_MAIL_DOMAINS = ("gmail.com", "yahoo.com", "outlook.com")

# The e-mail validity pattern applied by the cleansing step (FLT-6).
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# Characters kept in a cleaned phone number (STR-11).
PHONE_DROP_PATTERN = r"[^0-9+]"

URL_HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"


def not_blank(c) -> Column:
    """FLT-3: not null and not only spaces."""
    c = _col(c)
    return c.isNotNull() & (F.trim(c) != "")


def text_equals(c, value: str) -> Column:
    """FLT-4: case- and space-insensitive equality (``strip().upper() == VALUE``)."""
    return F.upper(F.trim(_col(c))) == value.strip().upper()


def email_domain(c) -> Column:
    """ARR-1: the part after ``@``; null when there is no ``@`` (tolerant under ANSI)."""
    return F.try_element_at(F.split(_col(c), "@"), F.lit(2))


def provider_type(c, public_domains: Sequence[str] = PUBLIC_MAIL_DOMAINS) -> Column:
    """STR-13: ``Public`` for well-known mail providers, otherwise ``Business``."""
    return F.when(F.lower(_col(c)).isin(*public_domains), F.lit("Public")).otherwise(
        F.lit("Business"))


def clean_phone(c) -> Column:
    """STR-11: keep digits and ``+`` only."""
    return F.regexp_replace(F.trim(_col(c)), PHONE_DROP_PATTERN, "")


def url_host(c) -> Column:
    """Lower-cased host name of an absolute URL; ``''`` when the URL has none."""
    return F.lower(F.regexp_extract(_col(c), URL_HOST_PATTERN, 1))


def retail_clean(df: DataFrame, id_col: str, name_col: str, email_col: str, code_col: str,
                 items_col: str, store_col: str, id_width: int = 5) -> DataFrame:
    """STR-12: the eight-column retail clean-up plus one row per item.

    Transaction type: ``ORDER`` for codes that start with ``ORD``, ``RETURN`` for ``RET``,
    otherwise ``UNKNOWN``.  Year = the 4 digits after the prefix and its dash; city code = the
    middle token of the store code; the id is left-padded with zeros.
    """
    code = F.col(code_col)
    return df.select(
        F.col(id_col),
        F.initcap(F.trim(F.col(name_col))).alias("CustomerName"),
        F.lower(F.trim(F.col(email_col))).alias("Email"),
        email_domain(F.lower(F.trim(F.col(email_col)))).alias("EmailDomain"),
        F.when(code.startswith("ORD"), "ORDER").when(code.startswith("RET"), "RETURN")
         .otherwise("UNKNOWN").alias("TransactionType"),
        F.regexp_extract(code, r"^[A-Z]+-(\d{4})-", 1).alias("OrderYear"),
        F.try_element_at(F.split(F.col(store_col), "-"), F.lit(2)).alias("CityCode"),
        F.lpad(F.col(id_col).cast("string"), id_width, "0").alias("PaddedId"),
        F.explode(F.split(F.col(items_col), r"\s*,\s*")).alias("Item"))
