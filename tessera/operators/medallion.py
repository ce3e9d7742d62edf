"""Bronze → Silver → Gold for a customer feed.

Layers talk to each other through storage only: each step reads the previous
layer's files and writes its own, so a failed step is re-run from the layer
below and lineage never spans the whole flow.

Silver is declared: ``COLUMNS`` says of what kind each column is, ``KINDS`` how a kind is
cleaned, ``RULES`` what a valid record needs.  Gold reports are built from the shared
operators ``kpis``, ``trend`` and ``share_of_total``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import parse_date_multi
from tessera.functions.names import standardize_columns
from tessera.functions.text import EMAIL_PATTERN, clean_phone, email_domain, not_blank
from tessera.operators.aggregate import kpis, share_of_total, trend
from tessera.operators.dedup import latest_per_key, removed_duplicates
from tessera.operators.quality import REASON, REASONS, VALID, apply_rules, split_valid
from tessera.session import work_path
from tessera.sinks.layout import write_counted, write_layer, write_reports
from tessera.sources.files import read_delimited, with_provenance

#: How the text of each kind of column is cleaned.
KINDS: dict[str, Callable[[Column], Column]] = {
    "text": F.trim,
    "cased": lambda c: F.initcap(F.trim(c)),
    "email": lambda c: F.lower(F.trim(c)),
    "phone": clean_phone,
    "date": parse_date_multi,
    "number": lambda c: c.try_cast("long"),
}

#: The feed's columns after name standardisation.  Optional ones are null where absent.
COLUMNS = {"customer_id": "text", "email": "email", "subscription_date": "date", "company": "text",
           **dict.fromkeys(("first_name", "last_name", "city", "country"), "cased"),
           **dict.fromkeys(("phone_1", "phone_2"), "phone"), "index": "number"}
OPTIONAL = ("phone_2", "index")

# The rejection reasons, in the order in which they are checked.
RULES: dict[str, Callable[[], Column]] = {
    "Missing customer ID": lambda: F.length("customer_id") > 0,
    "Missing first name": lambda: F.length("first_name") > 0,
    "Missing last name": lambda: F.length("last_name") > 0,
    "Invalid email": lambda: F.col("email").rlike(EMAIL_PATTERN),
    "Invalid subscription date": lambda: F.col("subscription_date").isNotNull(),
    "Missing country": lambda: not_blank("country"),
}
#: Only the e-mail rule may answer neither yes nor no (on a null); the others are plain.
_NULLABLE_RULES = ("Invalid email",)


def customer_bronze(spark: SparkSession, source_path: str, bronze_path: str,
                    rejects_path: str | None = None, codec: str | None = None) -> str:
    """Bronze: raw CSV + provenance columns → CSV layer.

    The text is kept as it is (no inference pass); lines that do not have the header's
    columns go to ``rejects_path`` with their raw text instead of being padded or cut.
    ``codec`` compresses the layer.
    """
    good, bad = read_delimited(spark, source_path, header=True, file_column="_source_file")
    write_layer(with_provenance(good), bronze_path, "csv", codec=codec)
    write_layer(bad, rejects_path or f"{bronze_path.rstrip('/')}_rejects", "json")
    return bronze_path


def cleaned(bronze: DataFrame) -> DataFrame:
    """Every declared column cleaned by its kind, others as they are, in one projection."""
    df = standardize_columns(bronze)
    missing = [c for c in COLUMNS if c not in df.columns]
    if set(missing) - set(OPTIONAL):
        raise ValueError(f"the feed lacks {sorted(set(missing) - set(OPTIONAL))}")
    tidy = {c: KINDS[kind](F.col(c).cast("string")) for c, kind in COLUMNS.items() if c not in missing}
    empty = {c: F.lit(None).cast("long" if COLUMNS[c] == "number" else "string") for c in missing}
    return df.withColumns(tidy | empty).withColumn("email_domain", email_domain("email"))


def silver_rules(require_country: bool = True) -> list[tuple[str, Column]]:
    return [(reason, rule() if reason in _NULLABLE_RULES else F.coalesce(rule(), F.lit(False)))
            for reason, rule in RULES.items() if require_country or reason != "Missing country"]


@dataclass
class SilverResult:
    valid: DataFrame
    rejected: DataFrame
    duplicates: DataFrame
    validated: DataFrame
    #: Rows of each written layer, counted while it was written; ``input`` is what Bronze gave.
    counts: dict[str, int] = field(default_factory=dict)


#: Number of a validated row, given when the rows are written.
ROW = "_row"


def split_silver(validated: DataFrame) -> SilverResult:
    """Valid rows de-duplicated per customer (latest kept), rejected rows, removed copies.

    Copies are told apart by the ``ROW`` number of the written rows, so every row ends in
    exactly one of the three whether the feed's index is absent, repeated or no number; among
    rows of one date and index the one written last is kept.
    """
    valid, rejected = split_valid(validated)
    valid = valid.drop(VALID, REASON, REASONS)
    kept = latest_per_key(valid, "customer_id", ["subscription_date", "index", ROW])
    copies = removed_duplicates(valid, kept, [ROW])
    return SilverResult(kept.drop("index", ROW), rejected.drop(ROW), copies.drop(ROW), validated)


def customer_silver(spark: SparkSession, bronze_path: str, silver_path: str,
                    rejected_path: str, duplicates_path: str | None = None,
                    validated_path: str | None = None) -> SilverResult:
    """Silver: read the Bronze CSV as text, validate once and write the validated rows; the
    valid, rejected and duplicate layers are then split from that written table, so the
    CSV is parsed once and the lineage of each output starts at storage.  Every layer is
    counted while it is written."""
    bronze, _ = read_delimited(spark, bronze_path, header=True, same_header=True)
    validated = apply_rules(cleaned(bronze), silver_rules())
    validated_path = validated_path or work_path(spark, "silver_validated")
    n = write_counted(validated.withColumn(ROW, F.monotonically_increasing_id()), validated_path)["records"]
    res = split_silver(spark.read.parquet(validated_path))
    layers = {"valid": (res.valid.withColumn("_silver_written", F.current_timestamp()), silver_path),
              "rejected": (res.rejected, rejected_path), "duplicates": (res.duplicates, duplicates_path)}
    res.counts = {"input": n} | {name: write_counted(df, path)["records"]
                                 for name, (df, path) in layers.items() if path}
    return res


#: What the reports count, and the dates whose range they give.
MEASURED = {"customers": "customer_id", "countries": "country", "cities": "city", "companies": "company"}
JOINED = {"subscription_date": ("joined_first", "joined_last")}


def _distinct(*names: str) -> dict[str, Column]:
    return {n: F.countDistinct(MEASURED[n]) for n in names}


def _by(silver: DataFrame, key: str, *names: str, dates: bool = False) -> DataFrame:
    """Distinct counts per key with the share of all customers."""
    measures = _distinct("customers", *names)
    if dates:
        measures |= {"joined_first": F.min("subscription_date"), "joined_last": F.max("subscription_date")}
    grouped = silver.groupBy(key).agg(*[m.alias(n) for n, m in measures.items()])
    return share_of_total(grouped, "customers", "customers_pct")


#: Gold: report name and how it is made of the Silver rows.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "totals": lambda s: kpis(s, MEASURED, JOINED),
    "by_country": lambda s: _by(s, "country", "cities", "companies", dates=True),
    "by_month": lambda s: trend(s, "subscription_date", "yyyy-MM", "joined_month",
                                _distinct("customers", "countries", "companies")),
    "by_domain": lambda s: _by(s.filter(not_blank("email_domain")), "email_domain"),
}


def customer_gold(spark: SparkSession, silver_path: str, gold_base: str) -> dict[str, str]:
    """Gold: reports from the Silver layer, each written with an audit timestamp."""
    silver = spark.read.parquet(silver_path)
    return write_reports({name: make(silver) for name, make in REPORTS.items()}, gold_base)


def rejection_summary(rejected: DataFrame) -> DataFrame:
    """Rejected rows per first failing reason, with their share."""
    g = rejected.groupBy(F.col(REASON).alias("reason")).agg(F.count(F.lit(1)).alias("records"))
    return share_of_total(g, "records", "percentage")
