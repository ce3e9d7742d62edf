"""File sources (SRC-1..11, SRC-13).

Every reader returns a lazy DataFrame; executors read the files.  Malformed
rows are never raised on one by one in Python: a delimited read either fails
the job (``on_bad="fail"``) or routes bad rows to a quarantine frame.
"""

from __future__ import annotations

import csv
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def _schema(schema) -> StructType | None:
    if schema is None or isinstance(schema, StructType):
        return schema
    return StructType.fromDDL(schema)


def read_delimited(spark: SparkSession, path, schema=None, sep: str = ",", header: bool = True,
                   quote: str = '"', escape: str = "\\", infer: bool = False,
                   on_bad: str = "quarantine", names: Sequence[str] | None = None,
                   options: dict | None = None, same_header: bool = False,
                   file_column: str | None = None):
    """SRC-1..5: delimited text.

    ``on_bad="quarantine"`` returns ``(good, bad)``: rows that do not fit (too few or too many
    fields, values that cannot be read as their type) land in ``bad`` with their raw text and
    file.  ``"fail"`` raises on the first such row, ``"drop"`` drops them.  Without a schema the
    columns are the header's (all text, or ``infer`` reads the data once for types), and the
    same rules hold for rows that do not have them.  ``names`` renames the columns of a
    headerless file (SRC-2).  The header is taken off each file.  Blank lines are no rows.

    Several files with headers are read by column name: each file's own header says where its
    columns are.  Rows of files that lack a column, or have one that is unknown or repeated, are
    bad rows.  ``same_header`` promises equal headers (layers written by this library) and
    saves the pass over the files that finds them.  ``file_column`` adds each row's file, also
    where Spark's own ``_metadata`` is lost since files of several headers are put together.
    """
    if on_bad not in ("quarantine", "fail", "drop"):
        raise ValueError(f"unknown on_bad {on_bad!r}")
    r = (spark.read.option("header", str(header).lower()).option("sep", sep)
         .option("quote", quote).option("escape", escape))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    schema = _schema(schema)
    if schema is None:
        schema = r.option("inferSchema", str(infer).lower()).csv(path).schema
    if names:
        schema = StructType([StructField(n, f.dataType, True) for n, f in zip(names, schema, strict=True)])
    if header and not same_header and not names:
        found = _headers(r.csv(path), sep, quote, escape, options or {})
        if any(list(columns) != schema.names for columns in found):
            return _read_by_name(spark, found, schema, sep, quote, escape, on_bad, options, file_column)
    # a row is judged by all its fields, whichever columns a query reads
    r = r.option("columnPruning", "false").option("enforceSchema", "true")
    if on_bad != "quarantine":
        read = r.schema(schema).option("mode", "FAILFAST" if on_bad == "fail" else "DROPMALFORMED").csv(path)
        return read.withColumn(file_column, F.col("_metadata.file_path")) if file_column else read
    fields = [f.name for f in schema.fields]
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    # Spark converts only the fields that a query reads, and refuses scans of the raw text
    # alone; so the raw text of a bad row is tied to all its fields
    every = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in fields])
    raw = F.when(F.col(CORRUPT).isNotNull(), F.concat(F.col(CORRUPT), F.substring(every, 1, 0)))
    parsed = (r.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .csv(path).withColumns({"_raw": raw, "_raw_file": F.col("_metadata.file_path")}))
    extra = [F.col("_raw_file").alias(file_column)] if file_column else []
    good = parsed.filter(F.col("_raw").isNull()).select(*[F.col(f"`{c}`") for c in fields if c != file_column], *extra)
    bad = parsed.filter(F.col("_raw").isNotNull()).select(
        F.col("_raw").alias("raw_record"), F.col("_raw_file").alias("_source_file"))
    return good, bad


#: More different headers than this in one load are refused.
MOST_HEADERS = 1000


def _headers(loaded: DataFrame, sep: str, quote: str, escape: str, options: dict
             ) -> dict[tuple[str, ...], list[str]]:
    """The files of a load by their column names, read off each file's first filled line.

    One aggregate over the lines, a row per file in its result; the files' own names come from
    the listing that Spark keeps anyway.  Options under which a header is not one line of UTF-8
    text leave the check to Spark, which compares headers by position and fails.
    """
    files = loaded.inputFiles()
    if len(files) < 2:
        return {}
    spark = loaded.sparkSession
    if any(k.lower() in ("multiline", "encoding", "charset", "linesep") for k in options):
        return {}
    lines = (spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.file_block_start").alias("start"))
             .filter((F.col("start") == 0) & (F.trim("value") != ""))
             .withColumn("at", F.monotonically_increasing_id()))
    heads = (lines.groupBy("file").agg(F.min_by("value", "at").alias("head"))
             .groupBy("head").agg(F.collect_list("file").alias("files")).limit(MOST_HEADERS + 1).collect())
    if len(heads) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers")
    out: dict[tuple[str, ...], list[str]] = {}
    for row in heads:
        columns = next(csv.reader([row["head"].lstrip("\ufeff")], delimiter=sep, quotechar=quote or None,
                                  quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE,
                                  doublequote=escape == quote,
                                  escapechar=None if escape == quote else escape))
        out.setdefault(tuple(columns), []).extend(row["files"])
    return out


def _read_by_name(spark: SparkSession, found: dict[tuple[str, ...], list[str]], schema: StructType,
                  sep: str, quote: str, escape: str, on_bad: str, options: dict | None,
                  file_column: str | None = None):
    """Files of several headers: each group by its own columns, put into the schema's order."""
    wanted = {f.name: f for f in schema.fields}
    extra = [file_column] if file_column else []
    goods, bads = [], []
    for columns, files in sorted(found.items()):
        complete = sorted(columns) == sorted(wanted)
        if not complete and on_bad == "fail":
            raise ValueError(f"{files[0]} has the columns {list(columns)} instead of {list(wanted)}")
        if complete:
            own = StructType([wanted[c] for c in columns])
            read = read_delimited(spark, files, own, sep, True, quote, escape, on_bad=on_bad,
                                  options=options, same_header=True, file_column=file_column)
            good, bad = read if on_bad == "quarantine" else (read, None)
            goods.append(good.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*wanted, *extra])]))
            if bad is not None:
                bads.append(bad)
        elif on_bad == "quarantine":
            lines = spark.read.text(files).select(
                F.col("value").alias("raw_record"), F.col("_metadata.file_path").alias("_source_file"))
            bads.append(_without_header(lines, columns, sep, quote, escape))
    none = spark.createDataFrame([], StructType([*[f for f in schema.fields if f.name != file_column],
                                             *[StructField(c, StringType()) for c in extra]]))
    good = reduce(DataFrame.unionByName, goods, none)
    if on_bad != "quarantine":
        return good
    empty = spark.createDataFrame([], "raw_record string, _source_file string")
    return good, reduce(DataFrame.unionByName, bads, empty)


def _without_header(lines: DataFrame, columns: tuple[str, ...], sep: str, quote: str, escape: str
                    ) -> DataFrame:
    """The lines of files with these columns but for blank ones and the headers."""
    fields = F.from_csv("raw_record", ", ".join(f"c{i} string" for i in range(len(columns))),
                        {"sep": sep, "quote": quote, "escape": escape})
    is_head = reduce(lambda a, b: a & b, [fields[f"c{i}"].eqNullSafe(F.lit(c or None))
                                          for i, c in enumerate(columns)])
    return lines.filter((F.trim("raw_record") != "") & ~is_head)


def read_lines(spark: SparkSession, path, whole_text: bool = False) -> DataFrame:
    """SRC-6: one row per line (column ``value``); a glob selects files."""
    return spark.read.option("wholetext", str(whole_text).lower()).text(path)


def read_json(spark: SparkSession, path, schema=None, multiline: bool = False) -> DataFrame:
    """SRC-7 / SRC-8: JSON lines (default) or one multi-line JSON document per file."""
    r = spark.read.option("multiLine", str(multiline).lower())
    schema = _schema(schema)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_layer(spark: SparkSession, path, fmt: str = "parquet", schema=None) -> DataFrame:
    """SRC-9 / SRC-10: a columnar layer (parquet, orc, json, csv ...).

    Lake-table formats need their connector on the classpath; without it the
    same layout is read as parquet.
    """
    r = spark.read.format(fmt)
    schema = _schema(schema)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
    return r.load(path)


def with_provenance(df: DataFrame, file_col: str = "_source_file",
                    time_col: str = "_ingestion_timestamp") -> DataFrame:
    """SRC-13: source file (from the file-source metadata column, unless the rows have it
    already) and ingestion time."""
    file = F.col(file_col if file_col in df.columns else "_metadata.file_path")
    return df.withColumns({file_col: file, time_col: F.current_timestamp()})


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None,
              lower: int | None = None, upper: int | None = None, parts: int = 1,
              driver: str | None = None, properties: dict | None = None) -> DataFrame:
    """SRC-12: a table read by ``parts`` parallel range queries on ``column``."""
    props = dict(properties or {})
    if driver:
        props["driver"] = driver
    if column is not None:
        return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                               numPartitions=parts, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               driver: str | None = None, properties: dict | None = None) -> None:
    """SNK-13: each partition writes its rows over its own connection."""
    props = dict(properties or {})
    if driver:
        props["driver"] = driver
    df.write.jdbc(url, table, mode=mode, properties=props)
