"""Window functions that stay parallel.

Two families:

* Per-group aggregates broadcast back to rows (``SUM() OVER (PARTITION BY k)``,
  ``AVG() OVER ()``, ``FIRST_VALUE`` / ``LAST_VALUE`` over the whole partition):
  a partial/final ``groupBy`` followed by a join back on the key.  The grouped
  side has one row per key, so a hot key costs nothing extra; with no key the
  grouped side is exactly one row, attached as a scalar subquery.

* Ordinal windows (row_number, rank, dense_rank, running sums, NTILE, LAG/LEAD,
  moving frames).  A stock ``Window`` sends every row of a partition key - or
  of the whole table when there is none - to one task.  Here one partial/final
  count tells whether a key (or the table) has more than ``hot_rows`` rows; if
  none has, the plain window is used.  Otherwise the rows are dealt into ranges
  (``_ranges`` bounds their number) of (keys, all order columns) by Spark's range partitioner, which sorts any type,
  nulls and NaN as the window does, and splits ties of the first order columns by
  the later ones.  Ranges are materialised once, so counts and rows agree on them.
  Only keys that lie in several ranges need offsets: at most two rows per range.
  Prefix counts and sums are taken over that small table and added to the window
  per (key, range).  Frames that look back or ahead (LAG, LEAD, ``ROWS k
  PRECEDING``) patch the first / last k rows of each range from a table of edge
  rows, matched by equi-joins on row numbers - never by pairing rows.  Orders
  must be total (end with a unique column), as for any deterministic LAG; rows
  that tie in every order column stay in one range.

Sums do not depend on how rows are split.  Integers and decimals are added at their own
type; DOUBLE through exact partial states (``functions/exact.py``), rounded once at the end;
``scale`` makes exact decimal sums of that many digits, returned as DOUBLE (for money).

Every function takes ``strategy="segmented"`` (default) or ``"literal"`` (the
stock ``Window`` form, kept for small inputs and as the reference in tests).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tessera.functions.exact import summing
from tessera.session import checkpoint_root

# A key with more rows than this is cut into ranges; fewer stay in one task.
DEFAULT_HOT_ROWS = 2_000_000
# More ranges than this are made only where ranges would exceed DEFAULT_HOT_ROWS rows otherwise:
# every range is a task and a file, and the range partitioner's sample grows with their number.
MOST_RANGES = 480


# --------------------------------------------------------------------------- helpers

@dataclass(frozen=True)
class OrderKey:
    name: str
    ascending: bool

    @property
    def column(self) -> Column:
        c = F.col(self.name)
        return c.asc() if self.ascending else c.desc()


def parse_order(order: Sequence[str] | str) -> list[OrderKey]:
    if isinstance(order, str):
        order = [order]
    out = []
    for o in order:
        if isinstance(o, OrderKey):
            out.append(o)
            continue
        o = o.strip()
        if o.startswith("-"):
            out.append(OrderKey(o[1:], False))
        else:
            out.append(OrderKey(o.lstrip("+"), True))
    return out


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    if isinstance(keys, str):
        return [keys]
    return list(keys)


def _window(keys: list[str], order: list[OrderKey] | None = None):
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    if order:
        w = w.orderBy(*[o.column for o in order])
    return w


def join_back(df: DataFrame, grouped: DataFrame, keys: list[str]) -> DataFrame:
    """Attach per-key columns of ``grouped`` (one row per key) to ``df``.

    Null keys match null keys (the grouping put them in one group).  Without
    keys ``grouped`` is a single row.
    """
    if not keys:
        # one row: attached as a scalar subquery (computed once, used as a value)
        return with_scalars(df, grouped)
    renamed = grouped
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = df.join(renamed, cond, "left")
    return out.drop(*[f"__r_{k}" for k in keys])


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach every column of a one-row frame to ``df`` through a single scalar
    subquery (more than one row is a run-time error, as in SQL)."""
    packed = one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("_s")).scalar()
    return df.withColumns({c: packed.getField(c) for c in one_row.columns})


def _hot_total(df: DataFrame, keys: list[str], hot_rows: int) -> int | None:
    """Rows of ``df`` if some key (or the table) has more than ``hot_rows``, else None.

    A partial/final count; without keys one number per task meets in the last one.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    return row["total"] if (row["most"] or 0) > hot_rows else None


def _ranges(total: int, hot_rows: int) -> int:
    """Into how many ranges ``total`` rows are dealt: of half of ``hot_rows`` rows on average, but
    no more than ``MOST_RANGES`` while ranges of half of ``DEFAULT_HOT_ROWS`` rows do with fewer.
    Larger ranges hold more rows; all rows are dealt in any case."""
    wanted, least = (-(-2 * total // rows) for rows in (hot_rows, max(hot_rows, DEFAULT_HOT_ROWS)))
    return max(min(wanted, MOST_RANGES), least)


def _range_table(ranged: DataFrame, keys: list[str], sums: dict[str, Column],
                 rank_cols: Sequence[str], order: list[OrderKey]) -> DataFrame:
    """Per (key, range) of keys that lie in several ranges: sizes and what precedes.

    ``_off`` rows, ``_soff_c`` sums and ``_doff`` distinct rank values come before;
    ``_tie`` is the position at which the rank value that reaches over from the range
    before began (null if none does).  At most two rows per range.
    """
    aggs = [F.count(F.lit(1)).alias("_cnt"), *[e.alias(f"_sum_{c}") for c, e in sums.items()]]
    if rank_cols:
        value = F.struct(*[F.col(c) for c in rank_cols])
        place = F.col("_place")
        aggs += [F.countDistinct(value).alias("_dcnt"),
                 F.min_by(value, place).alias("_first"), F.max_by(value, place).alias("_last")]
        # the range's first and last rows by a row number within it
        ranged = ranged.withColumn("_place", F.row_number().over(_window(keys + ["_seg"], order)))
    seg = ranged.groupBy(*keys, "_seg").agg(*aggs)
    whole = _window(keys)
    ordered = whole.orderBy("_seg")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    cols = {"_off": F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("long"),
            "_hn": F.sum("_cnt").over(whole).cast("long"),
            "_segs": F.count(F.lit(1)).over(whole)}
    for c in sums:
        cols[f"_soff_{c}"] = F.sum(f"_sum_{c}").over(before)
    out = seg.withColumns(cols)
    if rank_cols:
        reaches = F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(ordered)), F.lit(False)) & (
            F.lag("_cnt").over(ordered).isNotNull())
        out = out.withColumn("_reach", reaches)
    return out.filter("_segs > 1").drop("_segs", *[f"_sum_{c}" for c in sums])


def _tie_columns(offs: DataFrame, ranged: DataFrame, keys: list[str], rank_cols: Sequence[str],
                 order: list[OrderKey]) -> DataFrame:
    """Adds ``_doff`` and ``_tie`` to the range table.

    A rank value that ends a range begins either in this range, at the position of its first
    row, or (if the range holds nothing else and the value reaches over) where it began before.
    """
    ends = offs.select(*keys, "_seg", F.col("_last").alias("_value"))
    value = F.struct(*[F.col(c) for c in rank_cols])
    tail = join_back(ranged.withColumn("_v", value), ends, keys + ["_seg"])
    tail = (tail.filter(F.col("_v").eqNullSafe(F.col("_value")) & F.col("_value").isNotNull())
            .groupBy(*keys, "_seg").agg(F.count(F.lit(1)).alias("_tail")))
    out = join_back(offs, tail, keys + ["_seg"])
    ordered = _window(keys).orderBy("_seg")
    carried = F.col("_reach") & (F.col("_dcnt") == 1)
    start = F.when(~carried, F.col("_off") + F.col("_cnt") - F.col("_tail") + 1)
    out = out.withColumn("_start", start).withColumns({
        "_doff": (F.sum("_dcnt").over(ordered) - F.col("_dcnt")
                  - F.sum(F.col("_reach").cast("int")).over(ordered)).cast("long"),
        "_tie": F.when(F.col("_reach"), F.last("_start", ignorenulls=True).over(
            ordered.rowsBetween(Window.unboundedPreceding, -1)))})
    return out.drop("_start", "_tail", "_reach", "_dcnt", "_last")


def _split_positions(df: DataFrame, keys, order, sums: dict[str, Column] | None = None,
                     rank_cols: Sequence[str] = (), hot_rows: int | None = None):
    """Rows with ``_seg`` (range), ``_rn`` (row_number within the key over the whole
    order), ``_n`` (key size), ``_cnt`` (rows in the range), ``_hot`` (the key lies in
    several ranges) and offsets; plus the range table and the ranged rows, which are
    None if nothing had to be split."""
    keys, order, sums = _keys(keys), parse_order(order), sums or {}
    hot_rows = DEFAULT_HOT_ROWS if hot_rows is None else hot_rows
    local = _window(keys + ["_seg"], order)
    whole_local = _window(keys + ["_seg"])
    total = _hot_total(df, keys, hot_rows)
    if total is None:
        # every key (or the whole table) fits one task: the plain window, one shuffle
        out = df.withColumns({"_seg": F.lit(0), "_hot": F.lit(False), "_off": F.lit(0).cast("long"),
                              **{f"_soff_{c}": F.lit(None).cast("double") for c in sums}})
        if rank_cols:
            out = out.withColumns({"_doff": F.lit(0).cast("long"), "_tie": F.lit(None).cast("long"),
                                   "_first": F.lit(None).cast("string")})
        out = out.withColumns({"_cnt": F.count(F.lit(1)).over(whole_local),
                               "_rn": F.row_number().over(local).cast("long")})
        return out.withColumn("_n", F.col("_cnt")), None, None
    checkpoint_root(df.sparkSession)
    ranged = (df.repartitionByRange(_ranges(total, hot_rows), *[F.col(k) for k in keys], *[o.column for o in order])
              .withColumn("_seg", F.spark_partition_id()).checkpoint())
    offs = _range_table(ranged, keys, sums, rank_cols, order)
    if rank_cols:
        offs = _tie_columns(offs.checkpoint(), ranged, keys, rank_cols, order)
    offs = offs.checkpoint()
    out = join_back(ranged, offs.withColumn("_hot", F.lit(True)).withColumnRenamed("_cnt", "_rcnt"),
                    keys + ["_seg"])
    out = out.withColumns({
        "_hot": F.coalesce(F.col("_hot"), F.lit(False)),
        "_off": F.coalesce(F.col("_off"), F.lit(0).cast("long")),
        "_cnt": F.coalesce(F.col("_rcnt"), F.count(F.lit(1)).over(whole_local))}).drop("_rcnt")
    if rank_cols:
        out = out.withColumn("_doff", F.coalesce(F.col("_doff"), F.lit(0).cast("long")))
    out = out.withColumns({"_n": F.coalesce(F.col("_hn"), F.col("_cnt")),
                           "_rn": F.col("_off") + F.row_number().over(local)}).drop("_hn")
    return out, offs, ranged


def positions(df: DataFrame, keys, order, hot_rows: int | None = None):
    """Rows with their positions, and the range table (None if nothing was split)."""
    rows, offs, _ = _split_positions(df, keys, order, hot_rows=hot_rows)
    return rows, offs


# --------------------------------------------------------------------------- per-group aggregates

def with_group_aggregates(df: DataFrame, keys, aggs: dict[str, Column],
                          strategy: str = "segmented") -> DataFrame:
    """``agg OVER (PARTITION BY keys)`` for each named aggregate."""
    keys = _keys(keys)
    if strategy == "literal":
        w = _window(keys)
        return df.withColumns({name: a.over(w) for name, a in aggs.items()})
    grouped = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return join_back(df, grouped, keys)


def with_total(df: DataFrame, column: str, name: str = "grand_total",
               strategy: str = "segmented", scale: int | None = None) -> DataFrame:
    """WIN-1: ``SUM(c) OVER ()``."""
    return with_partition_total(df, [], column, name, strategy, scale)


def with_partition_total(df: DataFrame, keys, column: str, name: str,
                         strategy: str = "segmented", scale: int | None = None) -> DataFrame:
    """WIN-2: ``SUM(c) OVER (PARTITION BY keys)``."""
    how = summing(df, column, scale)
    totals = [F.sum(p) for p in how.pieces(column)]
    if strategy == "literal":
        w = _window(_keys(keys))
        return df.withColumn(name, how.result([t.over(w) for t in totals]))
    return with_group_aggregates(df, keys, {name: how.result(totals)}, strategy)


def with_partition_avg(df: DataFrame, keys, column: str, name: str, diff_name: str | None = None,
                       strategy: str = "segmented", scale: int | None = None) -> DataFrame:
    """WIN-15 / WIN-20: average per partition and the difference from it."""
    how, n = summing(df, column, scale), F.count(column)
    totals = [F.sum(p) for p in how.pieces(column)]
    if strategy == "literal":
        w = _window(_keys(keys))
        mean = how.result([t.over(w) for t in totals]).cast("double") / n.over(w)
        out = df.withColumn(name, mean)
    else:
        out = with_group_aggregates(df, keys, {name: how.result(totals).cast("double") / n}, strategy)
    if diff_name:
        out = out.withColumn(diff_name, F.col(column) - F.col(name))
    return out


def with_first_last(df: DataFrame, keys, order, column: str, first_name: str | None,
                    last_name: str | None, strategy: str = "segmented") -> DataFrame:
    """WIN-9 / WIN-17: FIRST_VALUE (default frame) and LAST_VALUE (whole partition).

    With an ORDER BY the default frame starts at the partition start, so the
    first value is the partition's first row; LAST_VALUE over the full frame is
    the partition's last row.  With orders of one direction both are ``min_by`` /
    ``max_by`` aggregates; mixed directions take the first and last row by number.
    """
    keys = _keys(keys)
    order = parse_order(order)
    if strategy == "literal":
        w = _window(keys, order)
        full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        cols = {}
        if first_name:
            cols[first_name] = F.first(column).over(w)
        if last_name:
            cols[last_name] = F.last(column).over(full)
        return df.withColumns(cols)
    if len({o.ascending for o in order}) > 1:
        firsts = top_n_per_group(df, keys, order, 1, "_p").select(*keys, F.col(column).alias("_fv"))
        lasts = top_n_per_group(df, keys, _reverse(order), 1, "_p").select(*keys, F.col(column).alias("_lv"))
        out = join_back(join_back(df, firsts, keys), lasts, keys)
        wanted = [F.col(v).alias(n) for v, n in (("_fv", first_name), ("_lv", last_name)) if n]
        return out.select(*df.columns, *wanted)
    ordering = F.struct(*[F.col(o.name) for o in order])
    first, last = (F.min_by, F.max_by) if order[0].ascending else (F.max_by, F.min_by)
    aggs = {}
    if first_name:
        aggs[first_name] = first(F.col(column), ordering)
    if last_name:
        aggs[last_name] = last(F.col(column), ordering)
    return with_group_aggregates(df, keys, aggs)


def with_percent_of_partition(df: DataFrame, keys, column: str, name: str, scale: int = 2,
                              strategy: str = "segmented", digits: int = 2) -> DataFrame:
    """WIN-11: ``ROUND(c * 100.0 / SUM(c) OVER (PARTITION BY keys), scale)``, exact for
    amounts of up to ``digits`` decimal digits."""
    from tessera.functions.numeric import cents, percent
    keys = _keys(keys)
    total = F.sum(cents(column, digits))
    if strategy == "literal":
        return df.withColumn(name, percent(cents(column, digits), total.over(_window(keys)), scale))
    out = with_group_aggregates(df, keys, {"_ptotal": total})
    return out.withColumn(name, percent(cents(column, digits), F.col("_ptotal"), scale)).drop("_ptotal")


# --------------------------------------------------------------------------- ordinal windows

_INTERNAL = {"_seg", "_cnt", "_off", "_n", "_rn", "_doff", "_hot", "_hn", "_tie", "_first"}


def _drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in _INTERNAL or c.startswith("_soff_")])


def with_rank_columns(df: DataFrame, keys, order, row_number: str | None = None,
                      rank: str | None = None, dense_rank: str | None = None,
                      rank_order=None, strategy: str = "segmented", hot_rows: int | None = None) -> DataFrame:
    """WIN-4 / 5 / 12 / 19: ROW_NUMBER over ``order``; RANK / DENSE_RANK over
    ``rank_order`` (defaults to ``order``; usually the order without its
    tie-breaker).  ``rank_order`` must be a prefix of ``order``."""
    keys = _keys(keys)
    order_k = parse_order(order)
    rank_k = parse_order(rank_order) if rank_order is not None else order_k
    if rank_k != order_k[:len(rank_k)]:
        raise ValueError("rank_order must be a prefix of order")
    if strategy == "literal":
        cols = {}
        if row_number:
            cols[row_number] = F.row_number().over(_window(keys, order_k))
        if rank:
            cols[rank] = F.rank().over(_window(keys, rank_k))
        if dense_rank:
            cols[dense_rank] = F.dense_rank().over(_window(keys, rank_k))
        return df.withColumns(cols)
    rank_cols = [o.name for o in rank_k] if rank or dense_rank else []
    pos, offs, _ = _split_positions(df, keys, order_k, rank_cols=rank_cols, hot_rows=hot_rows)
    local_rank = _window(keys + ["_seg"], rank_k)
    cols = {}
    if row_number:
        cols[row_number] = F.col("_rn").cast("int")
    if rank:
        place = F.col("_off") + F.rank().over(local_rank)
        if offs is not None:
            # a value that reaches over from the range before keeps the place where it began
            reaches = F.col("_tie").isNotNull() & F.struct(*rank_cols).eqNullSafe(F.col("_first"))
            place = F.when(reaches, F.col("_tie")).otherwise(place)
        cols[rank] = place.cast("int")
    if dense_rank:
        cols[dense_rank] = (F.col("_doff") + F.dense_rank().over(local_rank)).cast("int")
    out = pos.withColumns(cols)
    return _drop_internal(out)


def with_running_sum(df: DataFrame, keys, order, column: str, name: str,
                     strategy: str = "segmented", hot_rows: int | None = None,
                     scale: int | None = None) -> DataFrame:
    """WIN-3 / WIN-14: ``SUM(c) OVER (... ROWS UNBOUNDED PRECEDING)``; null until the first
    value that is not."""
    keys = _keys(keys)
    order_k = parse_order(order)
    how = summing(df, column, scale)
    totals = {f"{column}_{i}": F.sum(p) for i, p in enumerate(how.pieces(column))}
    back = (Window.unboundedPreceding, Window.currentRow)
    if strategy == "literal":
        frame = _window(keys, order_k).rowsBetween(*back)
        return df.withColumn(name, how.result([t.over(frame) for t in totals.values()]))
    pos, offs, _ = _split_positions(df, keys, order_k, sums=totals, hot_rows=hot_rows)
    frame = _window(keys + ["_seg"], order_k).rowsBetween(*back)
    pos = pos.withColumns({f"_here_{c}": t.over(frame) for c, t in totals.items()})
    state = [F.col(f"_here_{c}") for c in totals]
    if offs is not None:
        # the state of all earlier ranges goes on in this one
        before = [F.col(f"_soff_{c}") for c in totals]
        state = [F.coalesce(b + h, b, h) for b, h in zip(before, state)]
    return _drop_internal(how.attach(pos, name, state)).drop(*[f"_here_{c}" for c in totals])


def ntile_of(rn: Column, n_rows: Column, buckets: int) -> Column:
    """NTILE(buckets) from a 1-based row number and the partition size.

    The first ``n_rows mod buckets`` tiles hold one row more than the others.
    """
    b = F.lit(buckets).cast("long")
    q = ((n_rows - n_rows % b) / b).cast("long")
    rem = n_rows % b
    big = rem * (q + 1)                     # rows covered by the larger tiles
    in_big = ((rn - 1) - (rn - 1) % (q + 1)) / (q + 1) + 1
    after = rn - big - 1
    in_small = rem + (after - after % F.greatest(q, F.lit(1))) / F.greatest(q, F.lit(1)) + 1
    return F.when(rn <= big, in_big).otherwise(in_small).cast("int")


def with_ntile(df: DataFrame, keys, order, buckets: int, name: str,
               strategy: str = "segmented", hot_rows: int | None = None) -> DataFrame:
    """WIN-13: NTILE(n) over a (possibly global) order."""
    keys = _keys(keys)
    order_k = parse_order(order)
    if strategy == "literal":
        return df.withColumn(name, F.ntile(buckets).over(_window(keys, order_k)))
    pos = _split_positions(df, keys, order_k, hot_rows=hot_rows)[0]
    out = pos.withColumn(name, ntile_of(F.col("_rn"), F.col("_n"), buckets))
    return _drop_internal(out)


def _reverse(order: list[OrderKey]) -> list[OrderKey]:
    # Spark's default null placement flips with the direction, so this is the exact reverse
    return [OrderKey(o.name, not o.ascending) for o in order]


def _edges(ranged: DataFrame, offs: DataFrame, keys: list[str], order: list[OrderKey], k: int,
           carry: Sequence[str]):
    """The first k and last k rows of every range of a hot key, with global row numbers.

    Two top-k per range (planned with a partial ``WindowGroupLimit``, so at most
    k rows per range leave each map task).  At most 2k rows per range: a bounded table.
    """
    meta = offs.select(*keys, "_seg", "_off", "_cnt")
    needed = dict.fromkeys([*keys, "_seg", *[o.name for o in order], *carry])
    hot = join_back(ranged.select(*needed), meta, keys + ["_seg"]).filter(F.col("_off").isNotNull())
    head = (hot.withColumn("_p", F.row_number().over(_window(keys + ["_seg"], order)))
            .filter(F.col("_p") <= k))
    head = head.select(*keys, "_seg", "_off", (F.col("_off") + F.col("_p")).alias("_rn"), *carry)
    tail = (hot.withColumn("_p", F.row_number().over(_window(keys + ["_seg"], _reverse(order))))
            .filter(F.col("_p") <= k))
    tail = tail.select(*keys, "_seg", "_off",
                       (F.col("_off") + F.col("_cnt") - F.col("_p") + 1).alias("_rn"), *carry)
    return head, tail


def _pick(needers: DataFrame, sources: DataFrame, keys: list[str], shift: int, column: str,
          name: str) -> DataFrame:
    """For each needer row, ``column`` of the source row ``shift`` rows away (equi-join
    on the target row number; both sides are edge rows, small)."""
    want = needers.select(*keys, "_rn", (F.col("_rn") + F.lit(shift)).alias("_t"))
    have = sources.select(*keys, F.col("_rn").alias("_t"), F.col(column).alias(name))
    return join_back(want, have, keys + ["_t"]).select(*keys, "_rn", name)


def _attach(pos: DataFrame, fix: DataFrame, keys: list[str]) -> DataFrame:
    """Fix-up table (edge rows only, at most 2k per range) attached to every row."""
    return join_back(pos, fix, keys + ["_rn"])


def with_lag_lead(df: DataFrame, keys, order, column: str, lag_name: str | None = None,
                  lead_name: str | None = None, offset: int = 1, diff_name: str | None = None,
                  strategy: str = "segmented", hot_rows: int | None = None) -> DataFrame:
    """WIN-7 / 8 / 21: LAG / LEAD by ``offset`` and ``c - LAG(c)``."""
    keys = _keys(keys)
    order_k = parse_order(order)
    if strategy == "literal":
        w = _window(keys, order_k)
        cols = {}
        if lag_name:
            cols[lag_name] = F.lag(column, offset).over(w)
        if lead_name:
            cols[lead_name] = F.lead(column, offset).over(w)
        if diff_name:
            cols[diff_name] = F.col(column) - F.lag(column, offset).over(w)
        return df.withColumns(cols)
    pos, offs, ranged = _split_positions(df, keys, order_k, hot_rows=hot_rows)
    local = _window(keys + ["_seg"], order_k)
    lpos = F.col("_rn") - F.col("_off")                     # position inside the range
    out = pos
    want_lag = bool(lag_name or diff_name)
    if want_lag:
        out = out.withColumn("_lag", F.lag(column, offset).over(local))
    if lead_name:
        out = out.withColumn("_lead", F.lead(column, offset).over(local))
    if offs is not None:
        # rows near a range edge take their neighbour from the edge of the next range
        head, tail = _edges(ranged, offs, keys, order_k, offset, [column])
        fixes = []
        if want_lag:
            fixes.append(_pick(head, tail, keys, -offset, column, "_fix_lag"))
        if lead_name:
            fixes.append(_pick(tail, head, keys, offset, column, "_fix_lead"))
        fix = fixes[0]
        for f in fixes[1:]:
            fix = fix.join(f, keys + ["_rn"], "full") if keys else fix.join(f, ["_rn"], "full")
        out = _attach(out, fix, keys)
        if want_lag:
            out = out.withColumn("_lag", F.when(F.col("_hot") & (lpos <= offset),
                                                F.col("_fix_lag")).otherwise(F.col("_lag")))
        if lead_name:
            out = out.withColumn("_lead", F.when(
                F.col("_hot") & (lpos > F.col("_cnt") - offset), F.col("_fix_lead"))
                .otherwise(F.col("_lead")))
    cols = {}
    if lag_name:
        cols[lag_name] = F.col("_lag")
    if diff_name:
        cols[diff_name] = F.col(column) - F.col("_lag")
    if lead_name:
        cols[lead_name] = F.col("_lead")
    out = out.withColumns(cols)
    return out.select(*df.columns, *cols.keys())


def with_moving_avg(df: DataFrame, keys, order, column: str, preceding: int, name: str,
                    strategy: str = "segmented", hot_rows: int | None = None,
                    scale: int | None = None) -> DataFrame:
    """WIN-10: ``AVG(c) OVER (ORDER BY .. ROWS BETWEEN n PRECEDING AND CURRENT ROW)``: the
    frame's sum by its count of values, null if it has none."""
    keys = _keys(keys)
    order_k = parse_order(order)
    how, n = summing(df, column, scale), F.count(column)
    totals = [F.sum(p) for p in how.pieces(column)]
    if strategy == "literal":
        fr = _window(keys, order_k).rowsBetween(-preceding, Window.currentRow)
        mean = how.result([t.over(fr) for t in totals]).cast("double") / n.over(fr)
        return df.withColumn(name, F.when(n.over(fr) > 0, mean))
    pos, offs, ranged = _split_positions(df, keys, order_k, hot_rows=hot_rows)
    fr = _window(keys + ["_seg"], order_k).rowsBetween(-preceding, Window.currentRow)
    names = [f"_m{i}" for i in range(how.size)]
    out = pos.withColumns({"_mcnt": n.over(fr), **{m: t.over(fr) for m, t in zip(names, totals)}})
    if offs is not None and preceding > 0:
        # the first rows of a range also need the last rows of earlier ranges: each
        # tail row is offered to the next ``preceding`` row numbers (equi-join),
        # and only offers from outside the needer's own range are kept
        head, tail = _edges(ranged, offs, keys, order_k, preceding, [column])
        offers = tail.select(*keys, F.col("_rn").alias("_src"), F.col(column).alias("_v"),
                             F.explode(F.sequence(F.col("_rn") + 1,
                                                  F.col("_rn") + preceding)).alias("_t"))
        want = head.select(*keys, "_rn", "_off", F.col("_rn").alias("_t"))
        got = join_back(want, offers, keys + ["_t"]).filter(
            F.col("_src").isNotNull() & (F.col("_src") <= F.col("_off")))
        fix = got.groupBy(*keys, "_rn").agg(F.count("_v").alias("_xcnt"), *[
            F.sum(p).alias(f"_x{m}") for m, p in zip(names, how.pieces("_v"))])
        out = _attach(out, fix, keys).withColumns({
            "_mcnt": F.col("_mcnt") + F.coalesce(F.col("_xcnt"), F.lit(0)),
            **{m: F.coalesce(F.col(m) + F.col(f"_x{m}"), F.col(m), F.col(f"_x{m}")) for m in names}})
    out = how.attach(out, "_msum", [F.col(m) for m in names])
    mean = F.col("_msum").cast("double") / F.col("_mcnt")
    out = out.withColumn(name, F.when(F.col("_mcnt") > 0, mean))
    return out.select(*df.columns, name)


def top_n_per_group(df: DataFrame, keys, order, n: int, rn_name: str = "rn") -> DataFrame:
    """WIN-6 / WIN-18: ``ROW_NUMBER() <= n`` per group.

    The filter on a row number is planned with a partial ``WindowGroupLimit``
    before the shuffle, so at most n rows per key leave each map task and a hot
    key costs no more than any other.
    """
    keys = _keys(keys)
    order_k = parse_order(order)
    rn = F.row_number().over(_window(keys, order_k))
    return df.withColumn(rn_name, rn).filter(F.col(rn_name) <= n)
