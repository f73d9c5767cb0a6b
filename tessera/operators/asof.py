"""Nearest-value as-of join (D3).

For every left row pick the right row with the same key whose ``on`` value is
nearest: an exact match first, otherwise the minimum absolute difference,
the *earlier* right value on ties, then the smallest ``tie`` column. Left rows
with an unknown key or a null ``on`` get nulls. With a tolerance, payload
columns beyond it are nulled but the matched value and delta are kept.

Scale form (no pair blow-up, no hot-key task): left and right rows are unioned
and cut into (key, time-bucket) window partitions, so one key holding a third
of all rows still spreads over many tasks. Buckets with more rows than one task
should have are cut again, and again, by measured counts, down to single values;
rows that share a key and a value are then few, as such left rows are asked once
and of such right rows the first by ``tie`` counts. Inside a bucket the nearest right
row before / after each left row is a running max / min over the two sort
orders. Left rows whose bucket holds no candidate on one side take it from a
per-(key, bucket) summary of the right side, carried across buckets by a
window over that summary (one row per key and bucket, so it stays small).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

DAY_US = 86_400_000_000
#: Rows of a bucket beyond which it is cut, and into how many parts at a time.
BUCKET_ROWS, CUT = 200_000, 16


def ordinal(df: DataFrame, col: str) -> Column:
    """Orderable long for a date (days) or timestamp (microseconds) column."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(col)).cast("long")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    return F.col(col).cast("long")


def default_bucket_width(df: DataFrame, col: str) -> int:
    dt = df.schema[col].dataType
    if isinstance(dt, T.DateType):
        return 64                      # days
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return DAY_US                  # one day of microseconds
    return 1 << 20


def asof_nearest(left: DataFrame, right: DataFrame, by: list[str], on: str,
                 right_cols: list[str], tie: str | None = None,
                 tolerance: int | None = None, null_beyond: list[str] | None = None,
                 bucket_width: int | None = None, delta_col: str = "delta",
                 right_on: str | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Left columns + ``right_cols`` of the nearest right row + ``delta_col``
    (absolute difference in ordinal units: days for dates, µs for timestamps).
    ``right_cols`` must not clash with left column names."""
    # A null key meets nothing: such left rows pass by with nulls, and never share a window.
    known = F.lit(True)
    for k in by:
        known = known & F.col(k).isNotNull()
    unkeyed, left, right = left.filter(~known), left.filter(known), right.filter(known)
    ron = right_on or on
    width = bucket_width or default_bucket_width(right, ron)
    widths = _widths(left.select(*by, ordinal(left, on).alias("_o")).unionByName(right.select(*by, ordinal(right, ron).alias("_o"))), by, width, bucket_rows)
    if widths is not None:
        return _asof_dense(left, right, by, on, right_cols, tie, tolerance, null_beyond, width, widths, delta_col, ron).unionByName(
            _unmatched(unkeyed, right, right_cols, delta_col))
    return _asof(left, right, by, on, right_cols, tie, tolerance, null_beyond, width, None, delta_col, ron).unionByName(
        _unmatched(unkeyed, right, right_cols, delta_col))


def _unmatched(rows: DataFrame, right: DataFrame, right_cols: list[str], delta_col: str) -> DataFrame:
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols]
    return rows.select("*", *nothing, F.lit(None).cast("long").alias(delta_col))


def _widths(points: DataFrame, by: list[str], width: int, most: int) -> DataFrame | None:
    """(by, _b, _w): the buckets of ``points`` (by, _o) that hold more than ``most`` rows, each with the width its rows are to
    be cut by, found by counting; None if no bucket is so large. Each turn counts only what is still too large."""
    found, parts = None, points.filter(F.col("_o").isNotNull()).select(*by, (F.floor(F.col("_o") / width) * width).alias("_b"), "_o", (F.floor(F.col("_o") / width) * width).alias("_top"))
    while width > 1:
        counts = parts.groupBy(*by, "_top", "_b").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
        counts = cut_lineage(counts.select(*by, "_top", "_b"), "dense")
        if counts.isEmpty():
            break
        width = max(1, width // CUT)
        tops = counts.select(*by, "_top").distinct().withColumn("_w", F.lit(width).cast("long"))
        found = tops if found is None else found.unionByName(tops)
        parts = parts.join(counts, [*by, "_top", "_b"]).withColumn("_b", F.floor(F.col("_o") / width) * width)
    if found is None:
        return None
    return cut_lineage(found.groupBy(*by, F.col("_top").alias("_b")).agg(F.min("_w").alias("_w")), "widths")


def _bucket(df: DataFrame, by: list[str], width: int, widths: DataFrame | None) -> DataFrame:
    """``df`` (by, _o, ...) with its bucket _b: where ``_o`` is rounded down to, by the width of its bucket."""
    df = df.withColumn("_b", F.floor(F.col("_o") / width) * width)
    if widths is None:
        return df
    return df.join(widths, [*by, "_b"], "left").withColumn("_b", F.when(F.col("_w").isNotNull(), F.floor(F.col("_o") / F.col("_w")) * F.col("_w")).otherwise(F.col("_b"))).drop("_w")


def _asof_dense(left, right, by, on, right_cols, tie, tolerance, null_beyond, width, widths, delta_col, ron) -> DataFrame:
    """``_asof`` where rows crowd: every (key, value) of the left side is asked once, of right rows with one (key, value) the
    first by ``tie`` takes part, and the answers are joined back."""
    first = F.min_by(F.struct(*[F.col(c).alias(c) for c in dict.fromkeys([ron, *right_cols, *([tie] if tie else [])])]), F.col(tie).cast("long") if tie else F.lit(0))
    r = right.withColumn("_ro", ordinal(right, ron)).groupBy(*by, "_ro").agg(first.alias("_r")).select(*by, "_r.*")
    l = left.withColumn("_lo", ordinal(left, on))
    asked = l.filter(F.col("_lo").isNotNull()).select(*by, "_lo").distinct()
    answers = _asof(asked, r, by, "_lo", right_cols, tie, tolerance, null_beyond, width, widths, delta_col, ron)
    return l.join(answers, [*by, "_lo"], "left").select(*left.columns, *right_cols, delta_col)


def _asof(left, right, by, on, right_cols, tie, tolerance, null_beyond, width, widths, delta_col, ron) -> DataFrame:
    lcols = left.columns
    tie_c = F.col(tie).cast("long") if tie else F.lit(0).cast("long")
    pay = [F.col(c) for c in right_cols]

    r = right.select(*[F.col(k) for k in by], ordinal(right, ron).alias("_o"),
                     tie_c.alias("_t"), *pay).filter(F.col("_o").isNotNull())
    r = _bucket(r, by, width, widths)
    r = r.select(*by, "_b", F.lit(0).alias("_side"), "_o",
                 F.struct(F.col("_o").alias("o"), (-F.col("_t")).alias("nt"),
                          *[F.col(c) for c in right_cols]).alias("_rmax"),
                 F.struct(F.col("_o").alias("o"), F.col("_t").alias("t"),
                          *[F.col(c) for c in right_cols]).alias("_rmin"),
                 F.lit(None).cast(left.select(F.struct(*lcols)).schema[0].dataType).alias("_l"))
    lo = ordinal(left, on)
    l = _bucket(left.select(*[F.col(k) for k in by], lo.alias("_o"), F.struct(*lcols).alias("_l")), by, width, widths)
    l = l.select(*by, "_b", F.lit(1).alias("_side"), "_o",
                 F.lit(None).cast(r.schema["_rmax"].dataType).alias("_rmax"),
                 F.lit(None).cast(r.schema["_rmin"].dataType).alias("_rmin"), "_l")
    u = l.unionByName(r)

    part = [*by, "_b"]
    w_up = (Window.partitionBy(*part).orderBy(F.col("_o").asc(), F.col("_side").asc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_dn = (Window.partitionBy(*part).orderBy(F.col("_o").desc(), F.col("_side").asc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = (u.withColumn("_prev", F.max("_rmax").over(w_up))
          .withColumn("_next", F.min("_rmin").over(w_dn))
          .filter(F.col("_side") == 1))

    # per (key, bucket) summary of the right side, carried over empty buckets
    s = (r.groupBy(*part).agg(F.max("_rmax").alias("_bmax"), F.min("_rmin").alias("_bmin"))
          .unionByName(l.select(*part).distinct()
                        .withColumn("_bmax", F.lit(None).cast(r.schema["_rmax"].dataType))
                        .withColumn("_bmin", F.lit(None).cast(r.schema["_rmin"].dataType)))
          .groupBy(*part).agg(F.max("_bmax").alias("_bmax"), F.min("_bmin").alias("_bmin")))
    w_before = Window.partitionBy(*by).orderBy(F.col("_b").asc()).rowsBetween(
        Window.unboundedPreceding, -1)
    w_after = Window.partitionBy(*by).orderBy(F.col("_b").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    s = (s.withColumn("_pfill", F.last("_bmax", ignorenulls=True).over(w_before))
          .withColumn("_nfill", F.last("_bmin", ignorenulls=True).over(w_after))
          .select(*part, "_pfill", "_nfill"))

    j = u.join(s, part, "left")
    prev = F.coalesce(F.col("_prev"), F.col("_pfill"))
    nxt = F.coalesce(F.col("_next"), F.col("_nfill"))
    d_prev = F.col("_o") - prev["o"]
    d_next = nxt["o"] - F.col("_o")
    take_prev = nxt.isNull() | (prev.isNotNull() & (d_prev <= d_next))
    chosen = F.when(F.col("_o").isNull(), F.lit(None)).when(
        take_prev, F.struct(prev["o"].alias("o"), *[prev[c].alias(c) for c in right_cols])
    ).otherwise(F.struct(nxt["o"].alias("o"), *[nxt[c].alias(c) for c in right_cols]))
    j = j.select("_l", "_o", chosen.alias("_c"))
    delta = F.abs(F.col("_c.o") - F.col("_o"))
    out = [F.col(f"_l.{c}").alias(c) for c in lcols]
    for c in right_cols:
        v = F.col(f"_c.{c}")
        if tolerance is not None and c in (null_beyond or []):
            v = F.when(delta <= tolerance, v)
        out.append(v.alias(c))
    out.append(delta.alias(delta_col))
    return j.select(*out)


def asof_nearest_small(left: DataFrame, right: DataFrame, by: list[str], on: str,
                       right_cols: list[str], tie: str | None = None,
                       delta_col: str = "delta") -> DataFrame:
    """Reference form for small inputs and tests: join on key, rank by
    (|diff|, right value, tie). Quadratic per key -- not for hot keys."""
    lid = "_lid"
    lft = left.withColumn(lid, F.monotonically_increasing_id()).withColumn("_lo", ordinal(left, on))
    rgt = right.select(*[F.col(k).alias(f"_r_{k}") for k in by], ordinal(right, on).alias("_ro"),
                       (F.col(tie).cast("long") if tie else F.lit(0).cast("long")).alias("_rt"),
                       *right_cols).filter(F.col("_ro").isNotNull())
    cond = [lft[k] == rgt[f"_r_{k}"] for k in by]
    j = lft.join(rgt, cond + [lft["_lo"].isNotNull()], "left")
    d = F.abs(F.col("_ro") - F.col("_lo"))
    w = Window.partitionBy(lid).orderBy(d.asc_nulls_last(), F.col("_ro"), F.col("_rt"))
    j = j.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return j.select(*left.columns, *right_cols, d.alias(delta_col))
