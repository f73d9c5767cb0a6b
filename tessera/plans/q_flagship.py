"""Flagship: nearest as-of labelling (D3) on the events stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.asof import asof_nearest
from tessera.plans.fixtures import asof_sides
from tessera.plans.fixtures_sql import with_ctes
from tessera.plans.registry import query

ASOF_SQL = with_ctes("""
SELECT purchase_id, user_id, error_id, delta_us FROM (
  SELECT l.event_id AS purchase_id, l.user_id, r.event_id AS error_id,
         abs(epoch_us(r.ts) - epoch_us(l.ts)) AS delta_us,
         row_number() OVER (PARTITION BY l.event_id
            ORDER BY abs(epoch_us(r.ts) - epoch_us(l.ts)) NULLS LAST, r.ts, r.event_id) AS rn
  FROM asof_left l LEFT JOIN asof_right r ON l.user_id = r.user_id)
WHERE rn = 1""", "asof_left", "asof_right")


@query("d3_asof_nearest", ASOF_SQL)
def asof_events(spark, sf_dir):
    left, right = asof_sides(spark, sf_dir)
    left = left.select(F.col("event_id").alias("purchase_id"), "user_id", "ts")
    right = right.select("user_id", "ts", F.col("event_id").alias("error_id"))
    out = asof_nearest(left, right, by=["user_id"], on="ts", right_cols=["error_id"],
                       tie="error_id", delta_col="delta_us")
    return out.select("purchase_id", "user_id", "error_id", "delta_us")


ASOF_DAYS_SQL = with_ctes("""
SELECT purchase_id, user_id, error_id, matched_day, delta_days FROM (
  SELECT l.event_id AS purchase_id, l.user_id, r.event_id AS error_id,
         CAST(r.ts AS DATE) AS matched_day,
         CAST(abs(CAST(r.ts AS DATE) - CAST(l.ts AS DATE)) AS INTEGER) AS delta_days,
         row_number() OVER (PARTITION BY l.event_id
            ORDER BY abs(CAST(r.ts AS DATE) - CAST(l.ts AS DATE)) NULLS LAST,
                     CAST(r.ts AS DATE), r.event_id) AS rn
  FROM asof_left l LEFT JOIN asof_right r ON l.user_id = r.user_id)
WHERE rn = 1""", "asof_left", "asof_right")


@query("d3_asof_nearest_days", ASOF_DAYS_SQL)
def asof_days(spark, sf_dir):
    left, right = asof_sides(spark, sf_dir)
    left = left.select(F.col("event_id").alias("purchase_id"), "user_id",
                       F.col("ts").cast("date").alias("day"))
    right = right.select("user_id", F.col("ts").cast("date").alias("day"),
                         F.col("event_id").alias("error_id"),
                         F.col("ts").cast("date").alias("matched_day"))
    out = asof_nearest(left, right, by=["user_id"], on="day",
                       right_cols=["error_id", "matched_day"], tie="error_id",
                       delta_col="delta_days", bucket_width=4)
    return out.select("purchase_id", "user_id", "error_id", "matched_day",
                      F.col("delta_days").cast("int").alias("delta_days"))
