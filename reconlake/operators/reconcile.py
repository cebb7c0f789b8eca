"""Usage-to-charge matching: full outer interval join, calendar join, detail.

Match condition (inclusive both ends, one-sided window)::

    edr.cdr_call_id = cdr.call_id
    AND edr.msisdn_normalized = cdr.msisdn_normalized
    AND edr.timestamp_parsed BETWEEN cdr.timestamp_parsed AND cdr.timestamp_parsed + window

Batch plan (``strategy="split"``, default). A single full outer sort-merge join
cannot split a hot key: every row of a key that holds a third of the data
would meet in one task, and AQE's skew handling does not apply to full outer
joins. The result is therefore assembled from two joins that each can be
split, plus the rows that cannot match (NULL key or time):

* matched pairs and charges without usage: charge LEFT OUTER usage (the
  charge side, where a hot reference lives, is the streamed side, which AQE
  splits while replicating the usage partition);
* usage without charge: usage anti-joined (LEFT OUTER + no match) with a *pre-aggregated* charge presence
  table, min/max charge time per (key, window bucket). A charge lies in
  [t, t + w] iff bucket(t) holds one at or after t, or bucket(t) + 1 holds one
  at or before t + w, so the presence table has at most one row per key and
  window of time, whatever the number of charges per key. Partial aggregation
  shrinks it before its shuffle.

Both joins hash-partition the usage side on the same keys, so Spark reuses
that exchange: each side is shuffled once, plus the small presence table.

``strategy="fullouter"`` is the one-join form (used by the stream, where
Spark's symmetric hash join keeps state, and as a cross-check in tests).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Matching window, the 23 detail columns and the 12 calendar columns.
WINDOW_MINUTES = 15

CDR_OUT = [
    ("has_quality_issue", "cdr_has_quality_issue"),
    ("timestamp_parsed", "usage_timestamp"),
    ("msisdn", "cdr_msisdn"),
    ("data_quality", "cdr_data_quality"),
    ("call_id", "call_id"),
    ("service_type", "service_type"),
    ("status", "status"),
    ("_rescued_data", "cdr_rescued_data"),
    ("partition_date", "cdr_partition_date"),
]
EDR_OUT = [
    ("has_quality_issue", "edr_has_quality_issue"),
    ("timestamp_parsed", "billing_timestamp"),
    ("msisdn", "edr_msisdn"),
    ("data_quality", "edr_data_quality"),
    ("session_id", "session_id"),
    ("cdr_call_id", "edr_reference_to_cdr"),
    ("payment_method", "payment_method"),
    ("billing_status", "billing_status"),
    ("transaction_id", "transaction_id"),
]
CDR_DECIMALS = {"volume_decimal": "usage_volume", "expected_charge_decimal": "expected_charge"}
EDR_DECIMALS = {"charge_amount_decimal": "actual_charge"}
COMMON = ["business_date", "msisdn_normalized"]
# what the match reads of its inputs
CDR_IN = [*[src for src, _ in CDR_OUT], *CDR_DECIMALS, *COMMON]
EDR_IN = [*[src for src, _ in EDR_OUT], *EDR_DECIMALS, *COMMON]
DETAIL_ORDER = [
    "business_date", "msisdn_normalized", "cdr_has_quality_issue", "edr_has_quality_issue",
    "usage_timestamp", "billing_timestamp", "cdr_msisdn", "edr_msisdn", "cdr_data_quality",
    "edr_data_quality", "call_id", "service_type", "status", "cdr_rescued_data", "cdr_partition_date",
    "usage_volume", "expected_charge", "session_id", "edr_reference_to_cdr", "payment_method",
    "billing_status", "transaction_id", "actual_charge",
]
CALENDAR_OUT = [
    "date_key", "year", "month", "day_of_month", "day_of_week", "month_name", "quarter",
    "quarter_year", "week_of_year", "day_of_year", "is_weekday", "is_weekend",
]
# calendars up to this many days are broadcast (one small row per day)
MAX_BROADCAST_DAYS = 200_000


def _window(minutes: int) -> Column:
    return F.expr(f"INTERVAL {int(minutes)} MINUTES")


def condition(cdr: DataFrame, edr: DataFrame, minutes: int = WINDOW_MINUTES) -> Column:
    return ((edr["cdr_call_id"] == cdr["call_id"])
            & (edr["msisdn_normalized"] == cdr["msisdn_normalized"])
            & edr["timestamp_parsed"].between(cdr["timestamp_parsed"], cdr["timestamp_parsed"] + _window(minutes)))


def _side(df: DataFrame | None, mapping: list[tuple[str, str]], decimals: dict[str, str]) -> dict[str, Column]:
    """Output columns of one side; NULLs of the right type when the side is absent."""
    out = {dst: (df[src] if df is not None else F.lit(None)) for src, dst in mapping}
    for src, dst in decimals.items():
        out[dst] = df[src].cast("double") if df is not None else F.lit(None).cast("double")
    return out


def _project(c: DataFrame | None, e: DataFrame | None, types: dict[str, str],
             date_fallback: Column | None = None) -> list[Column]:
    cols = _side(c, CDR_OUT, CDR_DECIMALS)
    cols.update(_side(e, EDR_OUT, EDR_DECIMALS))
    for name in COMMON:
        present = [df[name] for df in (c, e) if df is not None]
        cols[name] = F.coalesce(*present) if len(present) > 1 else present[0]
    if date_fallback is not None:
        cols["business_date"] = F.coalesce(cols["business_date"], date_fallback)
    return [cols[n].cast(types[n]).alias(n) if n in types else cols[n].alias(n) for n in DETAIL_ORDER]


def _types(cdr: DataFrame, edr: DataFrame) -> dict[str, str]:
    t = {}
    for src, dst in CDR_OUT:
        t[dst] = cdr.schema[src].dataType.simpleString()
    for src, dst in EDR_OUT:
        t[dst] = edr.schema[src].dataType.simpleString()
    t["business_date"] = "date"
    t["msisdn_normalized"] = "string"
    return t


def presence(edr: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Min/max charge time per (call reference, normalised number, window bucket)."""
    w_us = int(minutes) * 60 * 1_000_000
    ts = F.col("timestamp_parsed")
    return (edr.where(F.col("cdr_call_id").isNotNull() & F.col("msisdn_normalized").isNotNull() & ts.isNotNull())
               .groupBy(F.col("cdr_call_id").alias("p_call_id"),
                        F.col("msisdn_normalized").alias("p_msisdn"),
                        F.floor(F.unix_micros(ts) / F.lit(w_us)).alias("p_bucket"))
               .agg(F.min(ts).alias("p_min"), F.max(ts).alias("p_max")))


def match(cdr: DataFrame, edr: DataFrame, minutes: int = WINDOW_MINUTES, strategy: str = "split") -> DataFrame:
    """Full outer interval match of usage and charge rows -> 23 detail columns."""
    types = _types(cdr, edr)
    if strategy == "fullouter":
        c, e = cdr.alias("cdr"), edr.alias("edr")
        j = c.join(e, condition(c, e, minutes), "full_outer")
        return j.select(*_project(c, e, types))
    if strategy != "split":
        raise ValueError(f"unknown strategy {strategy!r}")

    # Rows with a NULL key or time can never match: they go straight to the
    # outer parts. The keyed halves are then the same subtree in every branch,
    # so the optimizer's inferred not-null filters agree and the exchanges on
    # the join keys are reused instead of recomputed.
    ck, cn = _split_keyed(cdr, ["call_id", "msisdn_normalized", "timestamp_parsed"])
    ek, en = _split_keyed(edr, ["cdr_call_id", "msisdn_normalized", "timestamp_parsed"])
    c, e = ck.alias("cdr"), ek.alias("edr")

    # pairs + charges without usage: charge LEFT OUTER usage; the charge side
    # is streamed, so AQE can split a hot charge key (the usage partition is
    # replicated to the splits)
    pairs_and_edr_only = e.join(c, condition(c, e, minutes), "left_outer").select(*_project(c, e, types))

    w_us = int(minutes) * 60 * 1_000_000
    p = presence(ek, minutes).alias("p")
    ts = c["timestamp_parsed"]
    bucket = F.floor(F.unix_micros(ts) / F.lit(w_us))
    found = ((p["p_call_id"] == c["call_id"]) & (p["p_msisdn"] == c["msisdn_normalized"])
             & (((p["p_bucket"] == bucket) & (p["p_max"] >= ts))
                | ((p["p_bucket"] == bucket + 1) & (p["p_min"] <= ts + _window(minutes)))))
    # usage without charge: LEFT OUTER + "no presence row", an exact anti join.
    # The date is written as coalesce(usage date, presence date); the presence
    # side is NULL in every kept row, so the value is the usage date. Being an
    # expression of both join sides keeps the calendar's inferred not-null
    # filter above this join instead of in this branch's usage subtree, which
    # must stay identical to the other join's so its exchange is reused.
    unmatched = c.join(p, found, "left_outer").where(p["p_call_id"].isNull())
    cdr_only = unmatched.select(*_project(c, None, types, F.to_date(p["p_min"])))
    cn_, en_ = cn.alias("cdr"), en.alias("edr")
    return (pairs_and_edr_only.unionByName(cdr_only)
                 .unionByName(cn_.select(*_project(cn_, None, types)))
                 .unionByName(en_.select(*_project(None, en_, types))))


def _split_keyed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    return df.where(keyed), df.where(~keyed)


def calendar_join(rec: DataFrame, cal: DataFrame, days: int | None = None) -> DataFrame:
    """Inner join on business_date = date; drops dates outside the calendar and
    NULL dates; appends the 12 ``cal_`` columns.

    ``days`` is the calendar's row count when the caller knows it (one row per
    day of the range). Only then is the calendar broadcast, and only up to
    ``MAX_BROADCAST_DAYS``; otherwise Spark's size estimate decides."""
    broadcast = days is not None and days <= MAX_BROADCAST_DAYS
    side = cal.select(F.col("date").alias("__cal_date"), *[F.col(c).alias(f"cal_{c}") for c in CALENDAR_OUT])
    if broadcast:
        side = F.broadcast(side)
    return rec.join(side, rec["business_date"] == side["__cal_date"], "inner").drop("__cal_date")


def calendar_days(start: str | date, end: str | date) -> int:
    s = date.fromisoformat(str(start))
    e = date.fromisoformat(str(end))
    return max(0, (e - s).days + 1)


