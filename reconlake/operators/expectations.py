"""Data-quality expectations: drop, fail, warn, and their metrics.

A rule is a SQL boolean over the frame's columns. Semantics (decided where the
reference is silent): a rule evaluating to NULL counts as failed for drop and
warn; a fail rule aborts only on a definite false.

Metrics are one aggregate pass over the input (``count_if`` per rule, partial
aggregation on the map side, a single-row final), unpivoted into rows with
``stack``: no collect, no per-rule job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DROP, FAIL, WARN = "drop", "fail", "warn"


@dataclass(frozen=True)
class Rule:
    name: str
    sql: str
    action: str = WARN


# The usage and charge rules.
CDR_RULES = [
    Rule("valid_call_id", "call_id IS NOT NULL AND length(call_id) > 10", DROP),
    Rule("valid_msisdn", "msisdn IS NOT NULL AND length(msisdn) >= 10", DROP),
    Rule("valid_timestamp", "timestamp IS NOT NULL", DROP),
    Rule("no_future_dates", "timestamp_parsed <= current_timestamp()", FAIL),
    Rule("good_data_quality", "data_quality = 'GOOD'", WARN),
]
EDR_RULES = [
    Rule("valid_session_id", "session_id IS NOT NULL", DROP),
    Rule("valid_cdr_call_id", "cdr_call_id IS NOT NULL", DROP),
    Rule("valid_edr_msisdn", "msisdn IS NOT NULL", DROP),
    Rule("successful_billing", "billing_status = 'SUCCESS'", WARN),
]


def _passes(rule: Rule):
    return F.coalesce(F.expr(rule.sql), F.lit(False))


def apply(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Guard the fail rules, then filter by the drop rules; warn rules pass rows.

    The fail guard sees every row of the result, including rows a drop rule
    removes: a future-dated record aborts the run even if it is also invalid
    otherwise. It is a filter that is always true unless the rule is false,
    in which case ``raise_error`` aborts the job (batch or micro-batch)."""
    out = df
    for r in rules:
        if r.action == FAIL:
            msg = f"expectation '{r.name}' failed: {r.sql}"
            out = out.filter(F.when(~F.expr(r.sql), F.raise_error(F.lit(msg))).otherwise(F.lit(True)))
    drops = [r for r in rules if r.action == DROP]
    if drops:
        # a filter drops rows whose condition is NULL, so the bare rule already
        # treats NULL as failed; left unwrapped, its IS NOT NULL parts become
        # constraints the optimizer can use (and need not re-add elsewhere)
        cond = F.expr(drops[0].sql)
        for r in drops[1:]:
            cond = cond & F.expr(r.sql)
        out = out.filter(cond)
    return out


def metrics(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, action, passed, failed) for every rule over the same input rows."""
    aggs = []
    for i, r in enumerate(rules):
        ok = _passes(r)
        aggs.append(F.count_if(ok).alias(f"p{i}"))
        aggs.append(F.count_if(~ok).alias(f"f{i}"))
    one = df.agg(*aggs)
    parts = ", ".join(f"'{r.name}', '{r.action}', p{i}, f{i}" for i, r in enumerate(rules))
    return one.selectExpr(f"stack({len(rules)}, {parts}) AS (rule, action, passed, failed)")


def observe(df: DataFrame, rules: list[Rule], name: str = "expectations") -> DataFrame:
    """Streaming-friendly metrics: attach ``count_if`` observations to the
    frame; a ``StreamingQueryListener`` or ``Observation`` reads them."""
    cols = []
    for r in rules:
        ok = _passes(r)
        cols.append(F.count_if(ok).alias(f"{r.name}_passed"))
        cols.append(F.count_if(~ok).alias(f"{r.name}_failed"))
    return df.observe(name, *cols)
