"""Data-quality reports, reconciliation and gates.

Each check is computed by one aggregate pass (partial + final), then turned
into rows ``(check, passed)``. One-row aggregates are combined with scalar
subqueries, not joins. Only the handful of check rows ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import blank
from ordermill.operators.dedupe import surplus_duplicates
from ordermill.operators.joins import missing_parents
from ordermill.operators.merge import SIGN
from ordermill.operators.metrics import daily_metrics, total_metric_columns
from ordermill.operators.rules import ERRORS, STAGING, RuleSet, apply_rules, rule_counts
from ordermill.schema import ALLOWED_STATUSES


class QualityError(AssertionError):
    """Raised by :func:`enforce` with the names of the failed checks."""


def check_rows(*checks: tuple[str, Column]) -> Column:
    """Array-of-struct expression exploded into rows (check, passed)."""
    return F.inline(F.array(*[F.struct(F.lit(name).alias("check"),
                                       F.coalesce(cond, F.lit(False)).alias("passed"))
                              for name, cond in checks]))


def enforce(checks: DataFrame) -> list[str]:
    """Raise :class:`QualityError` listing failed checks; returns the passed ones."""
    rows = checks.select("check", "passed").collect()      # a few rows, by construction
    failed = [r["check"] for r in rows if not r["passed"]]
    if failed:
        raise QualityError("data quality failed: " + ", ".join(failed))
    return [r["check"] for r in rows]


def combine_one_row(*aggs: DataFrame) -> DataFrame:
    """Put several one-row aggregates side by side without a join or subquery:
    pad each with NULL columns, union them (a few rows) and take max per column."""
    cols = [c for a in aggs for c in a.columns]
    if len(set(cols)) != len(cols):
        raise ValueError("column names of one-row aggregates must be distinct")
    padded = [a.select(*[F.col(c) if c in a.columns else F.lit(None).alias(c) for c in cols]) for a in aggs]
    u = padded[0]
    for p in padded[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.max(c).alias(c) for c in cols])


# -- D5 / AG9 / AG6 -----------------------------------------------------------

def dq_report(raw: DataFrame, rules: RuleSet = STAGING, by: Sequence[str] = ()) -> DataFrame:
    """Rule counters per ``by`` group (one row when empty) plus surplus duplicates
    and ``dq_status`` (PASS only with no rejects and no duplicates)."""
    checked = apply_rules(raw, rules)
    counters = rule_counts(checked, rules)
    agg = checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(F.col(ERRORS) != "", 1).otherwise(0)).cast("bigint").alias("rejected_rows"),
        *[c.alias(n) for n, c in counters.items()])
    agg = agg.select(*by, "total_rows", (F.col("total_rows") - F.col("rejected_rows")).alias("valid_rows"),
                     "rejected_rows", *counters.keys())
    dups = surplus_duplicates(raw, "order_id", by)
    if by:
        out = agg.join(dups, list(by), "left")
    else:
        out = agg.withColumn("duplicate_order_id_rows", dups.scalar())
    out = out.withColumn("duplicate_order_id_rows", F.coalesce("duplicate_order_id_rows", F.lit(0)).cast("bigint"))
    status = F.when((F.col("rejected_rows") == 0) & (F.col("duplicate_order_id_rows") == 0), "PASS").otherwise("WARN")
    return out.withColumn("dq_status", status)


def run_report(raw: DataFrame, rules: RuleSet, run_id: str, file_pattern: str) -> DataFrame:
    """One report row of a run: its id, the file pattern, the counters and the check time."""
    return dq_report(raw, rules).select(F.lit(run_id).alias("run_id"), F.lit(file_pattern).alias("source_file_pattern"), "*",
                                        F.current_timestamp().alias("checked_at"))


# -- D1 / W4 ------------------------------------------------------------------

def conservation(checked: DataFrame, key: str = "_order_id") -> DataFrame:
    """Counts bronze = silver + quarantine + superseded, in one aggregate.

    ``silver`` is the number of distinct keys among valid rows (what a
    latest-per-key pass keeps), so ``superseded = valid - silver`` needs no window.
    """
    valid = F.col(ERRORS) == ""
    agg = checked.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.sum(F.when(valid, 1).otherwise(0)).cast("bigint").alias("valid_rows"),
        F.sum(F.when(~valid, 1).otherwise(0)).cast("bigint").alias("quarantine_rows"),
        F.count_distinct(F.when(valid, F.col(key))).alias("silver_rows"))
    agg = agg.select("*", (F.col("valid_rows") - F.col("silver_rows")).alias("superseded_rows"))
    return agg.withColumn("balanced", F.col("bronze_rows") ==
                          F.col("silver_rows") + F.col("quarantine_rows") + F.col("superseded_rows"))




def reconcile_daily(silver: DataFrame, gold: DataFrame | None = None, amount: str = "amount_cents") -> DataFrame:
    """Silver vs daily gold: counts, amounts, status split, unique dates.

    Without a stored ``gold`` it is derived from ``silver`` here, and both sides come out of one
    aggregation by date (silver is scanned once).
    """
    if gold is None:
        gold = daily_metrics(silver, amount=amount, extra=(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_sum")))
        s_cols = (F.coalesce(F.sum("_n"), F.lit(0)).alias("s_orders"), F.coalesce(F.sum("_sum"), F.lit(0)).alias("s_amount"))
    else:
        s_cols = ()
    g = gold.agg(*s_cols, F.coalesce(F.sum("total_orders"), F.lit(0)).alias("g_orders"),
                 F.coalesce(F.sum("total_amount_cents"), F.lit(0)).alias("g_amount"),
                 F.sum(F.when(F.col("total_orders") != F.col("paid_orders") + F.col("shipped_orders")
                              + F.col("pending_orders") + F.col("cancelled_orders"), 1).otherwise(0)).alias("bad_split"),
                 (F.count(F.lit(1)) - F.count_distinct("report_date")).alias("dup_dates"))
    if not s_cols:
        s = silver.agg(F.count(F.lit(1)).alias("s_orders"), F.coalesce(F.sum(amount), F.lit(0)).alias("s_amount"))
        g = combine_one_row(s, g)
    return g.select(check_rows(
        ("gold order count equals silver", F.col("g_orders") == F.col("s_orders")),
        ("gold amount equals silver", F.col("g_amount") == F.col("s_amount")),
        ("status split adds up per day", F.coalesce(F.col("bad_split"), F.lit(0)) == 0),
        ("report dates are unique", F.col("dup_dates") == 0)))


def gained_gate(before: DataFrame, gold: DataFrame, signed: DataFrame, amount: str = "amount_cents") -> DataFrame:
    """Daily gold against the signed rows that it was brought up to date with: counts, amounts, status split, unique dates.

    Reads gold before and after and the change rows, never the orders behind them.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    b = before.agg(total("total_orders").alias("b_orders"), total("total_amount_cents").alias("b_amount"))
    s = signed.agg(total(SIGN).alias("s_orders"), total(F.col(SIGN) * F.coalesce(F.col(amount), F.lit(0))).alias("s_amount"))
    g = gold.agg(total("total_orders").alias("g_orders"), total("total_amount_cents").alias("g_amount"),
                 total(F.when(F.col("total_orders") != F.col("paid_orders") + F.col("shipped_orders")
                              + F.col("pending_orders") + F.col("cancelled_orders"), 1).otherwise(0)).alias("bad_split"),
                 total(F.when(F.col("total_orders") <= 0, 1).otherwise(0)).alias("empty_dates"),
                 (F.count(F.lit(1)) - F.count_distinct("report_date")).alias("dup_dates"))
    return combine_one_row(b, s, g).select(check_rows(
        ("gold order count gained the changed rows", F.col("g_orders") == F.col("b_orders") + F.col("s_orders")),
        ("gold amount gained the changed rows", F.col("g_amount") == F.col("b_amount") + F.col("s_amount")),
        ("status split adds up per day", F.col("bad_split") == 0),
        ("every date has orders", F.col("empty_dates") == 0),
        ("report dates are unique", F.col("dup_dates") == 0)))


# -- D4 -------------------------------------------------------------------------

def event_gate(silver: DataFrame, gold: DataFrame | None = None, statuses: Sequence[str] = ALLOWED_STATUSES) -> DataFrame:
    """Five checks between the event silver table and its total-metrics row.

    Without a stored ``gold`` row its metrics are part of the same aggregate (silver is scanned once).
    """
    invalid = (blank(F.coalesce("order_id", F.lit(""))) | blank(F.coalesce("customer_id", F.lit("")))
               | F.col("status").isNull() | ~F.col("status").isin(*statuses)
               | F.col("amount_cents").isNull() | (F.col("amount_cents") <= 0) | F.col("updated_at").isNull())
    status_total = sum((F.col(f"{x.lower()}_orders") for x in statuses), F.lit(0))
    totals = () if gold is not None else total_metric_columns()
    s = silver.agg(*totals, F.count(F.lit(1)).alias("silver_rows"),
                   F.count_distinct("order_id").alias("distinct_order_ids"),
                   F.coalesce(F.sum("amount_cents"), F.lit(0)).alias("silver_total_amount"),
                   F.coalesce(F.sum(F.when(invalid, 1).otherwise(0)), F.lit(0)).alias("invalid_rows"))
    if gold is None:
        both = s.withColumns({"g_orders": F.col("total_orders"), "g_amount": F.col("total_amount_cents"),
                              "g_status_total": status_total})
    else:
        both = combine_one_row(s, gold.agg(F.coalesce(F.sum("total_orders"), F.lit(0)).alias("g_orders"),
                                           F.coalesce(F.sum("total_amount_cents"), F.lit(0)).alias("g_amount"),
                                           F.coalesce(F.sum(status_total), F.lit(0)).alias("g_status_total")))
    return both.select(check_rows(
        ("silver order ids are unique", F.col("silver_rows") == F.col("distinct_order_ids")),
        ("silver has no invalid rows", F.col("invalid_rows") == 0),
        ("gold total_orders matches silver", F.col("g_orders") == F.col("silver_rows")),
        ("gold total_amount matches silver", F.col("g_amount") == F.col("silver_total_amount")),
        ("status counts add up to total_orders", F.col("g_status_total") == F.col("g_orders"))))


# -- D6 / D7 / J-S: generic column tests return the violating rows --------------

def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def test_unique(df: DataFrame, column: str) -> DataFrame:
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def test_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose non-NULL value is outside ``values``."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def test_relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    return missing_parents(child, parent, column, field)


def test_expression_false(df: DataFrame, condition: Column) -> DataFrame:
    """Singular test: rows breaking ``condition`` (e.g. non-negative amounts)."""
    return df.filter(~F.coalesce(condition, F.lit(True)))
