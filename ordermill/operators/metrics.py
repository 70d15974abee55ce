"""Order metrics: daily, total and per-status.

All are single hash aggregates with map-side partial aggregation, so a date or
status holding a third of the rows is combined per map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.money import cents_to_amount
from ordermill.operators.merge import SIGN
from ordermill.schema import ALLOWED_STATUSES


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def status_counts(status: str = "status", statuses: Sequence[str] = ALLOWED_STATUSES) -> list[Column]:
    return [_count_if(F.col(status) == s).alias(f"{s.lower()}_orders") for s in statuses]


def daily_metrics(orders: DataFrame, ts: str = "updated_at", amount: str = "amount_cents",
                  status: str = "status", stamp: bool = False, extra: Sequence[Column] = ()) -> DataFrame:
    """Per day: total_orders, total_amount_cents, per-status counts, paid_amount_cents (and ``extra`` aggregates)."""
    out = (orders.groupBy(F.to_date(F.col(ts)).alias("report_date"))
           .agg(F.count(F.lit(1)).alias("total_orders"),
                F.sum(amount).cast("bigint").alias("total_amount_cents"),
                _count_if(F.col(status) == "PAID").alias("paid_orders"),
                _count_if(F.col(status) == "SHIPPED").alias("shipped_orders"),
                _count_if(F.col(status) == "PENDING").alias("pending_orders"),
                _count_if(F.col(status) == "CANCELLED").alias("cancelled_orders"),
                F.sum(F.when(F.col(status) == "PAID", F.col(amount)).otherwise(0)).cast("bigint")
                .alias("paid_amount_cents"), *extra))
    return out.withColumn("_calculated_at", F.current_timestamp()) if stamp else out


def daily_metrics_display(gold: DataFrame) -> DataFrame:
    """Daily metrics with amounts in currency units, rounded to cents."""
    return gold.select("report_date", "total_orders",
                       cents_to_amount("total_amount_cents", 2).alias("total_amount_eur"),
                       "paid_orders", "shipped_orders", "pending_orders", "cancelled_orders",
                       cents_to_amount("paid_amount_cents", 2).alias("paid_amount_eur"))


def total_metric_columns(amount: str = "amount_cents", status: str = "status") -> list[Column]:
    return [F.count(F.lit(1)).alias("total_orders"),
            F.coalesce(F.sum(amount), F.lit(0)).cast("bigint").alias("total_amount_cents"),
            *[F.coalesce(_count_if(F.col(status) == s), F.lit(0)).cast("bigint").alias(f"{s.lower()}_orders")
              for s in ALLOWED_STATUSES]]


def total_metrics(orders: DataFrame, amount: str = "amount_cents", status: str = "status",
                  stamp: bool = False) -> DataFrame:
    """One row over all orders. Totals are 0 on empty input (not NULL)."""
    out = orders.agg(*total_metric_columns(amount, status))
    return out.withColumn("refreshed_at", F.current_timestamp()) if stamp else out


def with_amount(orders: DataFrame, cents: str = "amount_cents") -> DataFrame:
    """Add ``amount`` (currency units, DOUBLE)."""
    return orders.withColumn("amount", cents_to_amount(cents))


def status_summary(orders: DataFrame, statuses: DataFrame, amount: str = "amount") -> DataFrame:
    """Per status: label (left join to the dimension), order_count, total_amount.

    Aggregates first (partial + final) and joins the label afterwards: the
    result equals grouping the joined rows by (status, label), and the join
    then only sees one row per status.
    """
    per_status = orders.groupBy("status").agg(F.count(F.lit(1)).alias("order_count"),
                                              F.sum(amount).alias("total_amount"))
    joined = per_status.join(statuses, "status", "left")
    return joined.select("status", "status_label", "order_count", "total_amount")


# ---------------------------------------------------------------------------
# Invertible aggregates, kept up to date from signed change rows alone
# ---------------------------------------------------------------------------

def _signed(value: Column | None = None, only: Column | None = None) -> Column:
    """Sum of ``_sign`` (times ``value``) over the rows that meet ``only``; nulls count as 0."""
    term = F.col(SIGN) if value is None else F.col(SIGN) * F.coalesce(value, F.lit(0))
    return F.sum(term if only is None else F.when(only, term).otherwise(0)).cast("bigint")


def signed_daily(signed: DataFrame, ts: str = "updated_at", amount: str = "amount_cents", status: str = "status") -> DataFrame:
    """What daily metrics gain from signed rows, per day (the columns of :func:`daily_metrics`)."""
    st = F.col(status)
    return signed.groupBy(F.to_date(F.col(ts)).alias("report_date")).agg(
        _signed().alias("total_orders"), _signed(F.col(amount)).alias("total_amount_cents"),
        *[_signed(only=st == s).alias(f"{s.lower()}_orders") for s in ("PAID", "SHIPPED", "PENDING", "CANCELLED")],
        _signed(F.col(amount), st == "PAID").alias("paid_amount_cents"))


def signed_totals(signed: DataFrame, amount: str = "amount_cents", status: str = "status") -> DataFrame:
    """What total metrics gain from signed rows (one row)."""
    return signed.agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in (
        ("total_orders", _signed()), ("total_amount_cents", _signed(F.col(amount))),
        *[(f"{s.lower()}_orders", _signed(only=F.col(status) == s)) for s in ALLOWED_STATUSES])])


def signed_by_status(signed: DataFrame, amount: str = "amount_cents") -> DataFrame:
    """What the order count and the cents of each status gain from signed rows."""
    return signed.groupBy("status").agg(_signed().alias("order_count"), _signed(F.col(amount)).alias("total_cents"))


def add_signed(gold: DataFrame, gain: DataFrame, by: Sequence[str] = (), rows: str | None = None) -> DataFrame:
    """``gold`` plus a gain of the same columns, per group of ``by``; groups whose ``rows`` reach 0 disappear.

    Neither side reads the table behind the aggregate: the cost follows the gold rows and the batch.
    """
    cols = [c for c in gold.columns if c not in by]
    out = (gold.select(*by, *cols).unionByName(gain.select(*by, *cols)).groupBy(*by)
           .agg(*[F.sum(c).cast("bigint").alias(c) for c in cols]))
    return out if rows is None else out.filter(F.col(rows) != 0)


def refresh_daily_metrics(gold: DataFrame, before: DataFrame, changes: DataFrame, after: DataFrame,
                          keys=("order_id",), ts: str = "updated_at") -> DataFrame:
    """Daily metrics after a change set, recomputing only the dates it touched.

    Touched dates are the new dates of the changed rows and the old dates of the
    rows they replaced (``before`` semi-joined to the changed keys). Those dates are
    recomputed from ``after``; every other date keeps its gold row. A date left
    without orders disappears, exactly as in a full recompute. ``changes`` should be a
    stored table (it is read twice); AQE broadcasts the dates if they are few. For repairs;
    :func:`add_signed` needs no scan of the orders.
    """
    key_cols = list(keys)
    changed_keys = changes.select(*key_cols)
    touched = (changes.select(F.to_date(ts).alias("report_date"))
               .unionByName(before.join(changed_keys, key_cols, "left_semi").select(F.to_date(ts).alias("report_date")))
               .distinct())
    recomputed = daily_metrics(after.join(touched, F.to_date(after[ts]) == touched["report_date"], "left_semi"))
    kept = gold.join(touched, "report_date", "left_anti")
    return kept.select(*recomputed.columns).unionByName(recomputed)
