"""Rule-based validation of raw order rows (all built-in column expressions).

A :class:`RuleSet` is an ordered list of checks plus a reporting mode:

* ``first``  - the first failing check's message (sequential validators);
* ``all``    - every failing check, joined with ``'; '`` (quarantine reasons);
* ``drop``   - like ``all``, but callers are expected to keep only valid rows.

Validation is a narrow transformation: one projection, no shuffle, inside
whole-stage codegen. The four upstream dialects are configurations
(:data:`LOCAL`, :data:`STAGING`, :data:`LAKEHOUSE`, :data:`EVENTS`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.json import raw_row_json
from ordermill.functions.text import blank, parse_int, parse_ts, text_or_none
from ordermill.schema import ALLOWED_STATUSES, ORDER_COLUMNS

ERRORS = "_errors"
MALFORMED = "_corrupt_record"
TYPED = ("_order_id", "_customer_id", "_status", "_amount_cents", "_updated_at")


@dataclass(frozen=True)
class Check:
    code: str
    failed: Callable[[], Column]          # TRUE when the row breaks the rule
    message: Callable[[], Column]         # text reported for the row


@dataclass(frozen=True)
class RuleSet:
    name: str
    checks: Sequence[Check]
    report: str = "all"                  # first | all | drop
    normalise: bool = False              # trim ids/status and upper-case status before checking and storing
    amount_bits: int = 64
    separator: str = "; "
    statuses: Sequence[str] = field(default=ALLOWED_STATUSES)
    malformed: str = "malformed_row"       # reported for rows with the wrong number of fields

    def typed_columns(self) -> dict[str, Column]:
        oid, cid, st = F.col("order_id"), F.col("customer_id"), F.col("status")
        if self.normalise:
            oid, cid, st = F.trim(oid), F.trim(cid), F.upper(F.trim(st))
        return {
            "_order_id": oid,
            "_customer_id": cid,
            "_status": st,
            "_amount_cents": parse_int("amount_cents", self.amount_bits).cast("bigint"),
            "_updated_at": parse_ts("updated_at"),
        }

    def error_column(self, malformed: bool = False) -> Column:
        parts = [F.when(ch.failed(), ch.message()) for ch in self.checks]
        if malformed:
            text = F.concat(text_or_none("order_id"), F.lit(": " + self.malformed)) if self.report == "first" \
                else F.lit(self.malformed)
            parts = [F.when(F.col(MALFORMED).isNotNull(), text)] + parts
        if self.report == "first":
            return F.coalesce(*parts, F.lit(""))
        return F.concat_ws(self.separator, *parts)


def apply_rules(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Add the typed columns ``_order_id .. _updated_at`` and ``_errors`` ('' when valid)."""
    typed = df.withColumns(rules.typed_columns())
    return typed.withColumn(ERRORS, rules.error_column(malformed=MALFORMED in df.columns))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two complementary filters over one checked frame (persist it once upstream)."""
    return checked.filter(F.col(ERRORS) == ""), checked.filter(F.col(ERRORS) != "")


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(ERRORS) == "")


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(ERRORS) != "")


def to_orders(valid: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed order rows (stored form of the dialect) plus chosen lineage columns."""
    return valid.select(
        F.col("_order_id").alias("order_id"),
        F.col("_customer_id").alias("customer_id"),
        F.col("_status").alias("status"),
        F.col("_amount_cents").alias("amount_cents"),
        F.col("_updated_at").alias("updated_at"),
        *keep,
    )


def to_rejects(rejected: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rejected-order records: raw key, message and the canonical raw-row JSON."""
    return rejected.select(
        "order_id",
        F.col(ERRORS).alias("error_message"),
        raw_row_json().alias("raw_row"),
        *keep,
    )


def to_quarantine(rejected: DataFrame, lineage: Sequence[str] = ("_source_file", "_ingested_at"),
                  stamp: bool = True) -> DataFrame:
    """Quarantine projection: raw text columns (and the raw text of malformed rows), lineage, reason, quarantine time."""
    raw = [MALFORMED] if MALFORMED in rejected.columns else []
    out = rejected.select(*ORDER_COLUMNS, *raw, *lineage, F.col(ERRORS).alias("_error_reason"))
    return out.withColumn("_quarantined_at", F.current_timestamp()) if stamp else out


# ---------------------------------------------------------------------------
# Dialects
# ---------------------------------------------------------------------------

def _col(name: str) -> Column:
    return F.col(name)


def _local_checks() -> list[Check]:
    """Sequential checks of the local batch pipeline, messages carry row values."""
    oid = lambda: text_or_none("order_id")
    checks = [
        Check(f"missing_{c}", (lambda c=c: blank(c, "any")),
              (lambda c=c: F.concat(oid(), F.lit(f": missing {c}"))))
        for c in ORDER_COLUMNS
    ]
    checks += [
        Check("invalid_status", lambda: ~_col("_status").isin(*ALLOWED_STATUSES),
              lambda: F.concat(oid(), F.lit(": invalid status "), text_or_none("status"))),
        Check("invalid_amount", lambda: _col("_amount_cents").isNull(),
              lambda: F.concat(oid(), F.lit(": invalid amount"))),
        Check("negative_amount", lambda: _col("_amount_cents") < 0,
              lambda: F.concat(oid(), F.lit(": negative amount "), _col("_amount_cents").cast("string"))),
        Check("invalid_updated_at", lambda: _col("_updated_at").isNull(),
              lambda: F.concat(oid(), F.lit(": invalid updated_at "), text_or_none("updated_at"))),
    ]
    return checks


def _staging_checks() -> list[Check]:
    """Normalised checks of the SQL staging procedures (messages, negative folded in)."""
    return [
        Check("missing_order_id", lambda: blank("order_id"), lambda: F.lit("order_id is missing")),
        Check("missing_customer_id", lambda: blank("customer_id"), lambda: F.lit("customer_id is missing")),
        Check("invalid_status", lambda: blank("status") | ~_col("_status").isin(*ALLOWED_STATUSES),
              lambda: F.lit("status is invalid")),
        Check("invalid_amount", lambda: _col("_amount_cents").isNull() | (_col("_amount_cents") < 0),
              lambda: F.lit("amount_cents is invalid")),
        Check("invalid_updated_at", lambda: _col("_updated_at").isNull(), lambda: F.lit("updated_at is invalid")),
    ]


def _coded_checks(min_exclusive: bool = False) -> list[Check]:
    """Coded checks of the lakehouse jobs (and, with amount > 0, of the event stream)."""
    amount_code = "non_positive_amount" if min_exclusive else "negative_amount"
    amount_bad = (lambda: _col("_amount_cents") <= 0) if min_exclusive else (lambda: _col("_amount_cents") < 0)
    return [
        Check("missing_order_id", lambda: blank("order_id"), lambda: F.lit("missing_order_id")),
        Check("missing_customer_id", lambda: blank("customer_id"), lambda: F.lit("missing_customer_id")),
        Check("invalid_status", lambda: _col("status").isNull() | ~_col("status").isin(*ALLOWED_STATUSES),
              lambda: F.lit("invalid_status")),
        Check("invalid_amount", lambda: _col("_amount_cents").isNull(), lambda: F.lit("invalid_amount")),
        Check(amount_code, amount_bad, lambda: F.lit(amount_code)),
        Check("invalid_updated_at", lambda: _col("_updated_at").isNull(), lambda: F.lit("invalid_updated_at")),
    ]


LOCAL = RuleSet("local", _local_checks(), report="first", malformed="malformed row")
STAGING = RuleSet("staging", _staging_checks(), report="all", normalise=True, amount_bits=32,
                  malformed="row is malformed")
LAKEHOUSE = RuleSet("lakehouse", _coded_checks(), report="all")
EVENTS = RuleSet("events", _coded_checks(min_exclusive=True), report="drop")

DIALECTS = {r.name: r for r in (LOCAL, STAGING, LAKEHOUSE, EVENTS)}


def rule_counts(checked: DataFrame, rules: RuleSet) -> dict[str, Column]:
    """Per-rule violation counters (not exclusive) as aggregate expressions."""
    return {f"{ch.code}_rows": F.sum(F.when(ch.failed(), 1).otherwise(0)).cast("bigint") for ch in rules.checks}
