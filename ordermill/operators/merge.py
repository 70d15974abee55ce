"""Merges of a batch into a keyed target, as pure DataFrame functions.

Functions return data instead of mutating a table: the *next* target state
(``upsert``, ``insert_only``), only the rows that change it (``upsert_changes``,
``new_rows``), or the state with change rows applied (``apply_changes``);
``ordermill.plans.store`` commits them. Plain parquet cannot ``MERGE INTO``; with
Delta Lake present the same conditions map onto ``DeltaTable.merge``.

Scale notes
-----------
* Upserts first reduce the batch to one row per key (partial WindowGroupLimit,
  so hot keys shrink map-side), then join it with the target. Both sides are
  unique per key, so the join cannot fan out and no key can skew it.
* ``upsert`` rewrites the whole state (one full outer join: rebuilds);
  ``upsert_changes`` reads only key + compare columns of the target, filtered to
  the batch's keys, and yields only inserts and winning updates (incremental
  loads and streams); stores rewrite only the key buckets they fall into.
* Insert-only merges are hash left-anti joins (also with null-safe keys) against a
  target bounded by the batch; long texts are met by a stored digest first.
* Which side is broadcast is left to AQE (runtime sizes), never forced on data
  whose size grows with the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.operators.dedupe import latest_per_key

CHANGE, SIGN, DIGEST = "_change", "_sign", "_digest"
KEEP, INSERT, UPDATE, STALE = "keep", "insert", "update", "stale"


def newer(src: dict[str, Column], tgt: dict[str, Column], compare: Sequence[str], cmp: str = ">") -> Column:
    """Lexicographic 'source beats target' over ``compare`` columns.

    ``cmp`` applies to the last column (``'>'`` strict, ``'>='`` ties go to the source);
    earlier columns break ties only on equality. NULL comparisons are FALSE.
    """
    cond = None
    for i in reversed(range(len(compare))):
        c = compare[i]
        s, t = src[c], tgt[c]
        here = (s >= t) if (i == len(compare) - 1 and cmp == ">=") else (s > t)
        cond = here if cond is None else (here | ((s == t) & cond))
    return F.coalesce(cond, F.lit(False))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None,
           cmp: str = ">", source_order: Sequence | None = None, dedupe_source: bool = True,
           null_safe: bool = False) -> DataFrame:
    """Upsert ``source`` into ``target`` on ``keys``; returns next state with ``_change``.

    * ``compare=None`` - the source always wins (update-else-insert by id);
    * ``compare=[c]``, ``cmp='>'`` - update only when strictly newer (ties keep target);
    * ``cmp='>='`` - newer or equal wins;
    * ``compare=[c1, c2]`` - two-level tie-break (newer c1, or equal c1 and newer c2).

    The source is first reduced to its best row per key (``source_order``,
    defaulting to ``compare`` descending). ``_change`` is keep | insert | update | stale.
    Target rows are assumed unique per key (the invariant this function keeps).

    Keys are validated ids, so the join uses plain equality: the join then reuses
    the hash partitioning of the source ranking (and of a target ranked or
    bucketed on the same key) instead of shuffling both sides again.
    ``null_safe=True`` matches NULL keys too, at the price of that extra shuffle.
    """
    cols = [c for c in target.columns if c != CHANGE]
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    src = source.select(*cols)
    if dedupe_source:
        order = list(source_order or compare or [])
        if not order:
            raise ValueError("a source ordering is needed to pick one row per key")
        src = latest_per_key(src, keys, order)
    t = target.select(*cols, F.lit(True).alias("_in_tgt")).alias("t")
    s = src.select(*cols, F.lit(True).alias("_in_src")).alias("s")
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    joined = t.join(s, [eq(F.col(f"t.{k}"), F.col(f"s.{k}")) for k in keys], "full_outer")
    t_has = F.col("t._in_tgt").isNotNull()
    s_has = F.col("s._in_src").isNotNull()
    s_map = {c: F.col(f"s.{c}") for c in cols}
    t_map = {c: F.col(f"t.{c}") for c in cols}
    wins = F.lit(True) if not compare else newer(s_map, t_map, compare, cmp)
    change = (F.when(~t_has, F.lit(INSERT)).when(~s_has, F.lit(KEEP))
              .when(wins, F.lit(UPDATE)).otherwise(F.lit(STALE)))
    take_src = (change == INSERT) | (change == UPDATE)
    return joined.select(*[F.when(take_src, s_map[c]).otherwise(t_map[c]).alias(c) for c in cols],
                         change.alias(CHANGE))


def change_counts(merged: DataFrame) -> DataFrame:
    """One row: kept, inserted, updated, stale, changed (= inserted + updated)."""
    n = lambda v: F.sum(F.when(F.col(CHANGE) == v, 1).otherwise(0)).cast("bigint")
    return merged.agg(n(KEEP).alias("kept"), n(INSERT).alias("inserted"), n(UPDATE).alias("updated"),
                      n(STALE).alias("stale"),
                      (n(INSERT) + n(UPDATE)).alias("changed"))


def key_condition(keys: Sequence[str], null_safe: bool | Sequence[str] = True, coalesce_blank: bool = False,
                  prefix: str = "_t_") -> Column:
    """Join condition between source columns ``k`` and target columns ``prefix + k``:
    plain '=', null-safe '<=>' (all or listed keys), or NULL treated as '' on both sides."""
    conds = []
    for k in keys:
        a, b = F.col(k), F.col(prefix + k)
        if coalesce_blank:
            conds.append(F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit("")))
        elif null_safe is True or (not isinstance(null_safe, bool) and k in null_safe):
            conds.append(a.eqNullSafe(b))
        else:
            conds.append(a == b)
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def values_bound(batch: DataFrame, column: str, most: int = 1000) -> Column:
    """A condition on ``column`` that every row of the (stored) batch meets: its values if few, else their range.

    As a filter of the target it prunes partitions and row groups; nothing that could match is lost.
    """
    values = [r[0] for r in batch.select(column).distinct().limit(most + 1).collect()]
    null = F.col(column).isNull() if None in values else F.lit(False)
    if len(values) <= most:
        known = [v for v in values if v is not None]
        return F.col(column).isin(known) | null if None in values else F.col(column).isin(known)
    low, high = batch.agg(F.min(column), F.max(column)).first()
    return F.col(column).between(low, high) | F.col(column).isNull()


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool | Sequence[str] = True,
             coalesce_blank: bool = False, distinct_source: bool = False, bound: Column | None = None) -> DataFrame:
    """Source rows whose identity is not in the target (the rows an insert-only merge adds).

    Plain equality reproduces ``MERGE ... ON a = b WHEN NOT MATCHED INSERT``: rows
    with a NULL key never match and are inserted again on every run.
    ``distinct_source`` first keeps one row per identity (insert-ignore on a
    unique constraint). Null-safe keys still plan as a hash left-anti join, which does
    not fan out, so repeated identities need no aggregate on either side. ``bound`` (see
    :func:`values_bound`) cuts a stored target to what the batch can meet.
    """
    src = source.dropDuplicates(list(keys)) if distinct_source else source
    if bound is not None:
        target = target.filter(bound)
    known = target.select(*[F.col(k).alias("_t_" + k) for k in keys])
    return src.join(known, key_condition(keys, null_safe, coalesce_blank), "left_anti")


def content_digest(keys: Sequence[str], coalesce_blank: bool = False) -> Column:
    """A 64-bit digest of an identity made of long texts, stored next to them as ``DIGEST``."""
    return F.xxhash64(*[F.coalesce(F.col(k), F.lit("")) if coalesce_blank else F.col(k) for k in keys])


def new_content(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool | Sequence[str] = True,
                coalesce_blank: bool = False) -> DataFrame:
    """``new_rows`` for identities made of long texts: both sides have ``DIGEST`` and its 8 bytes are joined first.

    Source rows whose digest the target lacks are new without a look at any text. Only for the
    others the texts of the target rows with those digests are compared, so different texts
    that share a digest are both kept and the target's texts never move as a whole.
    """
    on = F.col(DIGEST) == F.col("_t_" + DIGEST)
    known = target.select(F.col(DIGEST).alias("_t_" + DIGEST))
    fresh, met = source.join(known, on, "left_anti"), source.join(known, on, "left_semi")
    texts = target.select(DIGEST, *keys).join(met.select(DIGEST), DIGEST, "left_semi")
    same = on & key_condition(keys, null_safe, coalesce_blank)
    texts = texts.select(*[F.col(k).alias("_t_" + k) for k in (DIGEST, *keys)])
    return fresh.unionByName(met.join(texts, same, "left_anti"))


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool | Sequence[str] = True,
                coalesce_blank: bool = False, distinct_source: bool = False, by_digest: bool = False) -> DataFrame:
    """Next state of an insert-only merge: target rows + new rows, with ``_change``."""
    if by_digest:
        digest = content_digest(keys, coalesce_blank)
        added = new_content(target.withColumn(DIGEST, digest), source.withColumn(DIGEST, digest), keys, null_safe, coalesce_blank)
    else:
        added = new_rows(target, source, keys, null_safe, coalesce_blank, distinct_source)
    cols = [c for c in target.columns if c not in (CHANGE, DIGEST)]
    return (target.select(*cols).withColumn(CHANGE, F.lit(KEEP))
            .unionByName(added.select(*cols).withColumn(CHANGE, F.lit(INSERT))))


def replace_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   source_order: Sequence | None = None) -> DataFrame:
    """Update-else-insert where the source always wins (audit rows by run id,
    delete+insert incremental models)."""
    return upsert(target, source, keys, compare=None, source_order=source_order)


# ---------------------------------------------------------------------------
# Upserts as change rows: what is compared and written follows the batch, not the table
# ---------------------------------------------------------------------------

def _winners(current: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str] | None, cmp: str,
             source_order: Sequence | None, old: Sequence[str]) -> tuple[DataFrame, Column]:
    """The batch's best row per key beside ``old`` columns of the row it meets, and what the upsert does with it."""
    order = list(source_order or compare or [])
    if not order:
        raise ValueError("a source ordering is needed to pick one row per key")
    src = latest_per_key(source, keys, order)
    met = current.select(*keys, *[c for c in old if c not in keys]).join(src.select(*keys), list(keys), "left_semi")
    met = met.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in old], F.lit(True).alias("_in_tgt"))
    cmp_cols = list(compare or [])
    wins = F.lit(True) if not cmp_cols else newer({c: F.col(c) for c in cmp_cols}, {c: F.col(f"_t_{c}") for c in cmp_cols},
                                                  cmp_cols, cmp)
    change = F.when(F.col("_in_tgt").isNull(), F.lit(INSERT)).when(wins, F.lit(UPDATE)).otherwise(F.lit(STALE))
    return src.join(met, list(keys), "left"), change


def upsert_changes(current: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None,
                   cmp: str = ">", source_order: Sequence | None = None) -> DataFrame:
    """The rows an upsert would change: inserts and winning updates (``_change``), stale rows dropped.

    Only the key and compare columns of ``current`` are read, restricted to the
    batch's keys by a semi-join (AQE broadcasts the batch keys when the batch is
    small, so the table is filtered map-side without a shuffle). Same semantics as
    :func:`upsert`; apply the result with :func:`apply_changes`.
    """
    cols = [c for c in current.columns if c != CHANGE]
    joined, change = _winners(current, source.select(*cols), keys, compare, cmp, source_order, list(compare or []))
    return joined.select(*cols, change.alias(CHANGE)).filter(F.col(CHANGE) != STALE)


def signed_changes(current: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None,
                   cmp: str = ">", source_order: Sequence | None = None) -> DataFrame:
    """Both sides of every row an upsert changes: the new row with ``_sign`` +1, the row it replaces with -1.

    Sums over signed rows are what an invertible aggregate of the table gains, so it is kept
    up to date from these rows alone (``ordermill.operators.metrics.add_signed``). The rows with
    +1 are those of :func:`upsert_changes`.
    """
    cols = [c for c in current.columns if c != CHANGE]
    joined, change = _winners(current, source.select(*cols), keys, compare, cmp, source_order, cols)
    new = F.struct(*[F.col(c) for c in cols], F.lit(1).alias(SIGN))
    old = F.struct(*[F.col(f"_t_{c}").alias(c) for c in cols], F.lit(-1).alias(SIGN))
    sides = F.when(change == UPDATE, F.array(new, old)).otherwise(F.array(new))
    return joined.filter(change != STALE).select(F.inline(sides))


def apply_changes(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State after change rows (at most one per key): base rows of other keys, and the change rows.

    Base rows pass a left-anti join against the set of changed keys: no shuffle of the base when
    AQE broadcasts that set.
    """
    cols = [c for c in changes.columns if c not in (CHANGE, SIGN)]
    return base.select(*cols).join(changes.select(*keys), list(keys), "left_anti").unionByName(changes.select(*cols))
