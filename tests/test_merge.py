import itertools

from pyspark.sql import functions as F

from ordermill.operators import merge as M

SCHEMA = "order_id string, status string, updated_at timestamp_ntz, enqueued_at timestamp_ntz"


def _df(spark, rows):
    from datetime import datetime
    return spark.createDataFrame([(k, s, datetime(2026, 8, 1, h), datetime(2026, 8, 2, e)) for k, s, h, e in rows],
                                 SCHEMA)


def _state(df):
    return sorted((r["order_id"], r["status"], str(r["updated_at"]), str(r["enqueued_at"]))
                  for r in df.drop(M.CHANGE).collect())


def test_upsert_change_flags_and_ties(spark):
    tgt = _df(spark, [("A", "t", 8, 1), ("B", "t", 8, 1), ("C", "t", 8, 1), ("D", "t", 8, 1)])
    src = _df(spark, [("A", "s", 9, 1), ("B", "s", 7, 1), ("C", "s", 8, 2), ("E", "s", 8, 1), ("E", "s2", 6, 1)])
    out = {r["order_id"]: (r["status"], r[M.CHANGE]) for r in M.upsert(tgt, src, ["order_id"], ["updated_at"]).collect()}
    assert out == {"A": ("s", "update"), "B": ("t", "stale"), "C": ("t", "stale"), "D": ("t", "keep"),
                   "E": ("s", "insert")}
    ge = {r["order_id"]: r["status"] for r in M.upsert(tgt, src, ["order_id"], ["updated_at"], ">=").collect()}
    assert ge["C"] == "s"                                     # ties go to the source
    tb = {r["order_id"]: r["status"] for r in
          M.upsert(tgt, src, ["order_id"], ["updated_at", "enqueued_at"]).collect()}
    assert tb["C"] == "s" and tb["B"] == "t"                  # equal time, later enqueue wins
    rep = {r["order_id"]: r["status"] for r in
           M.replace_by_key(tgt, src, ["order_id"], source_order=["updated_at"]).collect()}
    assert rep["B"] == "s"
    counts = M.change_counts(M.upsert(tgt, src, ["order_id"], ["updated_at"])).first().asDict()
    assert counts == {"kept": 1, "inserted": 1, "updated": 1, "stale": 2, "changed": 2}


def test_upsert_idempotent_and_batch_order_independent(spark):
    batches = [_df(spark, [("A", "1", 8, 1), ("B", "1", 9, 1)]),
               _df(spark, [("A", "2", 10, 1), ("C", "2", 8, 1)]),
               _df(spark, [("A", "3", 9, 3), ("B", "3", 9, 2), ("C", "3", 8, 2)])]
    empty = spark.createDataFrame([], SCHEMA)
    finals = set()
    for perm in itertools.permutations(batches):
        state = empty
        for b in perm:
            state = M.upsert(state, b, ["order_id"], ["updated_at", "enqueued_at"]).drop(M.CHANGE)
        finals.add(tuple(_state(state)))
        again = M.upsert(state, perm[-1], ["order_id"], ["updated_at", "enqueued_at"])
        assert _state(again) == _state(state)
        assert again.filter(F.col(M.CHANGE).isin(M.INSERT, M.UPDATE)).count() == 0
    assert len(finals) == 1


def test_insert_only_null_keys(spark):
    t = spark.createDataFrame([("f", None, "x"), ("f", "A", "y")], "f string, k string, v string")
    s = spark.createDataFrame([("f", None, "x"), ("f", "A", "y"), ("f", "B", "z")], "f string, k string, v string")
    plain = M.new_rows(t, s, ["f", "k", "v"], null_safe=False)
    assert sorted(r["k"] or "-" for r in plain.collect()) == ["-", "B"]     # NULL never matches with '='
    safe = M.new_rows(t, s, ["f", "k", "v"], null_safe=True)
    assert [r["k"] for r in safe.collect()] == ["B"]
    blank = M.new_rows(t.withColumn("k", F.when(F.col("k").isNull(), "").otherwise(F.col("k"))), s, ["f", "k"],
                       coalesce_blank=True)
    assert [r["k"] for r in blank.collect()] == ["B"]
    merged = M.insert_only(t, s, ["f", "k", "v"])
    assert M.new_rows(merged.drop(M.CHANGE), s, ["f", "k", "v"]).count() == 0


def test_change_rows_equal_full_rewrite(spark, tmp_path):
    from ordermill.plans.store import Store
    batches = [_df(spark, [("A", "1", 8, 1), ("B", "1", 9, 1)]),
               _df(spark, [("A", "2", 10, 1), ("C", "2", 8, 1), ("B", "2", 9, 1)]),
               _df(spark, [("A", "3", 9, 3), ("B", "3", 9, 2), ("C", "3", 8, 2), ("D", "3", 1, 1)])]
    keys, cmp = ["order_id"], ["updated_at", "enqueued_at"]
    for i, perm in enumerate(list(itertools.permutations(batches))[::2]):
        full = spark.createDataFrame([], SCHEMA)
        for b in perm:
            full = M.upsert(full, b, keys, cmp).drop(M.CHANGE)
        for rebuilt in (True, False):
            store = Store(spark, str(tmp_path / f"s{i}-{rebuilt}"), buckets=3)
            for j, b in enumerate(perm):
                ch = M.upsert_changes(store.read("t", SCHEMA), b, keys, cmp).drop(M.CHANGE)
                n = ch.count()
                assert store.publish({"t": ch}, "same id", upserts={"t": keys}).rows == {"t": n}
                if rebuilt and j:
                    store.publish({"t": store.read("t")}, "again", rebuilds={"t": keys})
            assert _state(store.read("t", SCHEMA)) == _state(full)
            again = M.upsert_changes(store.read("t", SCHEMA), perm[-1], keys, cmp)
            assert again.count() == 0                                  # replaying a batch changes nothing
        kinds = {r[M.CHANGE] for r in M.upsert_changes(spark.createDataFrame([], SCHEMA), perm[0], keys, cmp).collect()}
        assert kinds == {M.INSERT}


def test_signed_changes_are_both_sides_of_the_change_rows(spark):
    tgt = _df(spark, [("A", "t", 8, 1), ("B", "t", 8, 1), ("C", "t", 8, 1)])
    src = _df(spark, [("A", "s", 9, 1), ("B", "s", 7, 1), ("E", "s", 8, 1), ("E", "s2", 6, 1)])
    signed = M.signed_changes(tgt, src, ["order_id"], ["updated_at"])
    got = sorted((r["order_id"], r["status"], r[M.SIGN]) for r in signed.collect())
    assert got == [("A", "s", 1), ("A", "t", -1), ("E", "s", 1)]
    new = signed.filter(F.col(M.SIGN) > 0).drop(M.SIGN)
    assert _state(new) == _state(M.upsert_changes(tgt, src, ["order_id"], ["updated_at"]))
    assert _state(M.apply_changes(tgt, new, ["order_id"])) == _state(M.upsert(tgt, src, ["order_id"], ["updated_at"]))


def test_different_texts_of_one_digest_are_both_kept(spark, monkeypatch):
    rows = lambda *k: spark.createDataFrame([(x, None) for x in k], "k string, v string")
    for digest in (M.content_digest, lambda keys, coalesce_blank=False: F.lit(7).cast("bigint")):
        monkeypatch.setattr(M, "content_digest", digest)
        merged = M.insert_only(rows("a", "b"), rows("a", "c", "d"), ["k", "v"], by_digest=True)
        assert sorted((r["k"], r[M.CHANGE]) for r in merged.collect()) == [("a", "keep"), ("b", "keep"), ("c", "insert"), ("d", "insert")]
        assert merged.columns == ["k", "v", M.CHANGE]


def test_bounds_hold_every_row_of_the_batch(spark):
    df = spark.createDataFrame([(str(i % 7),) for i in range(50)] + [(None,)], "f string")
    for most in (1000, 3):
        assert df.filter(M.values_bound(df, "f", most)).count() == 51
    some = df.filter("f in ('2', '3')")
    assert df.filter(M.values_bound(some, "f")).select("f").distinct().count() == 2
    assert df.filter(M.values_bound(df.limit(0), "f")).count() == 0


def test_buckets_that_a_batch_misses_keep_their_files(spark, tmp_path):
    import os

    from ordermill.plans.buckets import BucketTable, touched
    rows = lambda keys, hour: _df(spark, [(k, f"h{hour}", hour, 1) for k in keys])
    keys = [f"K{i}" for i in range(40)]
    table = BucketTable(spark, str(tmp_path / "t"), SCHEMA, ["order_id"], 8)
    assert table.upsert(rows(keys, 8), ["updated_at"])["changed"] == 40
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "t") for f in fs if f.startswith("part-")}
    before, batch = files(), rows(keys[:2] + ["new"], 9)
    done = table.upsert(batch, ["updated_at"])
    hit = touched(batch, ["order_id"], 8)
    assert done == {"changed": 3, "buckets": len(hit)} and len(hit) < 8
    kept = {f for f in before if int(f.split("_bucket_of_8=")[1].split("/")[0]) not in hit}
    assert kept == before & files() and len(files()) == 8
    again = BucketTable(spark, str(tmp_path / "t"), SCHEMA, ["order_id"], 64)      # its own number of buckets is kept
    assert again.upsert(batch, ["updated_at"]) == {"changed": 0, "buckets": 0}
    assert {r["order_id"]: r["status"] for r in again.read().collect()} == {**{k: "h8" for k in keys}, **{k: "h9" for k in (*keys[:2], "new")}}
    plan = again.read([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket_of_8" in plan or "PartitionFilters: [(_bucket_of_8" in plan
