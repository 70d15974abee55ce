"""Parquet tables published together: new folders, then one commit file.

Plain parquet has no transactions, so a publish writes every output into a folder of its own
attempt (invisible to readers, never overwritten) and then creates one commit file, last. Commits
are numbered; a number is taken by renaming the commit file into place, which fails if another
writer took it first. A commit file holds, for the tables it changed, their folders and schema, and,
for every table, the number of the commit that tells them. A crashed run leaves only folders that no
commit names. Every write is an ordinary Spark write and every table an ordinary Parquet read:

* a plain table is a list of folders (a replaced table one, each append one more);
* a keyed table is partitioned by a hash bucket of its key, and an upsert writes the touched buckets anew.

With Delta Lake present, the same calls map onto Delta tables and ``DESCRIBE HISTORY``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.text import iso_text
from ordermill.operators import merge as M
from ordermill.operators.rules import MALFORMED
from ordermill.plans.buckets import bucket_of, touched
from ordermill.plans.observed import counted_write
from ordermill.schema import ORDER_COLUMNS
from ordermill.session import write_folders
from ordermill.sources.files import resolve_uri

COMMIT_SCHEMA = "seq bigint, run_id string, table string, path string, committed_at timestamp, operation string, keys string"
APPEND, UPSERT = "APPEND", "UPSERT"
BUCKET = "_bucket"
#: Folders that a commit lists of an appended table; older ones stand in the commit it points to.
LISTED = 64


class CommitConflict(RuntimeError):
    """Another writer committed to the same tables since the state that this publish builds on."""


class SchemaConflict(ValueError):
    """Appended columns can't be read together with those of the table."""


class Files:
    """Small files next to the tables, through Hadoop's FileContext (any scheme)."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf).makeQualified(p)

    def exists(self, path: str) -> bool:
        p = self._at(path)
        return p.getFileSystem(self.conf).exists(p)

    def numbers(self, path: str, prefix: str) -> list[int]:
        """The numbers after ``prefix`` in the names in a folder, ascending."""
        p = self._at(path)
        names = [s.getPath().getName() for s in p.getFileSystem(self.conf).listStatus(p)]
        return sorted(int(x[len(prefix):]) for x in names if x.startswith(prefix))

    def read(self, path: str) -> str:
        p = self._at(path)
        stream = p.getFileSystem(self.conf).open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str, replace: bool) -> bool:
        """Write whole and rename into place; False if the file exists and may not be replaced."""
        p, tmp = self._at(path), self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        out = p.getFileSystem(self.conf).create(tmp, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE if replace else rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), self.conf).rename(tmp, p, how)
            return True
        except Py4JJavaError as e:
            p.getFileSystem(self.conf).delete(tmp, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise


#: Types that a wider one reads without loss.
WIDER = {("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("tinyint", "int"), ("float", "double"), ("int", "double"),
         ("void", "string")}


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both, the wider type where one widens the other; a dropped column stays and is null in new rows."""
    out = {f.name: f.dataType for f in old}
    for f in new:
        have = out.get(f.name, f.dataType)
        pair = (have.simpleString(), f.dataType.simpleString())
        if have != f.dataType and pair not in WIDER and pair[::-1] not in WIDER:
            raise SchemaConflict(f"column {f.name!r} is {pair[0]} in the table and {pair[1]} in the new rows")
        out[f.name] = f.dataType if pair in WIDER else have
    return T.StructType([T.StructField(n, t) for n, t in out.items()])


@dataclass
class Published:
    """Of each output: the folder written (None: nothing to write) and its rows, for upserts the changed ones."""

    paths: dict[str, str | None]
    rows: dict[str, int]


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 8):
        """``buckets`` is for keyed tables that are published for the first time."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.files = Files(spark)

    # -- commit log -------------------------------------------------------------
    @property
    def commits_path(self) -> str:
        return f"{self.root}/_commits"

    def _commit_path(self, seq: int) -> str:
        return f"{self.commits_path}/{seq:012d}.json"

    def head(self) -> int:
        """Number of the newest commit (0: none). A hint file says where to start looking."""
        hint = f"{self.root}/_head"
        seq = int(self.files.read(hint)) if self.files.exists(hint) else 0
        while self.files.exists(self._commit_path(seq + 1)):
            seq += 1
        return seq

    def _commit(self, seq: int) -> dict:
        return json.loads(self.files.read(self._commit_path(seq)).splitlines()[0])

    def _layout(self, table: str, head: int | None = None) -> dict | None:
        head = self.head() if head is None else head
        at = self._commit(head)["heads"].get(table) if head else None
        return None if at is None else self._commit(at)["layouts"][table]

    def commits(self) -> DataFrame:
        """All commit records, one per table and commit (empty before the first publish)."""
        if not self.files.exists(self.commits_path):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        # a commit file's first line is the log's own state; the other lines are the records
        return (self.spark.read.schema(COMMIT_SCHEMA).option("pathGlobFilter", "*.json").json(self.commits_path)
                .filter(F.col("table").isNotNull()))

    def history(self, table: str) -> DataFrame:
        """Commit history of one table, newest first (DESCRIBE HISTORY)."""
        return self.commits().filter(F.col("table") == table).orderBy(F.col("seq").desc())

    def _publish(self, seen: int, edits: dict[str, Callable[[dict | None, int | None], dict]], records: list[dict], run_id: str,
                 shared: Sequence[str] = ()) -> int:
        """Commit on top of the head. Tables that others committed to since ``seen`` are a conflict, but for ``shared`` ones."""
        while True:
            head = self.head()
            state = self._commit(head) if head else {"heads": {}}
            moved = {t for t, at in state["heads"].items() if at > seen and t in edits and t not in shared}
            if moved:
                raise CommitConflict(f"{sorted(moved)} changed since commit {seen}; run {run_id!r} published nothing")
            heads = dict(state["heads"])
            layouts = {t: edit(self._layout(t, head), heads.get(t)) for t, edit in edits.items()}
            heads.update({t: head + 1 for t in layouts})
            now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
            lines = [{"heads": heads, "layouts": layouts},
                     *[{"seq": head + 1, "run_id": run_id, "committed_at": now, **r} for r in records]]
            if self.files.write(self._commit_path(head + 1), "\n".join(json.dumps(x) for x in lines) + "\n", replace=False):
                self.files.write(f"{self.root}/_head", str(head + 1), replace=True)
                return head + 1

    # -- reading ----------------------------------------------------------------
    def _folders(self, layout: dict) -> list[str]:
        """Folders of a plain table in order of their commits, or of a keyed one's buckets."""
        if "buckets" in layout:
            return [f"{folder}/{BUCKET}={b}" for b, folder in layout["buckets"].items()]
        out = list(layout["folders"])
        while layout["more"] is not None:
            table, seq = layout["more"]
            layout = self._commit(seq)["layouts"][table]
            out = layout["folders"] + out
        return out

    def current_paths(self, table: str) -> list[str]:
        layout = self._layout(table)
        return [] if layout is None else self._folders(layout)

    def read(self, table: str, schema: T.StructType | str | None = None) -> DataFrame:
        """Current state of ``table``; an empty frame of ``schema`` when it does not exist yet.

        The columns are those of the table (see :func:`merged_schema`); folders written before a
        column was added give null there.
        """
        layout = self._layout(table)
        if layout is None:
            if schema is None:
                raise FileNotFoundError(f"table {table!r} has no committed version")
            return self._none(schema)
        return self._read(table, layout)

    def _none(self, schema: T.StructType | str) -> DataFrame:
        """An empty frame that Spark's optimizer knows to be empty: a first load then joins with nothing and moves no rows for it."""
        return self.spark.createDataFrame([], schema).limit(0)

    def _read(self, table: str, layout: dict, only: Sequence[int] | None = None) -> DataFrame:
        if only is not None:
            layout = {**layout, "buckets": {b: f for b, f in layout["buckets"].items() if int(b) in set(only)}}
        stored, paths = T.StructType.fromJson(json.loads(layout["schema"])), self._folders(layout)
        if not paths:
            return self._none(stored)
        # the folders are read as partitions of one table, so those partitioned further go into one scan
        rows = self.spark.read.schema(stored).option("basePath", f"{self.root}/{table}").parquet(*paths)
        return rows.select(*stored.fieldNames())

    def lookup(self, table: str, key: str, values: Sequence) -> DataFrame:
        """Rows of the current table whose ``key`` is in ``values``; of a table keyed by it, only their buckets are read."""
        layout = self._layout(table)
        if layout is None:
            raise FileNotFoundError(f"table {table!r} has no committed version")
        only = None
        if layout.get("keys") == [key]:
            kind = T.StructType.fromJson(json.loads(layout["schema"]))[key].dataType
            wanted = self.spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(key, kind)]))
            only = touched(wanted, [key], layout["n"])
        return self._read(table, layout, only).filter(F.col(key).isin(list(values)))

    def exists(self, table: str) -> bool:
        return self._layout(table) is not None

    # -- writing ----------------------------------------------------------------
    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}/v={uuid.uuid4().hex}"

    def publish(self, outputs: dict[str, DataFrame | Callable[[dict[str, int]], DataFrame]], run_id: str,
                hook: Callable[[dict[str, str | None]], None] | None = None, operation: str = "WRITE",
                partition_by: dict[str, list[str]] | None = None, appends: Sequence[str] = (),
                upserts: dict[str, list[str]] | None = None, rebuilds: dict[str, list[str]] | None = None,
                shared: Sequence[str] = (), seen: int | None = None) -> Published:
        """Write every output as a new folder, then commit them together.

        * tables in ``appends`` hold only new rows, added to the current table (APPEND);
        * tables in ``upserts`` (table -> key columns) hold change rows, at most one a key: the key
          buckets they fall into are read, changed and written anew, other buckets stay (UPSERT);
        * tables in ``rebuilds`` (table -> key columns) hold the whole keyed table, at most one row a key;
        * every other table replaces the current one, with whatever columns (``operation``).

        An output may be a function of the rows written so far by table. ``seen`` is the commit
        (``head()``) whose state the outputs were computed from; if another writer has committed
        to one of these tables since, nothing is published and ``CommitConflict`` is raised.
        Appended tables in ``shared`` (logs) are never in conflict. ``run_id`` is only recorded: a
        repeated id overwrites nothing. ``hook`` gets the written folders before the commit (a
        failure there publishes nothing).
        """
        upserts, partition_by, rebuilds = upserts or {}, partition_by or {}, rebuilds or {}
        seen = self.head() if seen is None else seen
        done, edits, records = Published({}, {}), {}, []
        for table, df in outputs.items():
            df = df(done.rows) if callable(df) else df
            if table in upserts or table in rebuilds:
                layout = self._layout(table, seen) if table in upserts else None
                edits[table] = self._write_buckets(table, df, upserts.get(table) or rebuilds[table], layout, done)
            else:
                path = done.paths[table] = self._folder(table)
                by = partition_by.get(table)

                def write(rows: DataFrame, path=path, by=by) -> None:
                    if by:                         # each folder's rows in few files; a large folder is dealt over several tasks
                        write_folders(rows.hint("rebalance", *[F.col(c) for c in by]), by, path)
                    else:
                        rows.write.parquet(path)

                done.rows[table] = counted_write(df, write)["rows"]
                edits[table] = self._append(table, path, df.schema) if table in appends else self._replace(path, df.schema)
            kind = UPSERT if table in upserts else APPEND if table in appends else operation
            records.append({"table": table, "path": done.paths[table], "operation": kind, "keys": ",".join(upserts.get(table, [])) or None})
        if hook is not None:
            hook(done.paths)
        self._publish(seen, edits, records, run_id, shared)
        return done

    def _replace(self, path: str, schema: T.StructType):
        return lambda layout, at: {"folders": [path], "more": None, "schema": schema.json()}

    def _append(self, table: str, path: str, schema: T.StructType):
        def edit(layout: dict | None, at: int | None) -> dict:
            if layout is None:
                return self._replace(path, schema)(None, None)
            both = merged_schema(T.StructType.fromJson(json.loads(layout["schema"])), schema).json()
            full = len(layout["folders"]) >= LISTED
            return {"folders": [path] if full else [*layout["folders"], path], "more": [table, at] if full else layout["more"], "schema": both}
        return edit

    def _write_buckets(self, table: str, changes: DataFrame, keys: list[str], layout: dict | None, done: Published):
        """A new keyed table goes straight into its buckets. Change rows of a stored one are written once; then the
        buckets they touch are written with them in place. No row is moved for its bucket: a task writes to all."""
        if layout is not None and "buckets" not in layout:
            raise ValueError(f"table {table!r} is not keyed: rebuild it with its keys first")
        if layout is None:
            layout = {"keys": keys, "n": self.buckets, "buckets": {}, "schema": changes.schema.json()}
        bucket, path = bucket_of(keys, layout["n"]), self._folder(table)
        done.paths[table] = None
        if not layout["buckets"]:
            write = lambda df: write_folders(df.withColumn(BUCKET, bucket), [BUCKET], path)
            done.rows[table] = counted_write(changes, write)["rows"]
            hit = self.files.numbers(path, f"{BUCKET}=") if done.rows[table] else []
        else:
            work = f"{self.root}/_work/{uuid.uuid4().hex}"
            done.rows[table] = counted_write(changes, lambda df: df.write.parquet(work))["rows"]
            hit = []
            if done.rows[table]:
                stored = self.spark.read.schema(changes.schema).parquet(work)
                hit = touched(stored, keys, layout["n"])
                after = M.apply_changes(self._read(table, layout, hit), stored, keys)
                write_folders(after.withColumn(BUCKET, bucket), [BUCKET], path)
        if hit:
            done.paths[table] = path
            layout = {**layout, "buckets": {**layout["buckets"], **{str(b): path for b in hit}}}
        return lambda _, at: layout

    def ensure(self, table: str, schema: T.StructType | str, run_id: str = "init") -> None:
        """Create the table empty when it does not exist (CREATE TABLE IF NOT EXISTS)."""
        if not self.exists(table):
            self.publish({table: self.spark.createDataFrame([], schema)}, run_id, operation="CREATE")


# -- staging load and file exports ------------------------------------------------

def load_staging(raw: DataFrame) -> DataFrame:
    """Truncate-and-load staging rows: raw text columns (and the raw line of malformed ones) + ``source_file``, ``loaded_at``."""
    line = [MALFORMED] if MALFORMED in raw.columns else []
    return raw.select(*ORDER_COLUMNS, *line, F.col("_source_file").alias("source_file"),
                      F.current_timestamp().alias("loaded_at"))


def export_csv(df: DataFrame, path: str, columns=ORDER_COLUMNS, ts_columns=("updated_at",),
               containers: dict[str, str] | None = None) -> None:
    """Overwrite a header CSV export (a path or a ``blob://`` target, see ``resolve_uri``); timestamps are
    written as 'yyyy-MM-dd HH:mm:ss'."""
    out = df.select(*[iso_text(c, " ").alias(c) if c in ts_columns else F.col(c) for c in columns])
    # Spark's CSV writer trims values by default; exports keep text exactly as it was
    (out.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(resolve_uri(path, containers)))
