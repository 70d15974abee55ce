"""Order file scans with schema checks and lineage columns.

Every reader is a plain ``spark.read`` with an explicit schema: the scan is
split by file/byte range across executors, nothing is downloaded to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.schema import ORDER_COLUMNS, RAW_ORDER_SCHEMA, STATUS_LABELS

# A value that never occurs in order files: lets empty fields stay '' (like a
# Python csv reader) instead of becoming NULL, while short rows still give NULL.
_NO_NULL_TOKEN = "\u0000<null>\u0000"


def resolve_uri(uri: str, containers: dict[str, str] | None = None) -> str:
    """Map ``blob://container/name`` to a Hadoop path via ``containers`` (base paths).

    Any other URI (``abfss://``, ``s3a://``, ``file:/``, plain paths) is returned as is.
    """
    if uri.startswith("blob://"):
        container, _, name = uri[len("blob://"):].partition("/")
        if not containers or container not in containers:
            raise ValueError(f"no base path configured for container {container!r}")
        return containers[container].rstrip("/") + "/" + name
    return uri


CORRUPT = "_corrupt_record"


def read_orders(spark: SparkSession, path: str | Sequence[str], strict_header: bool = True,
                pattern: str | None = None, lineage: bool = True, empty_as_null: bool = True,
                containers: dict[str, str] | None = None, flag_malformed: bool = True) -> DataFrame:
    """Raw order CSV (all text) from a file, a folder or a glob.

    * ``strict_header`` - every file's header must carry the five names in order
      (``enforceSchema=false``). A mismatch fails the job that reads the columns;
      names are compared case-insensitively unless ``spark.sql.caseSensitive`` is on
      while that job runs (``ordermill.plans.runs.validate_once`` does so).
    * ``pattern`` - only file names matching the glob (e.g. ``orders_*.csv``),
      not recursive.
    * ``lineage`` - ``_source_file`` (full path), ``_file_name``, ``_ingested_at``.
    * ``empty_as_null=False`` keeps empty fields as '' (short rows still NULL).
    * ``flag_malformed`` (default) - keep the raw line of rows with too few or too many fields
      in ``_corrupt_record`` (Spark would otherwise pad or cut them silently); the rule sets
      then reject such rows as malformed.
    """
    paths = [resolve_uri(p, containers) for p in ([path] if isinstance(path, str) else path)]
    schema = RAW_ORDER_SCHEMA
    if flag_malformed:
        from pyspark.sql import types as T
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    reader = (spark.read.schema(schema)
              .option("header", True)
              .option("enforceSchema", not strict_header)
              .option("mode", "PERMISSIVE")
              .option("encoding", "UTF-8")
              .option("quote", '"')
              .option("escape", "\\")
              .option("recursiveFileLookup", False))
    if not empty_as_null:
        reader = reader.option("nullValue", _NO_NULL_TOKEN)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if flag_malformed:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.csv(paths)
    if lineage:
        df = with_lineage(df, extra=(CORRUPT,) if flag_malformed else ())
    return df


def with_lineage(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Add file lineage from the hidden ``_metadata`` column and the load time."""
    return df.select(
        *ORDER_COLUMNS, *extra,
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_name").alias("_file_name"),
        F.current_timestamp().alias("_ingested_at"),
    )


def read_orders_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Exploration scan with an inferred schema (reads the data twice; not for jobs)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def slice_by_file(bronze: DataFrame, source_file: str, column: str = "_source_file") -> DataFrame:
    """Rows of one input file; prunes partitions when bronze is partitioned by the file column."""
    return bronze.filter(F.col(column) == F.lit(source_file))


def read_seed(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A small dimension seed file (header CSV)."""
    r = spark.read.option("header", True)
    if schema:
        r = r.schema(schema)
    return r.csv(path)


def status_dimension(spark: SparkSession, omit: Sequence[str] = ()) -> DataFrame:
    """The status -> label seed (four fixed rows), optionally without some statuses."""
    rows = [r for r in STATUS_LABELS if r[0] not in omit]
    return spark.createDataFrame(rows, "status string, status_label string")


def register_external_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Expose a lake table folder as a temporary view (no copy)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}` USING {fmt} OPTIONS (path '{path}')")
    return spark.table(name)
