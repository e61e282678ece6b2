"""Tables addressed by path: create, read by date, and writes that can be repeated.

Every write replaces whole partitions, so a job that is run again, or a batch that is replayed,
leaves the same rows behind. ``fmt`` is any Spark table format; parquet is what is tested here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickweir.sources.session import scratch_path


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _files_by_folder(spark: SparkSession, pattern: str) -> dict[str, set[str]]:
    """Names of the files in each folder a pattern matches, from one listing."""
    fs, where = _fs(spark, f"{pattern}/*")
    found: dict[str, set[str]] = {}
    for status in fs.globStatus(where) or []:
        folder, name = str(status.getPath().toString()).rsplit("/", 1)
        found.setdefault(folder, set()).add(name)
    return found


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files below some paths, which may be patterns."""
    total = 0
    for path in paths:
        fs, pattern = _fs(spark, path)
        total += sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(pattern) or [])
    return total


def date_folders(spark: SparkSession, path: str, start: str, end: str) -> list[str]:
    """The partitions of some dates that exist."""
    first, last = f"event_date={start}", f"event_date={end}"
    return [f"{path}/{name}" for name in _children(spark, path) if first <= name <= last]


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def create_if_missing(
    spark: SparkSession, path: str, schema: StructType, partition_by: list[str] = (), fmt: str = "parquet"
) -> bool:
    """Make an empty table; false if there already is one."""
    if exists(spark, path):
        return False
    empty = spark.createDataFrame([], schema)
    empty.write.format(fmt).partitionBy(*partition_by).save(path)
    return True


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The table with its declared columns; an empty frame where there is no table yet. The schema
    is given, not inferred, which also keeps date partitions text."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if fmt == "parquet" else spark.read
    return reader.format(fmt).load(path).select(schema.fieldNames())


def between_dates(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of the dates from ``start`` to ``end``; prunes partitions where the table has them."""
    date = F.col("event_date")
    return df.filter(date == start) if start == end else df.filter((date >= start) & (date <= end))


def read_dates(
    spark: SparkSession,
    path: str,
    schema: StructType,
    start: str,
    end: str,
    window: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The rows of some dates (and of one window duration). Only the folders of these dates are
    listed, so the cost of a daily run does not grow with the age of the table."""
    if fmt != "parquet":
        rows = between_dates(read_table(spark, path, schema, fmt), start, end)
        return rows.filter(F.col("window_duration") == window) if window else rows
    folder = f"{path}/window_duration={window}" if window else path
    return _read_folders(spark, path, schema, date_folders(spark, folder, start, end))


def _read_folders(spark: SparkSession, path: str, schema: StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*folders).select(schema.fieldNames())


def latest_date(spark: SparkSession, path: str) -> str | None:
    """The newest ``event_date`` partition, from the folder names alone."""
    dates = [name.split("=", 1)[1] for name in _children(spark, path) if name.startswith("event_date=")]
    return max(dates, default=None)


def date_bounds(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[str, str] | None:
    """The first and the last ``event_date`` of a table; from the folder names alone where it is files."""
    if not exists(spark, path):
        return None
    if fmt == "parquet":
        dates = [name.split("=", 1)[1] for name in _children(spark, path) if name.startswith("event_date=")]
    else:
        both = spark.read.format(fmt).load(path).agg(F.min("event_date"), F.max("event_date")).first()
        dates = [day for day in both if day]
    return (min(dates), max(dates)) if dates else None


def latest_date_of(df: DataFrame) -> DataFrame:
    """The same from any frame, for tables that are not addressed by path."""
    return df.agg(F.max("event_date").alias("event_date"))


def resolve_dates(
    spark: SparkSession, path: str, event_date: str | None, start: str | None, end: str | None, fmt: str = "parquet"
) -> tuple[str, str] | None:
    """The range a job works on: the one given, the single date, or the newest date in the table. In a
    format with transactions folders outlive the rows that were deleted, so there the rows are asked."""
    if bool(start) != bool(end):
        raise ValueError("a range needs both its start and its end")
    if start and end:
        if start > end:
            raise ValueError(f"the range starts on {start}, after its end on {end}")
        return start, end
    day = event_date
    if not day and fmt == "parquet":
        day = latest_date(spark, path)
    elif not day and exists(spark, path):
        day = latest_date_of(spark.read.format(fmt).load(path)).first()["event_date"]
    return (day, day) if day else None


def balanced(df: DataFrame, columns: list[str]) -> DataFrame:
    """Group rows by partition column before a write, letting Spark split the large partitions by
    size: few files per partition, and no task that holds a whole day."""
    return df.hint("rebalance", *columns)


def append_batch(df: DataFrame, path: str, partition_by: list[str], batch_id: str, fmt: str = "parquet") -> None:
    """Add a batch under its id. Replaying a batch replaces what it wrote; other batches stay."""
    tagged = balanced(df, partition_by).withColumn("ingest_id", F.lit(batch_id))
    writer = tagged.write.format(fmt).mode("overwrite").partitionBy(*partition_by, "ingest_id")
    if fmt == "delta":
        writer = writer.option("replaceWhere", f"ingest_id = '{batch_id}'")
    else:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def _batch_pattern(path: str, partition_by: list[str], batch_id: str) -> str:
    return f"{path}{''.join(f'/{name}=*' for name in partition_by)}/ingest_id={batch_id}"


def _remove_unchanged(spark: SparkSession, pattern: str, before: dict[str, set[str]]) -> None:
    """Remove the folders that a write has not touched; what it writes has new file names."""
    after = _files_by_folder(spark, pattern)
    for folder, files in before.items():
        if after.get(folder) == files:
            remove(spark, folder)


def replace_batch(
    df: DataFrame, path: str, partition_by: list[str], batch_id: str, fmt: str = "parquet"
) -> None:
    """As ``append_batch``, for input that may have changed since: partitions that only the earlier
    run of the batch wrote to are removed."""
    spark, pattern = df.sparkSession, _batch_pattern(path, partition_by, batch_id)
    before = {} if fmt == "delta" else _files_by_folder(spark, pattern)
    append_batch(df, path, partition_by, batch_id, fmt)
    if before:
        _remove_unchanged(spark, pattern, before)


def read_batch(
    spark: SparkSession, path: str, schema: StructType, partition_by: list[str], batch_id: str, fmt: str = "parquet"
) -> DataFrame:
    """The rows of one batch."""
    if fmt != "parquet":
        return spark.read.format(fmt).load(path).filter(F.col("ingest_id") == batch_id).select(schema.fieldNames())
    folders = sorted(_files_by_folder(spark, _batch_pattern(path, partition_by, batch_id)))
    return _read_folders(spark, path, schema, folders)


def replace_dates(
    df: DataFrame, path: str, start: str, end: str, window: str | None = None, fmt: str = "parquet",
    grouped: bool = False, options: dict | None = None,
) -> None:
    """Make the table hold exactly ``df`` for these dates (and this window duration). A date that
    now has no rows loses the partition an earlier run left: a dynamic overwrite alone keeps it.
    A single date is written as its tasks hold it; a range is grouped by date first, unless its tasks are
    known to hold few dates each (``grouped``)."""
    spark = df.sparkSession
    keys = ["window_duration", "event_date"] if window else ["event_date"]
    rows = df if grouped or start == end else balanced(df, keys)
    writer = rows.write.format(fmt).options(**(options or {})).mode("overwrite").partitionBy(*keys)
    if fmt == "delta":
        scope = f"event_date >= '{start}' AND event_date <= '{end}'"
        scope += f" AND window_duration = '{window}'" if window else ""
        writer.option("replaceWhere", scope).save(path)
        return
    folder = f"{path}/window_duration={window}" if window else path
    stored = [name.rsplit("/", 1)[1] for name in date_folders(spark, folder, start, end)]
    pattern = f"{folder}/{{{','.join(stored)}}}"
    before = _files_by_folder(spark, pattern) if stored else {}
    writer.option("partitionOverwriteMode", "dynamic").save(path)
    if before:
        _remove_unchanged(spark, pattern, before)


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write an intermediate result to the shared folder and read it back: computed once, columnar,
    and still there when executors are lost. The caller removes it when done."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
