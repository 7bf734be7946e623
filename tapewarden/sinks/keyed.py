"""Keyed parquet tables: insert-ignore and upsert without a table format.

Rows lie under ``target_table / event_date / writer / batch_id``. A batch only ever replaces
its own folders (dynamic partition overwrite), so running it again after a
lost executor or a restart changes nothing. ``writer`` names the job: a job
that starts over with a fresh checkpoint needs a new name.

A batch lists and reads the folders of the dates it touches, no others. The
unique key holds for readers whatever writers do at the same time: where two
have stored a key, every reader takes the same row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewarden.schema import KeyedTable

_TABLE = "target_table"
_LAYOUT = ["event_date", "writer", "batch_id"]


def _stored_schema(table: KeyedTable) -> T.StructType:
    # Parquet columns are always nullable; the layout columns come from the path.
    fields = [T.StructField(f.name, f.dataType) for f in table.schema.fields]
    return T.StructType(
        [
            *fields,
            T.StructField("event_date", T.DateType()),
            T.StructField("writer", T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )


def _folder(root: str, table: KeyedTable) -> str:
    return f"{root.rstrip('/')}/{_TABLE}={table.name}"


def _files(spark: SparkSession, root: str, table: KeyedTable):
    """Hadoop's path class and file system of a table, which may not exist yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = path(_folder(root, table))
    return path, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _stored(
    spark: SparkSession, root: str, table: KeyedTable, dates: Sequence[date] | None = None
) -> DataFrame:
    """Stored rows with their layout columns, of all dates or of some; empty before the first write."""
    path, files = _files(spark, root, table)
    folder = _folder(root, table)
    places = [folder] if dates is None else [f"{folder}/event_date={d.isoformat()}" for d in dates]
    there = [p for p in places if files.exists(path(p))]
    if not there:
        return spark.createDataFrame([], _stored_schema(table))
    return spark.read.schema(_stored_schema(table)).option("basePath", folder).parquet(*there)


def touched_dates(rows: DataFrame) -> list[date]:
    """The dates of a batch's rows: as many values as the batch touches folders."""
    day = F.to_date("window_start").alias("day")
    return sorted(r.day for r in rows.select(day).distinct().collect() if r.day is not None)


def _first_by(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = Window.partitionBy(*key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def _oldest() -> list[Column]:
    return [F.col(c) for c in ("detected_at", "writer", "batch_id")]


def _newest() -> list[Column]:
    return [F.desc(c) for c in ("detected_at", "batch_id", "writer")]


def _write(rows: DataFrame, root: str, table: KeyedTable, batch_id: int, writer: str) -> None:
    (
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
        .withColumns(
            {
                "event_date": F.to_date("window_start"),
                "writer": F.lit(writer),
                "batch_id": F.lit(batch_id).cast("long"),
            }
        )
        .hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_LAYOUT)
        .parquet(_folder(root, table))
    )


def first_wins(
    rows: DataFrame, existing_keys: DataFrame, table: KeyedTable, order: Sequence[Column]
) -> DataFrame:
    """The rows an insert-ignore would add: first per key, key not stored yet."""
    key = list(table.key)
    return _first_by(rows, key, order).join(existing_keys.select(*key), key, "left_anti")


def last_wins(versions: DataFrame, table: KeyedTable, order: Sequence[Column]) -> DataFrame:
    """The rows an upsert would leave: the newest version per key."""
    return _first_by(versions, table.key, order)


def insert_ignore(
    rows: DataFrame,
    root: str,
    table: KeyedTable,
    batch_id: int,
    writer: str = "main",
    order: Sequence[str] = ("detected_at",),
    on_new: Callable[[DataFrame], None] | None = None,
) -> None:
    """Store rows whose key is new; the first row of a key wins and stays.

    Only the keys of the dates that the batch touches are read back.
    ``on_new`` gets the rows stored, once they are.
    """
    held = rows.persist()
    try:
        dates = touched_dates(held)
        if not dates:
            return
        own_later = (F.col("writer") == writer) & (F.col("batch_id") >= batch_id)
        before = _stored(rows.sparkSession, root, table, dates).filter(~own_later)
        fresh = first_wins(held, before, table, [F.col(c) for c in order])
        if on_new is None:
            _write(fresh, root, table, batch_id, writer)
            return
        fresh = fresh.persist()
        try:
            _write(fresh, root, table, batch_id, writer)
            on_new(fresh)
        finally:
            fresh.unpersist()
    finally:
        held.unpersist()


def _all_fields(tables: Sequence[KeyedTable]) -> dict[str, T.StructField]:
    return {f.name: f for table in tables for f in table.schema.fields}


def _tagged_key(tables: Sequence[KeyedTable]) -> Column:
    """The key of a row of any of the tables, as texts: its columns depend on the table."""
    key = F.lit(None).cast("array<string>")
    for table in tables:
        own = F.array(*[F.col(c).cast("string") for c in table.key])
        key = F.when(F.col(_TABLE) == table.name, own).otherwise(key)
    return key


def insert_ignore_tagged(
    rows: DataFrame,
    root: str,
    tables: Sequence[KeyedTable],
    batch_id: int,
    touched: Mapping[str, Sequence[date]],
    writer: str = "main",
    order: Sequence[str] = ("detected_at",),
) -> None:
    """`insert_ignore` for rows of several tables, told apart by ``target_table``, in one pass.

    ``rows`` has the columns of all tables, ``touched`` the dates of theirs by
    table. One anti join by table and key, one write with the table as a folder.
    """
    spark = rows.sparkSession
    if not any(touched.values()):
        return
    own_later = (F.col("writer") == writer) & (F.col("batch_id") >= batch_id)
    stored = None
    for table in tables:
        if touched.get(table.name):
            there = _stored(spark, root, table, sorted(touched[table.name])).filter(~own_later)
            keys = there.withColumn(_TABLE, F.lit(table.name)).select(_TABLE, _tagged_key([table]).alias("_key"))
            stored = keys if stored is None else stored.unionByName(keys)
    fresh = _first_by(rows.withColumn("_key", _tagged_key(tables)), [_TABLE, "_key"], [F.col(c) for c in order])
    fields = _all_fields(tables)
    (
        fresh.join(stored, [_TABLE, "_key"], "left_anti")
        .select(_TABLE, *[F.col(n).cast(f.dataType).alias(n) for n, f in fields.items()])
        .withColumns(
            {
                "event_date": F.to_date("window_start"),
                "writer": F.lit(writer),
                "batch_id": F.lit(batch_id).cast("long"),
            }
        )
        .hint("rebalance", _TABLE, "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(_TABLE, *_LAYOUT)
        .parquet(root)
    )


def upsert(
    rows: DataFrame,
    root: str,
    table: KeyedTable,
    batch_id: int,
    writer: str = "main",
    order: Sequence[str] = ("detected_at",),
    only_changes: bool = False,
) -> None:
    """Store the batch's last version of each key; readers take the newest over all batches.

    Nothing is read back, so the cost of a batch is its own size. With
    ``only_changes`` the touched dates are read, and versions that differ from
    the stored one in nothing but the detection time are left out.
    """
    latest = last_wins(rows, table, [F.desc(c) for c in order])
    if not only_changes:
        _write(latest, root, table, batch_id, writer)
        return
    held = latest.persist()
    try:
        own_later = (F.col("writer") == writer) & (F.col("batch_id") >= batch_id)
        dates = touched_dates(held)
        before = _stored(rows.sparkSession, root, table, dates).filter(~own_later)
        names = [f.name for f in table.schema.fields if f.name != "detected_at"]
        # As stored: types of the table, so that equal values compare equal.
        new = held.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]
        ).alias("new")
        old = last_wins(before, table, _newest()).select(*names).alias("old")
        same = [F.col(f"new.{n}").eqNullSafe(F.col(f"old.{n}")) for n in names]
        _write(new.join(old, same, "left_anti"), root, table, batch_id, writer)
    finally:
        held.unpersist()


def read_inserted(
    spark: SparkSession,
    root: str,
    table: KeyedTable,
    since: Column | None = None,
    until: Column | None = None,
) -> DataFrame:
    """Table filled by ``insert_ignore``: one row per key, the first by detection, writer and batch.

    ``since`` / ``until`` (dates) keep the scan to the folders of those days.
    """
    stored = _between(_stored(spark, root, table), since, until)
    return _first_by(stored, table.key, _oldest()).drop("writer", "batch_id")


def read_upserted(
    spark: SparkSession,
    root: str,
    table: KeyedTable,
    since: Column | None = None,
    until: Column | None = None,
) -> DataFrame:
    """Table filled by ``upsert``: newest version per key.

    Give ``since`` / ``until`` dates to read those days only.
    """
    stored = _between(_stored(spark, root, table), since, until)
    return last_wins(stored, table, _newest()).drop("writer", "batch_id")


def crowded_dates(spark: SparkSession, root: str, table: KeyedTable) -> list[date]:
    """Days of a table that more than one batch has written."""
    path, files = _files(spark, root, table)
    folder = path(_folder(root, table))
    days = []
    for day in files.listStatus(folder) if files.exists(folder) else []:
        name = day.getPath().getName()
        if name.startswith("event_date=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            writers = [w for w in files.listStatus(day.getPath()) if w.isDirectory()]
            if sum(len(files.listStatus(w.getPath())) for w in writers) > 1:
                days.append(date.fromisoformat(name.split("=")[1]))
    return sorted(days)


def compact(
    spark: SparkSession, root: str, table: KeyedTable, dates: Sequence[date], first: bool
) -> None:
    """Rewrite the folders of some dates as one batch: one row per key, few files.

    ``first`` says how the table is filled: first wins or last wins. The new
    batch is there before the folders it replaces go, and readers resolve keys,
    so a reader or a stop in between sees doubles at worst, which it resolves.
    Folders that a writer adds meanwhile stay.
    """
    path, files = _files(spark, root, table)
    for day in dates:
        folder = path(f"{_folder(root, table)}/event_date={day.isoformat()}")
        if not files.exists(folder):
            continue
        old = [
            batch.getPath()
            for writer in files.listStatus(folder)
            for batch in (files.listStatus(writer.getPath()) if writer.isDirectory() else [])
        ]
        batches = [int(p.getName().split("=")[1]) for p in old if "writer=compacted" in str(p.getParent())]
        stored = _stored(spark, root, table, [day])
        kept = _first_by(stored, table.key, _oldest() if first else _newest())
        _write(kept, root, table, max(batches, default=-1) + 1, "compacted")
        for batch in old:
            files.delete(batch, True)


def _between(stored: DataFrame, since: Column | None, until: Column | None) -> DataFrame:
    if since is not None:
        stored = stored.filter(F.col("event_date") >= since)
    if until is not None:
        stored = stored.filter(F.col("event_date") <= until)
    return stored
