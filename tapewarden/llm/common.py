"""Helpers shared by the text operators: tables, row-wise annotation, bounded samples, shared folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: What a contract calls a word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that go to a Python worker at once take about so much, a longer text apart.
BATCH = "1m"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def annotate(
    docs: DataFrame,
    make: Callable[[], Callable[[list[str]], Mapping[str, Sequence[Any]]]],
    fields: str,
    text: str = "text",
) -> DataFrame:
    """`docs` with further columns that follow from the text of each row alone.

    `make()` is called once in each task and returns a function from texts (null
    as "") to columns. A column of `docs` that has the name of a new one is
    replaced. Arrow batches stream through, so a task holds one batch.
    """
    added = T._parse_datatype_string(fields)
    new = {f.name.lower() for f in added.fields}
    kept = [f for f in docs.schema.fields if f.name.lower() not in new or f.name == text]
    schema = T.StructType([f for f in kept if f.name.lower() not in new] + added.fields)
    passed = [f.name for f in kept if f.name.lower() not in new]
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = ["" if x is None else x for x in batch.column(text).to_pylist()]
            out = work(texts)
            columns = [batch.column(c) for c in passed]
            columns += [pa.array(out[f.name], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, names=passed + arrow.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


def seeded(*columns: Column | str, seed: int = 0) -> Column:
    """A hash of the columns, uniform over [0, 1), the same in every run."""
    return F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def sampled(rows: DataFrame, most: int, *by: str, seed: int = 0) -> DataFrame:
    """About `most` rows at most, chosen by a seeded hash; all of them if there are no more."""
    there = rows.count()
    if there <= most:
        return rows
    return rows.filter(seeded(*by, seed=seed) < F.lit(most / there))


def small_batches(spark: SparkSession) -> None:
    """Let rows go to Python workers in batches of BATCH, from now on in this session.

    A task holds a batch several times: in the JVM, as Arrow, as strings and as
    results. Spark's own bound is 64 MB or 10,000 rows, and workers keep what
    they once took. Results do not depend on it, but for the letter model of
    toxicity, which reads the texts of a batch as one. A session that has a bound
    of its own keeps it.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None:
        spark.conf.set(bound, BATCH)


def crc_mod(column: str, by: int) -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(by))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, folder: str) -> DataFrame:
    """`rows` stored as a table in a shared folder and read again, which cuts their lineage."""
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def forget(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
