"""A table of windows that triggers add to, in place of a state that holds every window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.operators.partials import Partials

#: Triggers after which the parts of windows are merged into one.
MERGE_EVERY = 16


@dataclass(frozen=True)
class WindowTable:
    """Parts of windows by trigger, merged now and then, under the checkpoint of a stream.

    The stream itself keeps no state. A trigger stores what its trades add to windows, late
    ones included, and reads back the windows of those symbols whose closed
    windows are new or have changed. A window is closed once a later one of the
    feed has begun. A repeated trigger sees what it saw the first time: it
    replaces its own folder and reads merged parts of earlier triggers only.
    """

    folder: str
    kind: Partials
    width: str

    def _listed(self, spark: SparkSession) -> tuple[object, dict[str, dict[int, object]]]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found: dict[str, dict[int, object]] = {"part": {}, "merged": {}, "horizon": {}}
        for status in files.listStatus(path) if files.exists(path) else []:
            kind, _, number = status.getPath().getName().partition("=")
            found.setdefault(kind, {})[int(number)] = status.getPath()
        return files, found

    def _read(self, spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def changed(self, trades: DataFrame, batch_id: int) -> DataFrame | None:
        """Store a trigger's trades; all closed windows of the symbols they change, or None if there are none."""
        spark = trades.sparkSession
        own = f"{self.folder}/part={batch_id}"
        self.kind.of_trades(trades, self.width).write.mode("overwrite").parquet(own)
        files, found = self._listed(spark)
        base = max((n for n in found["merged"] if n < batch_id), default=-1)
        self._clear(files, found, base)

        earlier = [n for n in found["horizon"] if n < batch_id]
        past = None
        if earlier:
            past = self._read(spark, [f"{self.folder}/horizon={max(earlier)}"], "at bigint").first()["at"]
        new = self._read(spark, [own], self.kind.schema)
        now = new.agg(F.max(F.unix_micros("window_start")).alias("at")).first()["at"]
        now = max((x for x in (past, now) if x is not None), default=None)
        if now is None:
            return None
        spark.createDataFrame([(now,)], "at bigint").coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/horizon={batch_id}"
        )
        parts = [n for n in found["part"] if base < n < batch_id]
        paths = [f"{self.folder}/part={n}" for n in sorted(parts)]
        paths += [f"{self.folder}/merged={base}"] * (base >= 0)
        old = self._read(spark, paths, self.kind.schema)
        if len(parts) >= MERGE_EVERY:
            self.kind.merged(old.unionByName(new)).write.mode("overwrite").parquet(f"{self.folder}/merged={batch_id}")

        is_closed = F.col("window_end") <= F.timestamp_micros(F.lit(now))
        just_closed = old.filter(is_closed if past is None else is_closed & (F.col("window_end") > F.timestamp_micros(F.lit(past))))
        symbols = just_closed.select("symbol").unionByName(new.filter(is_closed).select("symbol")).distinct()
        closed = old.unionByName(new).filter(is_closed).join(symbols, "symbol", "left_semi")
        return self.kind.whole(self.kind.merged(closed))

    def _clear(self, files, found: dict[str, dict[int, object]], base: int) -> None:
        """Drop what the newest merged parts of a finished trigger replace."""
        for kind, until in (("part", base), ("merged", base - 1)):
            for n, path in found[kind].items():
                if n <= until:
                    files.delete(path, True)
        for n in sorted(found["horizon"])[:-2]:
            files.delete(found["horizon"][n], True)
