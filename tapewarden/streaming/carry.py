"""What a stream carries from trigger to trigger in a small table instead of a state store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Carried:
    """Summaries by key, one version a trigger, under the checkpoint of the stream.

    A trigger reads the version of the trigger before it and writes its own, so
    running it again after a stop gives the same result. Only the version that
    a repeated trigger would read is kept besides the newest.
    """

    folder: str
    schema: str

    def _versions(self, spark: SparkSession) -> tuple[object, dict[int, object]]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path):
            return files, {}
        names = [f.getPath() for f in files.listStatus(path)]
        return files, {int(p.getName().split("=")[1]): p for p in names if p.getName().startswith("batch_id=")}

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The newest version of an earlier trigger; no rows before the first one."""
        _, versions = self._versions(spark)
        earlier = [n for n in versions if n < batch_id]
        if not earlier:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.folder}/batch_id={max(earlier)}")

    def store(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/batch_id={batch_id}")
        files, versions = self._versions(rows.sparkSession)
        earlier = sorted(n for n in versions if n < batch_id)
        for n in earlier[:-1]:
            files.delete(versions[n], True)
