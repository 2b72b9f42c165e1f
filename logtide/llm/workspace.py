"""Written intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logtide.session import new_run_dir


class Workspace:
    """A folder for the steps of one job; ``drop`` removes a step no longer read.

    Tables are cut from their lineage by writing them, so a lost executor repeats
    only the tasks of the step it worked on.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, new_run_dir(spark, name)

    def path(self, step: str) -> str:
        return f"{self.root}/{step}"

    def saved(self, df: DataFrame, step: str) -> DataFrame:
        df.write.parquet(self.path(step))
        return self.spark.read.schema(df.schema).parquet(self.path(step))

    def drop(self, step: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(step))
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
