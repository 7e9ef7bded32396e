"""Intermediate results as Parquet under the work root.

Unlike a checkpointed frame, a table read back has no known partitioning: a join
on it shuffles both sides, which lets AQE split the rows of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ingestkit.session import remove_folder, scratch_dir, work_root


class Stage:
    """``stage(df, name)`` stores a frame and reads it back; ``finish(df)``
    checkpoints the result and removes what was stored for it."""

    def __init__(self, spark: SparkSession):
        work_root(spark)
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def finish(self, result: DataFrame) -> DataFrame:
        result = result.checkpoint()
        while self.paths:
            remove_folder(self.spark, self.paths.pop())
        return result
