"""Shared helpers for the registered workloads."""

from __future__ import annotations

import contextlib
import time

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """Temp views named like the tables (what the SQL runner queries)."""
    frames = {}
    for name in names:
        df = table(spark, sf_dir, name)
        df.createOrReplaceTempView(name)
        frames[name] = df
    return frames


# Seconds spent on staging a workload's input (files, topics, tables), which
# the bench keeps apart from the operators' own time.
STAGED = {"seconds": 0.0}


@contextlib.contextmanager
def staging():
    began = time.perf_counter()
    try:
        yield
    finally:
        STAGED["seconds"] += time.perf_counter() - began
