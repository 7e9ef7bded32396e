"""Files of tables: listing, moving and locations, through Hadoop's file
system API, so that any store that Spark reads will do.  Only names and sizes
pass through the driver."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _path(spark, path)
    return bool(fs.exists(where))


def listed(spark: SparkSession, folder: str) -> list[tuple[str, int, bool]]:
    """(name, bytes, is a folder) of everything visible in a folder, by name;
    nothing if there is no such folder."""
    fs, where = _path(spark, folder)
    if not fs.exists(where):
        return []
    found = [(s.getPath().getName(), int(s.getLen()), bool(s.isDirectory())) for s in fs.listStatus(where)]
    return sorted(x for x in found if not x[0].startswith(("_", ".")))


def all_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of everything in a folder, hidden things too."""
    fs, where = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    return [(name, size) for name, size, is_folder in listed(spark, folder) if not is_folder]


def make_folder(spark: SparkSession, folder: str) -> None:
    fs, where = _path(spark, folder)
    fs.mkdirs(where)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; one that was moved before stays as it is."""
    fs, where = _path(spark, source)
    if fs.exists(where) and not fs.rename(where, _path(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _path(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete as soon as it is visible."""
    fs, where = _path(spark, path)
    hidden = _path(spark, f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}")[1]
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(where, False)
    if not fs.rename(hidden, where):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _path(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location").rstrip("/")


def spec_sql(spec: dict[str, object]) -> str:
    """A partition spec as SQL: PARTITION (a = 1, b = 'x')."""
    def literal(v: object) -> str:
        if v is None:
            return "null"
        if isinstance(v, bool | int):
            return str(v).lower()
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "PARTITION (" + ", ".join(f"`{k}` = {literal(v)}" for k, v in spec.items()) + ")"


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_spec(text: str) -> dict[str, str | None]:
    """The values in a partition's name, e.g. ``a=1/b=x%2Fy``."""
    pairs = [x.split("=", 1) for x in text.split("/")]
    return {k: None if v == NULL_PARTITION else unquote(v) for k, v in pairs}


def partition_location(spark: SparkSession, name: str, spec: dict[str, object]) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {spec_sql(spec)}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location").rstrip("/")


def new_id(stem: str) -> str:
    return f"{stem}-{uuid.uuid4().hex[:16]}"
