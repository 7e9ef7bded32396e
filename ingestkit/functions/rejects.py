"""Bad input set apart.

A line or message that does not fit its schema is found in the scan itself:
Spark's corrupt-record column keeps its text.  ``checked`` frames have the
declared columns and one more, ``_reject``: null for a good row, else a struct of
file (of a scan; the topic of a message), text and reason.  The reason is
``columns`` (too few or too many cells), ``not JSON``, or ``value of <column>``,
the first column whose text does not convert; it is worked out for bad rows only.

``load_checked`` appends the good rows and counts both kinds in the same pass;
only if there are bad rows is the input read again to store them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestkit.functions.schema_text import as_struct
from ingestkit.sinks.tables import append_table, table_exists

CORRUPT = "_corrupt_text"
REJECT_SCHEMA = "file string, text string, reason string"


def _first_bad(cells: Column, schema: T.StructType, typed: Callable[[str], Column], other: str) -> Column:
    """``value of x`` for the first column with text but without a value."""
    reason = F.lit(other)
    for f in reversed(schema.fields):
        has_text = cells[f.name].isNotNull() & (F.trim(cells[f.name]) != "")
        reason = F.when(has_text & typed(f.name).isNull(), F.lit(f"value of {f.name}")).otherwise(reason)
    return reason


def _marked(file: Column, reason: Column) -> Column:
    bad = F.struct(file.alias("file"), F.col(CORRUPT).alias("text"), reason.alias("reason"))
    return F.when(F.col(CORRUPT).isNotNull(), bad).alias("_reject")


def read_delimited_checked(spark: SparkSession, path: str | list[str], schema: str | T.StructType, *, header: bool = False,
                           sep: str = ",", quote: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """A delimited scan with ``_reject``."""
    st = as_struct(schema)
    text = {"sep": sep} | ({"quote": quote} if quote is not None else {}) | (options or {})
    reader = spark.read.format("csv").schema(T.StructType([*st.fields, T.StructField(CORRUPT, T.StringType())])) \
        .option("header", str(bool(header)).lower()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    for k, v in text.items():
        reader = reader.option(k, v)
    rows = reader.load(path)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in st.fields])
    cells = F.from_csv(F.col(CORRUPT), ", ".join(f"`{f.name}` string" for f in as_text.fields), text)
    # with one cell more than columns a line that fits would have a null there
    extra = F.from_csv(F.col(CORRUPT), ", ".join(f"`c{i}` string" for i in range(len(st.fields) + 1)),
                       text | {"nullValue": "\u0000"})
    too_few = extra[f"c{len(st.fields) - 1}"].isNull()
    too_many = extra[f"c{len(st.fields)}"].isNotNull()
    reason = F.when(too_few | too_many, "columns").otherwise(_first_bad(cells, st, F.col, "columns"))
    return rows.select(*st.fieldNames(), _marked(F.col("_metadata.file_path"), reason))


def decode_json_checked(df: DataFrame, schema: str | T.StructType, *, column: str = "value", keep: Sequence[str] = (),
                        file: str | None = "topic", options: dict[str, str] | None = None) -> DataFrame:
    """JSON text (or UTF-8 bytes) expanded into columns, with ``_reject``.  A
    null message is a row of nulls, not a reject."""
    st = as_struct(schema)
    with_corrupt = T.StructType([*st.fields, T.StructField(CORRUPT, T.StringType())])
    source = F.col(file).cast("string") if file and file in df.columns else F.lit(None).cast("string")
    raw = F.col(column).cast("string")
    parsed = df.select(*keep, source.alias("__file"), F.from_json(raw, with_corrupt, {
        "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"} | (options or {})).alias("__data"))
    parsed = parsed.select(*keep, "__file", *[F.col("__data")[f].alias(f) for f in with_corrupt.fieldNames()])
    cells = F.from_json(F.col(CORRUPT), T.StructType([T.StructField(f.name, T.StringType()) for f in st.fields]))
    reason = F.when(F.try_parse_json(F.col(CORRUPT)).isNull(), "not JSON").otherwise(_first_bad(cells, st, F.col, "not an object"))
    return parsed.select(*keep, *st.fieldNames(), _marked(F.col("__file"), reason))


def split_rejects(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``_reject``, rejects as file, text, reason)."""
    good = checked.where(F.col("_reject").isNull()).drop("_reject")
    return good, checked.where(F.col("_reject").isNotNull()).select("_reject.*")


REPORT = "rows_read long, good_rows long, rejected_rows long"


def load_checked(checked: DataFrame, append: Callable[[DataFrame], None], reject_table: str) -> DataFrame:
    """``append`` gets the good rows; rejects are added to ``reject_table``
    (created on first use).  Returns rows_read, good_rows, rejected_rows."""
    spark = checked.sparkSession
    seen = Observation("checked")
    bad = F.col("_reject").isNotNull()
    counted = checked.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))
    append(split_rejects(counted)[0])
    n, n_bad = int(seen.get["n"]), int(seen.get["bad"])
    if n_bad:
        store_rejects(split_rejects(checked)[1], reject_table)
    return spark.createDataFrame([(n, n - n_bad, n_bad)], REPORT)


def store_rejects(rejects: DataFrame, reject_table: str) -> None:
    spark = rejects.sparkSession
    if not table_exists(spark, reject_table):
        spark.createDataFrame([], REJECT_SCHEMA).write.format("parquet").saveAsTable(reject_table)
    append_table(rejects, reject_table)
