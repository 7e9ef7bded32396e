"""JSON payload columns.

``decode_json`` is ``from_json`` followed by struct expansion: text that
does not parse gives a row of nulls (the row is kept), a missing field or
a value of the wrong type gives null in that field, extra keys are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestkit.functions.schema_text import as_struct

# Written timestamps keep their microseconds (the default pattern stops at
# milliseconds); reading follows Spark's own rules.
WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def decode_json(df: DataFrame, schema: str | T.StructType, *, column: str = "value",
                keep: Sequence[str] = (), options: dict[str, str] | None = None) -> DataFrame:
    """Expand the JSON text (or UTF-8 bytes) in ``column`` into columns."""
    parsed = F.from_json(F.col(column).cast("string"), as_struct(schema), options or {})
    return df.select(*keep, parsed.alias("data")).select(*keep, "data.*")


def encode_json(df: DataFrame, columns: Sequence[str] | None = None, *,
                alias: str | None = None) -> F.Column:
    """A JSON text column holding ``columns`` (default: all) of each row."""
    text = F.to_json(F.struct(*(columns or df.columns)), WRITE_OPTIONS)
    return text.alias(alias) if alias else text
