"""Schema text ("name:type,name:type") -> StructType, and typed projection.

The text format is the one the ingest jobs take as their declared
schema.  Parsing follows the original rules exactly (case-sensitive type
words, nothing trimmed inside the text, unknown words read as string) so
that existing schema files keep producing the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type words the schema text understands, in the order the
# format documents them.  Any other word (including "int", "bigint",
# "decimal", " integer" with a blank) maps to string.
TYPE_WORDS: dict[str, T.DataType] = {
    "byte": T.ByteType(),
    "short": T.ShortType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


class SchemaTextError(ValueError):
    """A declaration without ':' or without a type word."""


def _split_dropping_trailing_empty(text: str, sep: str) -> list[str]:
    # Same contract as java.lang.String#split(regex) with a literal
    # separator: trailing empty pieces are removed; no match keeps the text.
    if text == "":
        return [""]
    parts = text.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def parse_schema_text(text: str | list[str]) -> T.StructType:
    """Parse schema text into a StructType with nullable fields.

    ``text`` may be a list of lines; lines are joined with no separator and
    the whole is stripped, as when the text is read from a schema file.
    """
    if isinstance(text, (list, tuple)):
        text = "".join(text)
    text = text.strip()
    fields = []
    for decl in _split_dropping_trailing_empty(text, ","):
        colon = decl.find(":")
        if colon < 0:
            raise SchemaTextError(f"declaration {decl!r} has no ':'")
        pieces = _split_dropping_trailing_empty(decl, ":")
        if len(pieces) < 2:
            raise SchemaTextError(f"declaration {decl!r} has no type")
        name = decl[:colon]
        dtype = TYPE_WORDS.get(pieces[1], T.StringType())
        fields.append(T.StructField(name, dtype, nullable=True))
    return T.StructType(fields)


def as_struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else parse_schema_text(schema)


def typed_columns(df: DataFrame, schema: str | T.StructType) -> list[Column]:
    """Columns of ``df`` taken by position and converted to ``schema``.

    Conversion uses ``try_cast`` so that a bad cell becomes null instead of
    failing the job (the permissive reading the format always had).  Missing
    trailing columns are null; extra source columns are dropped.
    """
    st = as_struct(schema)
    cols = []
    for i, field in enumerate(st.fields):
        if i < len(df.columns):
            src = F.col(f"`{df.columns[i]}`")
            cols.append(src.try_cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return cols


def apply_schema(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Schema-on-read: project ``df`` onto ``schema`` (one narrow Project)."""
    return df.select(*typed_columns(df, schema))


def all_string_schema(schema: str | T.StructType) -> T.StructType:
    """The all-string twin of a schema (for reading raw text first)."""
    st = as_struct(schema)
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in st.fields])
