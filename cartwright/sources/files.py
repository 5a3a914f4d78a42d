"""Read CSV and JSON extracts with explicit types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.sources.entities import Entity

# Cell texts of a CSV extract that mean "missing".
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


# Fixed patterns: a plain day, and the zone at the end of an instant.
PLAIN_DAY = r"^\d{4}-\d{2}-\d{2}$"
ZONE = r"(Z|[+-]\d{2}:?\d{2})$"
# Tokens of JSON: the inside of a text, a number as the reader takes it.
JSON_TEXT = r'"((?:[^"\\]++|\\.)*+)"'
JSON_NUMBER = r"(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?|[+-]?INF|[+-]?Infinity|NaN)"
#: Outside texts: something nested in a row or other than arrays and rows, a quote of another kind, another encoding.
JSON_NOT_FLAT = r"[\x00\x22'\uFEFF\uFFFD]|\{[^{}\[\]]*+[\[{]|\[[^{}\[\]]*+\["


def read_text(
    spark: SparkSession,
    entity: Entity,
    paths: str | list[str],
    json_lines: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Read an extract with every column as text, in the columns the file itself has.

    A JSON array is one document per file and cannot be split; pass ``json_lines`` for
    extracts with one object per line, which can. Pass ``multi_line`` for CSV whose quoted
    fields hold line ends; such a file cannot be split either. The keys of JSON are taken
    from all objects, so that no key is missed: registered ones in their order, then others.
    """
    if entity.file_format == "csv":
        # Without inference all header columns are text, in file order.
        reader = spark.read.option("header", True).option("escape", '"')
        return reader.option("multiLine", multi_line).option("mode", "FAILFAST").csv(paths)
    reader = spark.read.option("multiLine", not json_lines).option("mode", "FAILFAST")
    found = reader.option("primitivesAsString", True).option("samplingRatio", 1.0).json(paths).schema
    known = [f.name for f in entity.schema]
    others = [f.name for f in found if f.name not in known]
    text_schema = T.StructType([T.StructField(name, T.StringType()) for name in [*known, *others]])
    if not json_lines:
        documents = spark.read.text(paths, wholetext=True)
        # Values that folders name are left to the reader of JSON.
        if documents.columns == ["value"] and _flat(documents):
            return _array_rows(documents, text_schema)
    return reader.schema(text_schema).json(paths)


def _flat(documents: DataFrame) -> bool:
    """Whether all documents are rows of plain values, such as a database or a provider dumps."""
    rest = F.regexp_replace("value", JSON_TEXT, "")
    return documents.where(rest.rlike(JSON_NOT_FLAT)).isEmpty()


def _array_rows(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of flat JSON documents, every value as the text it has there.

    The reader of JSON files goes back to the file for the digits of each number, a positional read a
    value; here numbers are quoted first, so that they are texts as they stand.
    """
    quoted = F.regexp_replace("value", f"{JSON_TEXT}|{JSON_NUMBER}", '"$1$2"')
    return documents.select(F.inline(F.from_json(quoted, T.ArrayType(schema), {"mode": "FAILFAST"})))


def _instant(value: Column) -> Column:
    """A text without a zone is taken as UTC, whatever the session zone is."""
    zone = (
        F.when(~value.rlike(r"\d:\d"), F.lit("T00:00:00Z"))
        .when(~value.rlike(ZONE), F.lit("Z"))
        .otherwise(F.lit(""))
    )
    return F.concat(value, zone).cast("timestamp")


def _typed(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, T.LongType):
        # Whole numbers written as decimals round half to even.
        whole = value.rlike(r"^[+-]?\d+$")
        return F.when(whole, value.cast("long")).otherwise(
            F.rint(value.cast("double")).cast("long")
        )
    if isinstance(data_type, T.TimestampType):
        return _instant(value)
    if isinstance(data_type, T.DateType):
        # The whole text counts: a day, or an instant whose day in UTC is taken.
        utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), _instant(value).cast("timestamp_ntz"))
        return F.when(value.rlike(PLAIN_DAY), value.cast("date")).otherwise(utc.cast("date"))
    return value.cast(data_type)


def typed(df: DataFrame, entity: Entity) -> DataFrame:
    """Cast text columns to the entity's types; a text that does not fit fails the read.

    Columns the registry does not know stay as text, after the others. A registered column
    that the extract lacks fails the read of CSV and is null in JSON.
    """
    types = {f.name: f.dataType for f in entity.schema}
    others = [c for c in df.columns if c not in types]
    columns = []
    for name in [*types, *others]:
        value = F.col(f"`{name}`")
        if entity.file_format == "csv":
            value = F.when(~value.isin(MISSING_TEXTS), value)
        columns.append(_typed(value, types.get(name, T.StringType())).alias(name))
    return df.select(*columns)


def read_entity(
    spark: SparkSession,
    entity: Entity,
    paths: str | list[str],
    json_lines: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    return typed(read_text(spark, entity, paths, json_lines, multi_line), entity)
