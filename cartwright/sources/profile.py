"""Column profiles, schema fingerprints and drift, as distributed aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


#: Measures that one step counts: the code for those of many columns is too long for the JVM to compile.
_AT_ONCE = 24
# Patterns instead of casts: a failed cast costs an exception per value.
_SHORT_INT = r"^\s*[+-]?\d{1,18}\s*$"
_LONG_INT = r"^\s*[+-]?\d{19,}\s*$"
# A day, or an instant with an optional zone; nothing may follow.
_DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s?(Z|[+-]\d{2}:?\d{2})?)?$"
_DOUBLE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"


def _tests(value: Column) -> dict[str, Column]:
    # Most texts are no numbers: what is cheap and true of all that a pattern takes is asked before the pattern.
    size = F.octet_length(value)
    digit_or_sign = value < ":"
    infinite = value.startswith("i") | value.startswith("I")
    short_int = digit_or_sign & value.rlike(_SHORT_INT)
    long_int = digit_or_sign & (size >= 19) & value.rlike(_LONG_INT) & value.try_cast("bigint").isNotNull()
    day = digit_or_sign & (size >= 10) & (F.substring(value, 5, 1) == "-")
    return {
        "non_null": value.isNotNull(),
        "int_like": short_int | long_int,
        "double_like": short_int | ((digit_or_sign | infinite) & value.rlike(_DOUBLE)),
        "bool_like": size.between(4, 5) & F.lower(value).isin("true", "false"),
        # The pattern fixes the whole text; the cast refuses days and times that do not exist.
        "date_like": day & value.rlike(_DATE) & value.try_cast("timestamp").isNotNull(),
        "zoned": value.contains(":") & value.rlike(r"\d:\d.*(Z|[+-]\d{2}:?\d{2})$"),
    }


def measures(columns: list[str]) -> list[Column]:
    """``rows``, and for each column how many of its texts are present and read as each type."""
    counts = [
        F.count_if(test).alias(f"{position}_{name}")
        for position, column in enumerate(columns)
        for name, test in _tests(F.col(f"`{column}`").cast("string")).items()
    ]
    return [F.count(F.lit(1)).alias("rows"), *counts]


def observed(df: DataFrame) -> tuple[DataFrame, list[Observation]]:
    """``df`` with its ``measures`` counted wherever it is written, and what holds them then."""
    counts, seen = measures(df.columns), []
    for start in range(0, len(counts), _AT_ONCE):
        seen.append(Observation())
        df = df.observe(seen[-1], *counts[start : start + _AT_ONCE])
    return df, seen


def from_measures(spark: SparkSession, columns: list[str], found: dict[str, int]) -> DataFrame:
    """A column profile from counted ``measures``: one row a column."""
    names = list(_tests(F.lit("")))
    rows = [
        (position, column, found["rows"], *[found[f"{position}_{name}"] for name in names])
        for position, column in enumerate(columns)
    ]
    counts = ", ".join(f"{name} bigint" for name in names)
    return spark.createDataFrame(rows, f"position int, column_name string, row_count bigint, {counts}")


def column_profile(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per column: how many texts are present and how many read as each type.

    One aggregate over the rows as they are; its result, one row per group in ``by``, is turned into
    one row per group and column, numbered by ``position``.
    """
    by = by or []
    columns = [c for c in df.columns if c not in by]
    counted = df.groupBy(*by).agg(*measures(columns))
    names = list(_tests(F.lit("")))
    each = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(column).alias("column_name"),
                F.col("rows").alias("row_count"),
                *[F.col(f"{position}_{name}").alias(name) for name in names],
            )
            for position, column in enumerate(columns)
        ]
    )
    # Without groups an empty table has one row of counts, and no profile.
    return counted.where("rows > 0").select(*by, F.inline(each))


def with_dtype(profile: DataFrame, dates: list[str] = (), texts: list[str] = ()) -> DataFrame:
    """Add the type a column's texts imply.

    ``dates`` are columns declared to hold dates or instants, ``texts`` columns that are
    text whatever they contain. A blank in a column of whole numbers makes it fractional,
    because it is then stored as floating point: the type depends on the values.
    """

    def named(columns) -> Column:
        tests = [F.col("column_name") == c for c in columns]
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    full = F.col("non_null") == F.col("row_count")

    def every(measure: str) -> Column:
        return F.col(measure) == F.col("non_null")

    # The type names a stored fingerprint is made of.
    dtype = (
        F.when(named(texts), "object")
        .when(named(dates) & every("date_like") & every("zoned"), "datetime64[ns, UTC]")
        .when(named(dates) & every("date_like"), "datetime64[ns]")
        .when(F.col("non_null") == 0, "float64")
        .when(every("bool_like"), F.when(full, "bool").otherwise("object"))
        .when(every("int_like"), F.when(full, "int64").otherwise("float64"))
        .when(every("double_like"), "float64")
        .otherwise("object")
    )
    return profile.withColumn("dtype", dtype)


def fingerprint(typed_profile: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Schema fingerprint per group: first 16 hex digits of SHA-256 over ``name:dtype|…``."""
    by = by or []
    # The list is as long as the table is wide, however many rows it has.
    ordered = F.array_sort(
        F.collect_list(F.struct("position", "column_name", "dtype"))
    )
    grouped = typed_profile.groupBy(*by).agg(ordered.alias("_c"))
    signature = F.array_join(
        F.transform("_c", lambda c: F.concat(c["column_name"], F.lit(":"), c["dtype"])), "|"
    )
    names = F.array_join(F.transform("_c", lambda c: c["column_name"]), ",")
    return grouped.select(
        *by,
        F.substring(F.sha2(signature, 256), 1, 16).alias("schema_hash"),
        names.alias("schema_columns"),
    )


def drift(fingerprints: DataFrame, entity: str = "entity", dt: str = "dt") -> DataFrame:
    """Compare each day's fingerprint with the entity's previous one."""
    days = Window.partitionBy(entity).orderBy(dt)
    previous = F.lag("schema_hash").over(days)
    return fingerprints.withColumn("previous_hash", previous).withColumn(
        "drifted",
        F.col("previous_hash").isNotNull() & (F.col("previous_hash") != F.col("schema_hash")),
    )
