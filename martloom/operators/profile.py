"""Profiles of table parts that can be added up, so that a check reads new parts only.

A profile has one row per column: rows, NULLs, least and greatest value, and a sketch of the distinct
values. Profiles of parts merge into that of the whole, whatever the parts: counts add, extremes
and sketches combine. All but the number of distinct values is exact; that is marked approximate,
within about two percent. Kept beside the parts, they make a check of a long history an aggregate over a
few rows per part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    StructType,
)

from martloom.sources.tables import child_folders, escaped, is_committed

PROFILE = (
    "column_name string, n_rows long, n_nulls long, least string, greatest string, "
    "least_number decimal(38,10), greatest_number decimal(38,10), distinct_values binary"
)
PART = "part"
# Logarithm of a sketch's size.
PRECISION = 12


def _is_number(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (IntegralType, DecimalType))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, from one pass over `df`. Extremes of numbers are compared as numbers,
    of other values as text, for which dates and booleans order as they should."""
    kinds = (BooleanType, DateType, DecimalType, IntegralType, StringType)
    for name in columns:
        if not isinstance(df.schema[name].dataType, kinds):
            raise TypeError(f"{name}: {df.schema[name].dataType.simpleString()} has no profile")

    def of(name: str) -> Column:
        value = F.col(f"`{name}`")
        text = value.cast("string")
        number = value.cast("decimal(38,10)") if _is_number(df, name) else F.lit(None).cast("decimal(38,10)")
        shown = F.lit(None).cast("string") if _is_number(df, name) else text
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(value.isNull()).alias("n_nulls"),
            F.min(shown).alias("least"),
            F.max(shown).alias("greatest"),
            F.min(number).alias("least_number"),
            F.max(number).alias("greatest_number"),
            F.hll_sketch_agg(text, F.lit(PRECISION)).alias("distinct_values"),
        )

    wide = df.agg(F.array(*[of(name) for name in columns]).alias("columns"))
    return wide.select(F.inline("columns"))


def merged(profiles: DataFrame) -> DataFrame:
    """Profiles of parts as that of the whole."""
    return profiles.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.min("least_number").alias("least_number"),
        F.max("greatest_number").alias("greatest_number"),
        F.hll_union_agg("distinct_values").alias("distinct_values"),
    )


def readable(profiles: DataFrame) -> DataFrame:
    """With the sketch as the approximate number of distinct values."""
    distinct = F.coalesce(F.hll_sketch_estimate("distinct_values"), F.lit(0))
    return profiles.withColumn("approx_distinct", distinct).drop("distinct_values")


def profile_new_parts(
    spark: SparkSession, parts: dict[str, str], schema: StructType, columns: Sequence[str], kept: str
) -> list[str]:
    """Profile the parts (name to folder) that `kept` has no profile of; their names.

    A profile that was not finished is made again; to profile a part anew, drop its folder in `kept`.
    """
    known = {n for n, f in child_folders(spark, kept, PART).items() if is_committed(spark, f)}
    new = sorted(set(parts) - known)
    for name in new:
        rows = spark.read.schema(schema).parquet(parts[name])
        profile(rows, columns).write.mode("overwrite").option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true"
        ).parquet(f"{kept.rstrip('/')}/{PART}={escaped(name)}")
    return new


def kept_profiles(spark: SparkSession, kept: str, names: Sequence[str] | None = None) -> DataFrame:
    """The profiles of all parts, or of those named, with the part's name."""
    folders = child_folders(spark, kept, PART)
    chosen = [f for n, f in sorted(folders.items()) if (names is None or n in names) and is_committed(spark, f)]
    if not chosen:
        return spark.createDataFrame([], f"{PROFILE}, {PART} string")
    return spark.read.schema(f"{PROFILE}, {PART} string").option("basePath", kept).parquet(*chosen)
