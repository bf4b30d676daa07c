"""Checks on finished tables. An empty result, or a zero count, means no fault found."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.operators.dedup import duplicate_keys
from martloom.operators.merge import Scd2
from martloom.operators.skew import lookup_join


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def group_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def count_and_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(column).alias("max_value"))


def distinct_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys; a key with a NULL in it does not count."""
    return df.agg(F.count_distinct(*keys).alias("n_keys"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_nulls) of all the columns, in one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "n_nulls")


def multiple_current(df: DataFrame, spec: Scd2) -> DataFrame:
    """Keys with more than one current version."""
    return duplicate_keys(df.where(F.col(spec.current)), spec.keys)


def current_rows(dim: DataFrame, keys: Sequence[str], current: str, columns: Sequence[str]) -> DataFrame:
    return dim.where(F.col(current)).select(*keys, *columns)


def fact_dim_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    current: str = "is_current",
    **options,
) -> DataFrame:
    """Facts with attributes of the current version; options as for `lookup_join`."""
    return lookup_join(fact, current_rows(dim, keys, current, columns), keys, **options)


def orphans(fact: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fact keys no version of the dimension has, and their facts. Counted before the join."""
    per_key = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_facts"))
    return per_key.join(dim.select(*keys).distinct(), list(keys), "left_anti")


def outside_domain(df: DataFrame, column: str, domain: DataFrame, domain_column: str) -> DataFrame:
    """Values, with row counts, that the reference table lacks. NULL belongs to no domain."""
    values = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    allowed = domain.select(F.col(domain_column).alias("value")).distinct()
    return values.join(allowed, "value", "left_anti")


def outside_list(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """As `outside_domain`, against a short list of literals."""
    values = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return values.where(F.col("value").isNull() | ~F.col("value").isin(*allowed))


def column_report(
    df: DataFrame, target: StructType, forbidden: Sequence[str] = ()
) -> DataFrame:
    """(column_name, status, n_nulls) for each column the target asks for, or the table has.

    Status is ok, missing, retyped, has_nulls, forbidden or extra.
    """
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f for f in target}
    status = {name: "missing" for name in want if name not in have}
    for name, data_type in have.items():
        if name in forbidden:
            status[name] = "forbidden"
        elif name not in want:
            status[name] = "extra"
        elif want[name].dataType != data_type:
            status[name] = "retyped"
        else:
            status[name] = "ok"
    required = [n for n, f in want.items() if not f.nullable]

    name = F.col("column_name")
    shape = F.create_map(*[F.lit(x) for pair in status.items() for x in pair])
    absent = [n for n, s in status.items() if s == "missing"]
    rows = null_counts(df, df.columns).select("column_name", "n_nulls")
    if absent:
        missing = df.sparkSession.createDataFrame(
            [(n, None) for n in absent], "column_name string, n_nulls bigint"
        )
        rows = rows.unionByName(missing)
    found = shape[name]
    has_nulls = (found == "ok") & name.isin(*required) & (F.col("n_nulls") > 0)
    return rows.select(
        name, F.when(has_nulls, F.lit("has_nulls")).otherwise(found).alias("status"), "n_nulls"
    )


def interval_faults(dim: DataFrame, spec: Scd2) -> DataFrame:
    """Where versions of a key overlap, or leave a gap: (keys, at_date, fault).

    Each version marks the date it starts and the date after its end. If no two versions
    share a start or an end, every end is taken up by a start, no version ends before it
    starts and at most one is open, then the versions of a key form a single chain. Counting
    marks per key and date needs no window, so a key with a very long history is still
    spread over many tasks.
    """
    start, end = F.col(spec.start), F.col(spec.end)
    marks = dim.select(
        *spec.keys,
        F.explode(
            F.array(
                F.struct(
                    start.alias("at_date"), F.lit(1).alias("starts"), F.lit(0).alias("ends"),
                    F.when(end < start, 1).otherwise(0).alias("reversed"),
                ),
                F.struct(
                    F.date_add(end, 1).alias("at_date"), F.lit(0).alias("starts"), F.lit(1).alias("ends"),
                    F.lit(0).alias("reversed"),
                ),
            )
        ).alias("mark"),
    ).select(*spec.keys, "mark.*")
    # An open version ends at no date: its mark, at NULL, counts open versions.
    counted = marks.groupBy(*spec.keys, "at_date").agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), F.sum("reversed").alias("reversed")
    )
    is_open = F.col("at_date").isNull()
    faults = F.array_compact(
        F.array(
            F.when(~is_open & (F.col("starts") > 1), F.lit("several_starts")),
            F.when(~is_open & (F.col("ends") > 1), F.lit("several_ends")),
            F.when(~is_open & (F.col("ends") > 0) & (F.col("starts") == 0), F.lit("no_successor")),
            F.when(F.col("reversed") > 0, F.lit("ends_before_start")),
            F.when(is_open & (F.col("ends") > 1), F.lit("several_open")),
        )
    )
    return counted.select(*spec.keys, "at_date", F.explode(faults).alias("fault"))


def content_report(df: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, status) of the rows in which a reference table is not as it should be: missing,
    unexpected, changed, or repeated. Columns are those of `expected`; NULL equals NULL."""
    keys, values = list(keys), [c for c in expected.columns if c not in keys]

    def summed(rows: DataFrame, side: str) -> DataFrame:
        named = [F.col(k).alias(f"{k}_{side}") for k in keys]
        return rows.groupBy(*named).agg(
            F.count(F.lit(1)).alias(f"n_{side}"), F.min(F.struct(*values)).alias(f"row_{side}")
        )

    want, have = summed(expected, "want"), summed(df.select(*expected.columns), "have")
    on = [F.col(f"{k}_want").eqNullSafe(F.col(f"{k}_have")) for k in keys]
    met = want.join(have, on, "full_outer")
    status = (
        F.when(F.col("n_have").isNull(), "missing")
        .when(F.col("n_want").isNull(), "unexpected")
        .when(F.col("n_have") > F.col("n_want"), "repeated")
        .when(~F.col("row_have").eqNullSafe(F.col("row_want")), "changed")
    )
    names = [F.coalesce(f"{k}_want", f"{k}_have").alias(k) for k in keys]
    return met.select(*names, status.alias("status")).where(F.col("status").isNotNull())


def implausible_counts(
    tables: Mapping[str, DataFrame],
    bounds: Mapping[str, tuple[int | None, int | None]],
    ascending: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """(table_name, n_rows, fault) of tables with fewer or more rows than their bounds, or, for
    pairs of `ascending`, of a table that should have fewer rows than another and does not."""
    counts = row_counts(tables)
    checks = [
        F.when((F.col("table_name") == name) & (F.col("n_rows") < low), F.lit("too_few"))
        for name, (low, _) in bounds.items()
        if low is not None
    ]
    checks += [
        F.when((F.col("table_name") == name) & (F.col("n_rows") > high), F.lit("too_many"))
        for name, (_, high) in bounds.items()
        if high is not None
    ]
    found = counts.withColumn("fault", F.coalesce(*checks, F.lit(None).cast("string")))
    found = found.where(F.col("fault").isNotNull())
    for fewer, more in ascending:
        # Two rows of counts.
        pair = counts.where(F.col("table_name").isin(fewer, more)).agg(
            F.max(F.when(F.col("table_name") == fewer, F.col("n_rows"))).alias("n_rows"),
            F.max(F.when(F.col("table_name") == more, F.col("n_rows"))).alias("other"),
        )
        found = found.unionByName(
            pair.where("n_rows >= other").select(
                F.lit(fewer).alias("table_name"), "n_rows", F.lit(f"not_below_{more}").alias("fault")
            )
        )
    return found
