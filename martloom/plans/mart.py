"""Staging rows to dimensions and facts: the batch's transforms, and where results are kept.

Each run of a batch writes folders of its own, `batch_date=<batch>/run=<run>`, below each table:

* a dimension's current rows, in hash buckets of their keys, for those buckets that the batch
  has keys of; the other buckets stay where earlier batches wrote them;
* the versions of a type 2 dimension that the batch closed;
* the facts that the batch added.

What a batch rewrites is thus bounded by the buckets it touches, whatever the size of the
dimension. Which folders make up the mart is said by the manifest alone, which is published
once for all tables when the last of them is written. A batch is computed from the mart as it was
after the batch before, so running it again, also after a failure half way, gives the same;
closed versions are never read by a merge, nor written again.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField

from martloom.functions import business_key
from martloom.operators.append import new_facts
from martloom.operators.dedup import latest_per_key
from martloom.operators.merge import Scd2, scd1_upsert, scd2_step
from martloom.operators.schema import conform
from martloom.operators.sizing import fits_broadcast
from martloom.plans.manifest import Snapshot, TableState, forget, latest, publish, snapshots
from martloom.plans.manifest import before as preceding
from martloom.plans.policy_mart import (
    ADDRESS,
    MAPPINGS,
    MART,
    ORGANIZATIONS,
    PAYMENT_METHOD,
    POLICY,
    POLICYHOLDER,
    PREMIUM_KEY,
    STAGING,
)
from martloom.sources.contract import Contract
from martloom.sources.tables import (
    Table,
    as_nullable,
    batch_slice,
    child_folders,
    create_table,
    drop_folder,
    empty_rows,
    is_committed,
    is_stream_sink,
    read_table,
    replace_partition,
    seed_table,
    truncate_table,
)

BATCH, RUN, BUCKET = "batch_date", "run", "bucket"
CURRENT, CLOSED = "is_current=true", "is_current=false"
BUCKETS = 16
# A reference table is seeded, not loaded, and so not emptied with the others.
KEPT = ("dim_organization",)
SOURCES = {
    "dim_policyholder": "basic",
    "dim_policy": "basic",
    "dim_address": "address",
    "dim_payment_method": "bankinfo",
    "fact_premiums": "premiums",
}
SCD2_TABLES: dict[str, Scd2] = {"dim_policyholder": POLICYHOLDER, "dim_policy": POLICY}
MERGES = {**SCD2_TABLES, "dim_address": ADDRESS, "dim_payment_method": PAYMENT_METHOD}


class BatchOutOfOrder(ValueError):
    """A later batch has already been merged."""


# --- the sources of the merges, from one batch of staging rows


NAMED_BY = ("policyholder_name",)


def fallback_columns(contract: Contract) -> tuple[str, ...]:
    """The contract's `match_fallback` as staging columns: first and last name are one there."""
    renamed = MAPPINGS["basic"].renamed
    names = {"first_name": "policyholder_name", "last_name": "policyholder_name"}
    found = [names.get(n, renamed.get(n, n)) for n in contract.match_fallback]
    return tuple(dict.fromkeys(found)) or NAMED_BY


def policyholder_rows(basic: DataFrame, fallback: Sequence[str] = NAMED_BY) -> DataFrame:
    """Rows under their business key. `fallback` names who has no identifier: a birth date may be added."""
    key = business_key(F.col("ssn_hash"), [F.col(c) for c in fallback], F.col("match_method"))
    return basic.select(
        key.alias("policyholder_business_key"),
        "org_code",
        "policyholder_name",
        "ssn_hash",
        "effective_date",
    )


def policy_rows(basic: DataFrame) -> DataFrame:
    return basic.select(
        "policy_number", "org_code", "policy_status", "issue_date", "effective_date"
    )


def premium_source(premiums: DataFrame, batch_date: date, load_date: date) -> DataFrame:
    stamped = premiums.withColumns(
        {"created_date": F.lit(load_date), BATCH: F.lit(batch_date)}
    )
    return stamped.select(*MART["fact_premiums"].schema.fieldNames())


# --- the transforms


def _measured(options: dict, rows: DataFrame) -> dict:
    """Rows before deduplication bound those after it, and are measured without a shuffle."""
    if options.get("broadcast_source") is None:
        options = options | {"broadcast_source": fits_broadcast(rows)}
    return options


def merge_policyholders(
    current: DataFrame,
    basic: DataFrame,
    batch_date: date,
    load_date: date,
    fallback: Sequence[str] = NAMED_BY,
    **options,
) -> DataFrame:
    rows = policyholder_rows(basic, fallback)
    source = latest_per_key(rows, POLICYHOLDER.keys, ["effective_date"])
    options = _measured(options, rows)
    return scd2_step(current, source, POLICYHOLDER, batch_date, load_date, **options)


def merge_policies(
    current: DataFrame, basic: DataFrame, batch_date: date, load_date: date, **options
) -> DataFrame:
    rows = policy_rows(basic)
    source = latest_per_key(rows, POLICY.keys, ["issue_date"])
    options = _measured(options, rows)
    return scd2_step(current, source, POLICY, batch_date, load_date, **options)


def merge_addresses(
    target: DataFrame, address: DataFrame, load_date: date, **options
) -> DataFrame:
    """The source is not cut to one row per key: two addresses of one type are an error."""
    rows = address.select(*ADDRESS.keys, *ADDRESS.attributes)
    return scd1_upsert(target, rows, ADDRESS, load_date, **_measured(options, rows))


def merge_payment_methods(
    target: DataFrame, bankinfo: DataFrame, load_date: date, **options
) -> DataFrame:
    rows = bankinfo.select(*PAYMENT_METHOD.keys, *PAYMENT_METHOD.attributes)
    options = _measured(options, rows)
    return scd1_upsert(target, rows, PAYMENT_METHOD, load_date, order=(), **options)


def new_premiums(
    facts: DataFrame, premiums: DataFrame, batch_date: date, load_date: date, **options
) -> DataFrame:
    return new_facts(
        premium_source(premiums, batch_date, load_date), facts, PREMIUM_KEY, **options
    )


# --- stored state


def create_mart(spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
    """The mart's folders and manifest; those that exist are left alone.

    `buckets` stays with the mart: about as many as the current rows of its largest dimension fill
    files of some hundred megabytes, or more where batches are small.
    """
    for table in MART.values():
        create_table(spark, table, root)
    if latest(spark, root) is None:
        publish(spark, root, None, buckets, {}, None)


def seed_organizations(spark: SparkSession, root: str, load_date: date) -> None:
    table = MART["dim_organization"]
    rows = [(*row, load_date, load_date) for row in ORGANIZATIONS]
    seed_table(spark.createDataFrame(rows, table.schema), table, root)


def _rows(spark: SparkSession, table: Table, root: str, folders: Sequence[str]) -> DataFrame:
    """Rows of some of a table's folders. Nothing else of it is listed or read."""
    if not folders:
        return empty_rows(spark, table.schema)
    schema = as_nullable(table.schema)
    if BATCH not in schema.fieldNames():
        schema = schema.add(StructField(BATCH, DateType()))
    path = table.path(root)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/{f}" for f in folders))
    return rows.select(*table.schema.fieldNames())


def read_mart(spark: SparkSession, name: str, root: str, snapshot: Snapshot | None = None) -> DataFrame:
    """A mart table as of its last batch, in its declared columns; or as of `snapshot`, so that
    several tables may be read as of the same batch while another one is published."""
    table = MART[name]
    if name == "dim_organization":
        return read_table(spark, table, root)
    snapshot = snapshot or latest(spark, root)
    return _rows(spark, table, root, snapshot.of(name).folders() if snapshot else ())


def read_mart_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables, as of one and the same batch."""
    snapshot = latest(spark, root)
    return {name: read_mart(spark, name, root, snapshot) for name in MART}


def truncate_mart(spark: SparkSession, root: str) -> None:
    """No rows in any table but the reference table."""
    last = latest(spark, root)
    publish(spark, root, None, last.buckets if last else BUCKETS, {}, last)
    for name, table in MART.items():
        if name not in KEPT:
            truncate_table(spark, table, root)


def expire_slices(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Drop what the mart after each of the last `keep` batches does not consist of: replaced buckets,
    and what failed and repeated runs have written. Not while a batch is run.

    The batch before the last is needed to run the last one again.
    """
    if keep < 2:
        raise ValueError("the state of the last two batches must be kept")
    kept: list[Snapshot] = []
    for snapshot in reversed(snapshots(spark, root)):
        if len(kept) < keep and snapshot.batch not in {s.batch for s in kept}:
            kept.append(snapshot)
    forget(spark, root, kept)
    for name, table in MART.items():
        if name == "dim_organization":
            continue
        used = {folder for snapshot in kept for folder in snapshot.of(name).folders()}
        for batch, of_batch in child_folders(spark, table.path(root), BATCH).items():
            for run in child_folders(spark, of_batch, RUN):
                for part in _parts(spark, table, root, f"{BATCH}={batch}/{RUN}={run}"):
                    if part not in used:
                        drop_folder(spark, f"{table.path(root)}/{part}")


def _parts(spark: SparkSession, table: Table, root: str, run: str) -> list[str]:
    """The folders of a run that the manifest speaks of one by one."""
    if table.name == "fact_premiums":
        return [run]
    current = f"{run}/{CURRENT}" if table.name in SCD2_TABLES else run
    parts = [f"{current}/{BUCKET}={b}" for b in child_folders(spark, f"{table.path(root)}/{current}", BUCKET)]
    return [*parts, f"{run}/{CLOSED}"] if table.name in SCD2_TABLES else parts


def _staged(spark: SparkSession, file_type: str, root: str, batch_date: date) -> DataFrame:
    """The batch's staging rows. Only their folders are listed."""
    table = STAGING[file_type]
    path = table.path(root)
    by_org = child_folders(spark, path, "org_code")
    if is_stream_sink(spark, path):
        return batch_slice(read_table(spark, table, root), batch_date)
    folders = [f"{folder}/{BATCH}={batch_date}" for folder in by_org.values()]
    folders = [folder for folder in folders if is_committed(spark, folder)]
    if not folders:
        return empty_rows(spark, table.schema)
    reader = spark.read.schema(as_nullable(table.schema)).option("basePath", path)
    return batch_slice(reader.parquet(*folders), batch_date)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(
    df: DataFrame, name: str, root: str, run: Mapping[str, object], keys: Sequence[str], buckets: int
) -> TableState:
    """A run's rows of one table; says where they are."""
    spark, table = df.sparkSession, MART[name]
    own = "/".join(f"{column}={value}" for column, value in run.items())
    rows = conform(df, table.schema)
    if name == "fact_premiums":
        replace_partition(rows, table, root, run, ("org_code",))
        return TableState(history=(own,))
    # Few files per bucket; buckets too big for one task are split, small ones share tasks.
    rows = rows.withColumn(BUCKET, _bucket(keys, buckets)).hint("rebalance", F.col(BUCKET))
    within = ("is_current", BUCKET) if name in SCD2_TABLES else (BUCKET,)
    replace_partition(rows, table, root, run, within)
    parts = _parts(spark, table, root, own)
    current = {int(part.rpartition("=")[2]): part for part in parts if not part.endswith(CLOSED)}
    has_closed = name in SCD2_TABLES and "false" in child_folders(
        spark, f"{table.path(root)}/{own}", "is_current"
    )
    return TableState(current, (f"{own}/{CLOSED}",) if has_closed else ())


def transform_table(
    spark: SparkSession,
    name: str,
    staging_root: str,
    mart_root: str,
    batch_date: date,
    load_date: date,
    fallback: Sequence[str] = NAMED_BY,
    base: Snapshot | None = None,
) -> TableState:
    """Compute one mart table after the batch, and write what the batch changes. It is not part of the
    mart before `publish` says so. The tables do not depend on each other.

    `base` is the mart the batch is merged into. `fallback` are the staging columns that tell
    people without identifier apart; see `fallback_columns` for what a contract says. It must not
    change between batches of a mart.
    """
    base = base or base_of(spark, mart_root, batch_date)
    table, held = MART[name], base.of(name)
    run = {BATCH: batch_date, RUN: f"r{uuid.uuid4().hex[:12]}"}
    staged = _staged(spark, SOURCES[name], staging_root, batch_date)
    if name == "fact_premiums":
        facts = _rows(spark, table, mart_root, held.history)
        if held.history:
            added = new_premiums(facts, staged, batch_date, load_date)
        else:  # nothing is held, so there is nothing to join
            added = premium_source(staged, batch_date, load_date).distinct()
        written = _write(added, name, mart_root, run, PREMIUM_KEY, base.buckets)
        return TableState(history=(*held.history, *written.history))

    keys = MERGES[name].keys
    rows = policyholder_rows(staged, fallback) if name == "dim_policyholder" else staged
    touched = {row[0] for row in rows.select(_bucket(keys, base.buckets)).distinct().collect()}
    before = _rows(spark, table, mart_root, [f for b, f in held.current.items() if b in touched])
    options = {} if held.current else {"broadcast_source": False}
    if name == "dim_address":
        after = merge_addresses(before, staged, load_date, **options)
    elif name == "dim_payment_method":
        after = merge_payment_methods(before, staged, load_date, **options)
    elif name == "dim_policyholder":
        after = merge_policyholders(before, staged, batch_date, load_date, fallback, **options)
    else:
        after = merge_policies(before, staged, batch_date, load_date, **options)
    written = _write(after, name, mart_root, run, keys, base.buckets)
    untouched = {b: f for b, f in held.current.items() if b not in touched}
    return TableState({**untouched, **written.current}, (*held.history, *written.history))


def base_of(spark: SparkSession, root: str, batch_date: date) -> Snapshot:
    """The mart that a batch is merged into, unless a later batch has been."""
    known = snapshots(spark, root)
    if not known:
        raise FileNotFoundError(f"no mart at {root}")
    last = known[-1]
    if last.batch and last.batch > batch_date:
        raise BatchOutOfOrder(f"{root} already has batch {last.batch}, later than {batch_date}")
    # What was published before the mart was emptied is not merged into.
    emptied = max((i for i, s in enumerate(known) if s.batch is None), default=0)
    return preceding(known[emptied:], batch_date)
