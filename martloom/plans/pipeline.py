"""A whole batch: landing files of several organisations into the mart."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import SparkSession

from martloom.plans.manifest import latest, publish
from martloom.plans.mart import NAMED_BY, SOURCES, base_of, create_mart, transform_table
from martloom.plans.policy_mart import CONTRACTS
from martloom.plans.staging import LoadCounts, load_file
from martloom.sources.contract import Contract

# Independent jobs sent to Spark at once, so that small ones do not leave executors idle.
CONCURRENT_JOBS = 8


def side_by_side(jobs: Iterable[Callable[[], object]]) -> list:
    """Run jobs side by side; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def load_batch(
    spark: SparkSession,
    files: Mapping[tuple[str, str], str],
    staging_root: str,
    batch_date: date,
    load_timestamp: datetime,
    contracts: Mapping[tuple[str, str], Contract] | None = None,
    **options,
) -> dict[tuple[str, str], LoadCounts]:
    """Load the files, given by (organisation, file type)."""

    def job(org: str, file_type: str, path: str) -> Callable[[], LoadCounts]:
        contract = (contracts or {}).get((org, file_type)) or CONTRACTS[file_type].for_org(org)
        return lambda: load_file(
            spark, path, contract, staging_root, batch_date, load_timestamp, **options
        )

    counts = side_by_side(job(org, file_type, path) for (org, file_type), path in files.items())
    return dict(zip(files, counts))


def transform_batch(
    spark: SparkSession,
    staging_root: str,
    mart_root: str,
    batch_date: date,
    load_date: date,
    fallback: Sequence[str] = NAMED_BY,
) -> None:
    """Bring every dimension and the facts up to the batch, all at once to their readers."""
    create_mart(spark, mart_root)
    seen = latest(spark, mart_root)
    base = base_of(spark, mart_root, batch_date)
    states = side_by_side(
        (
            lambda name=name: transform_table(
                spark, name, staging_root, mart_root, batch_date, load_date, fallback, base
            )
        )
        for name in SOURCES
    )
    publish(spark, mart_root, batch_date, base.buckets, dict(zip(SOURCES, states)), seen)


def run_batch(
    spark: SparkSession,
    files: Mapping[tuple[str, str], str],
    staging_root: str,
    mart_root: str,
    batch_date: date,
    load_timestamp: datetime,
    fallback: Sequence[str] = NAMED_BY,
    **options,
) -> dict[tuple[str, str], LoadCounts]:
    counts = load_batch(spark, files, staging_root, batch_date, load_timestamp, **options)
    transform_batch(spark, staging_root, mart_root, batch_date, load_timestamp.date(), fallback)
    return counts
