"""What a mart consists of: one small file per published batch, read by everybody.

`_batches/<number>.json` names, for each table, the folders that make it up after a batch: the folder
that holds each bucket of its current rows, and the folders of closed versions or facts. A batch writes
new folders only and publishes all its tables by writing one such file, last. Until then, and if it fails
half way, readers see the batch before in all tables; afterwards all tables change at once.

An entry that was cut off while it was written does not count. Of two runs that publish at once one fails.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import SparkSession

from martloom.sources.tables import drop_folder, numbered_texts, write_new


class PublishedMeanwhile(RuntimeError):
    """Another run has published since this one looked."""


@dataclass(frozen=True)
class TableState:
    """Folders below the table's own: of current rows by bucket, and of rows that stay as they are."""

    current: Mapping[int, str] = field(default_factory=dict)
    history: tuple[str, ...] = ()

    def folders(self) -> tuple[str, ...]:
        return (*self.current.values(), *self.history)


@dataclass(frozen=True)
class Snapshot:
    """A mart after a batch; without a batch, an empty one."""

    number: int
    batch: date | None
    buckets: int
    tables: Mapping[str, TableState] = field(default_factory=dict)

    def of(self, name: str) -> TableState:
        return self.tables.get(name, TableState())


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/_batches"


def snapshots(spark: SparkSession, root: str) -> list[Snapshot]:
    """All that are kept, oldest first."""
    found = []
    for number, text in numbered_texts(spark, _folder(root)).items():
        try:
            document = json.loads(text)
        except ValueError:
            continue
        tables = {
            name: TableState({int(b): f for b, f in state["current"].items()}, tuple(state["history"]))
            for name, state in document["tables"].items()
        }
        batch = document["batch"] and date.fromisoformat(document["batch"])
        found.append(Snapshot(number, batch, document["buckets"], tables))
    return found


def latest(spark: SparkSession, root: str) -> Snapshot | None:
    return next(reversed(snapshots(spark, root)), None)


def before(known: list[Snapshot], batch: date) -> Snapshot:
    """The mart a batch is merged into: as it was after the last earlier batch."""
    earlier = [s for s in known if s.batch is None or s.batch < batch]
    return earlier[-1]


def publish(
    spark: SparkSession,
    root: str,
    batch: date | None,
    buckets: int,
    tables: Mapping[str, TableState],
    seen: Snapshot | None,
) -> Snapshot:
    """Make `tables` the mart, unless somebody else has published since `seen`."""
    numbers = list(numbered_texts(spark, _folder(root)))
    last = latest(spark, root)
    if (last and last.number) != (seen and seen.number):
        raise PublishedMeanwhile(f"{root}: {last} has been published meanwhile")
    number = max([0, *numbers]) + 1
    document = {
        "batch": batch and batch.isoformat(),
        "buckets": buckets,
        "tables": {
            name: {"current": {str(b): f for b, f in sorted(s.current.items())}, "history": list(s.history)}
            for name, s in tables.items()
        },
    }
    if not write_new(spark, f"{_folder(root)}/{number:08d}.json", json.dumps(document, indent=1)):
        raise PublishedMeanwhile(f"{root}: entry {number} has been published meanwhile")
    return Snapshot(number, batch, buckets, dict(tables))


def forget(spark: SparkSession, root: str, kept: list[Snapshot]) -> None:
    """Drop all entries but the kept ones."""
    numbers = {s.number for s in kept}
    for number in numbered_texts(spark, _folder(root)):
        if number not in numbers:
            drop_folder(spark, f"{_folder(root)}/{number:08d}.json")
