"""Facts in parts, one folder per batch, each with a sketch of its keys beside it.

A batch is compared with the sketches first, and then with those parts only that may hold one of
its keys: the others are neither listed nor read, however long the history is. A part is written
before its sketch, and one without a finished sketch is always opened, so a failure in between costs
time only. A part that is written again replaces its rows and its sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from martloom.operators.append import new_facts
from martloom.operators.sketch import key_sketch, parts_that_may_hold
from martloom.sources.tables import child_folders, drop_folder, empty_rows, escaped, is_committed

PART = "part"


def _sketches(path: str) -> str:
    return f"{path.rstrip('/')}/_sketches"


def parts(spark: SparkSession, path: str) -> dict[str, str]:
    """Name to folder, of the parts that are complete."""
    found = child_folders(spark, path, PART)
    return {name: folder for name, folder in sorted(found.items()) if is_committed(spark, folder)}


def read_parts(spark: SparkSession, path: str, folders: Sequence[str], like: DataFrame) -> DataFrame:
    if not folders:
        return empty_rows(spark, like.schema)
    return spark.read.schema(like.schema).parquet(*folders)


def parts_to_open(batch: DataFrame, path: str, keys: Sequence[str], *, dense: bool, part: str) -> dict[str, str]:
    """The other parts that may hold a key of the batch."""
    spark = batch.sparkSession
    others = {name: folder for name, folder in parts(spark, path).items() if name != part}
    known = {
        name: folder
        for name, folder in child_folders(spark, _sketches(path), PART).items()
        if name in others and is_committed(spark, folder)
    }
    told = []
    if known:
        kinds = "part string, run long, slots binary"
        sketches = spark.read.schema(kinds).option("basePath", _sketches(path)).parquet(*known.values())
        told = parts_that_may_hold(sketches, key_sketch(batch, keys, dense=dense))
    return {name: folder for name, folder in others.items() if name in told or name not in known}


def append_part(
    batch: DataFrame, path: str, part: str, keys: Sequence[str], *, dense: bool = False, **options
) -> DataFrame:
    """Add the batch's new facts as a part, and return them. `options` are those of `new_facts`."""
    spark = batch.sparkSession
    opened = parts_to_open(batch, path, keys, dense=dense, part=part)
    held = read_parts(spark, path, list(opened.values()), batch)
    folder = f"{path.rstrip('/')}/{PART}={escaped(part)}"
    sketch = f"{_sketches(path)}/{PART}={escaped(part)}"
    drop_folder(spark, sketch)  # it may not tell of rows that are about to be replaced
    marked = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    added = new_facts(batch, held, keys, **options) if opened else new_facts(batch, held, keys, broadcast_keys=True)
    added.write.mode("overwrite").option(marked, "true").parquet(folder)
    written = read_parts(spark, path, [folder], batch)
    key_sketch(written, keys, dense=dense).write.mode("overwrite").option(marked, "true").parquet(sketch)
    return written
