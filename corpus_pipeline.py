"""From raw documents to token files, in five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs; all but the last return the columns of documents.

1. quality_rules: rejected documents go.
2. simhash_near_dedup: one document of each group of near-duplicates stays.
3. decontamination: documents that hold a passage of a benchmark item go.
4. source_mixing: documents are repeated, cut or left out so that sources meet their targets. A
   document may then stand in several rows, with the same doc_id.
5. token_orc: token ids in document order, with each row's place in the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import decontamination, mixing, quality_rules, simhash, token_orc
from martloom.llm.queries import END_ID, read
from martloom.sources.scratch import scratch_dir, stored, use_local_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.accepted(docs, read(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_orc.write_tokens(docs, path, token_orc.default_tokenizer(), END_ID)
    return token_orc.with_crc32(token_orc.read_tokens(spark, path))


def _runnable(stage: Stage) -> Stage:
    """The stage, also in a local session that names no shared folder."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        use_local_folder(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_rules", _runnable(quality_stage)),
    ("simhash_near_dedup", _runnable(near_dedup_stage)),
    ("decontamination", _runnable(decontamination_stage)),
    ("source_mixing", _runnable(mixing_stage)),
    ("token_orc", _runnable(token_stage)),
]

# Fingerprints and tokenizers are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_local_folder(spark)
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
