"""The corpus pipeline: stages over `documents`, each written as Parquet and read again.

    STAGES = [(name, function)], function(spark, docs, sf_dir) -> DataFrame
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from bloomledger.llm import stages
from bloomledger.llm.common import shared_folder

STAGES = [
    ("keep_languages", stages.keep_languages),
    ("drop_near_copies", stages.drop_near_copies),
    ("drop_leaks", stages.drop_leaks),
    ("mix_sources", stages.mix_sources),
    ("assign_shards", stages.assign_shards),
]

# Language scores, near-duplicate groups and alignments have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns goes through a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
