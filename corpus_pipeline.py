"""From documents to packed sequences: quality rules, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet in the
shared folder and hands the next stage what it reads back. All stages but the last return the
columns of `documents`; a document that the mix takes twice is in two rows, and the mix adds the
training position, by which the last stage packs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from canonflow.llm import curriculum, exact_dedup, minhash, packing, quality_rules
from canonflow.llm.common import free, table, written
from canonflow.session import ship

#: op3's query links from 85 on; the pipeline takes pairs of a Jaccard similarity of 0.8 or more.
NEAR_PERCENT = 80
#: A table's rows come back in any order, so the mix tells each row's place in a column of this name;
#: underscores follow where `documents` has such a column.
POSITION = "train_at"


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base checks or a learned rule go."""
    return quality_rules.apply_rules(docs, table(spark, sf_dir, "labels"))


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.dedup(docs)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    return minhash.near_dedup(docs, NEAR_PERCENT)


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, in training order."""
    return curriculum.mix(docs, position=free(docs.columns, POSITION))


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: the sequence it lies in and where; sequences rise with training."""
    places = [c for c in docs.columns if re.fullmatch(f"{POSITION}_*", c, re.IGNORECASE)]
    return packing.pack_documents(docs, order=max(places, key=len, default=None))


STAGES = [
    ("quality_rules", _quality),
    ("exact_dedup", _exact),
    ("minhash_near_dedup", _near),
    ("curriculum_mix", _mix),
    ("best_fit_packing", _pack),
]

#: Learned rules and token ids can't be expressed in SQL; tests/llm/test_pipeline.py compares every
#: stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
