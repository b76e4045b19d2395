"""The corpus pipeline: quality classifier, exact dedup, SimHash near-dedup,
mixing, SentencePiece. Each stage's rows are written as Parquet and read back
as the next one's documents, so a lost executor costs one stage's tasks."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact_dedup, mixing, quality, simhash, spm
from strata.llm.common import materialize
from strata.sources.tables import table


def _tokenizer(name: str) -> str:
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.join(spec.submodule_search_locations[0] if spec else "/opt/tokenizers", name)


SENTENCEPIECE_MODEL = os.environ.get("STRATA_SENTENCEPIECE_MODEL") or _tokenizer("piece_bpe_32k.model")

# share of each source in the mix, as integers; all sources not named share "*"
TARGET_WEIGHTS = {"src0": 6, "src1": 3, "src2": 3, "src3": 2, "src4": 2} | {f"src{i}": 1 for i in range(5, 20)} | {mixing.OTHER: 1}

# SQL can express neither the trained classifier nor the tokenizer
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of the documents with equal texts."""
    return exact_dedup.keep_first(docs, exact_dedup.new_index(docs))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: the files written from this,
    read one after another, interleave the sources by the target weights."""
    return mixing.in_mixed_order(docs, TARGET_WEIGHTS)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the proof that they decode to it, and
    its place in the mix: readers may return files in any order, so the places
    are worked out again, the same as in the stage before, from the rows."""
    placed = mixing.with_places(docs.select("doc_id", "text", "source"), TARGET_WEIGHTS)
    return spm.round_trip(placed, spm.read_model(SENTENCEPIECE_MODEL), carried=["source", "slot", "place"])


STAGES = [("quality", quality_stage), ("exact_dedup", exact_dedup_stage), ("simhash", simhash_stage),
          ("mixing", mixing_stage), ("sentencepiece", sentencepiece_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
