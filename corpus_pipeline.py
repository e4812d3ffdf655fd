"""A training corpus from raw documents: five stages, each working on all that its predecessor kept."""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import bpe_round_trip
from tidemark.llm.common import collect_garbage, discard, give_back, materialise, read_table, recorded
from tidemark.llm.exact_dedup import exact_dedup_rows
from tidemark.llm.mixing import mix_rows
from tidemark.llm.ngram_join import one_of_each_component
from tidemark.llm.quality_rules import quality_rules
from tidemark.sources.shared import shared_folder

#: The vocabulary that the last stage encodes with.
VOCABULARY = "byte_bpe_50k.tiktoken"


#: Columns that operators read by name. All others are carried under names that no operator uses.
READ = ("doc_id", "text", "source")
#: Where the rows of a stage name the folders that its operator has left, in the metadata of doc_id.
LEFT = "left"


def _stage(work: Callable) -> Callable:
    """A stage begins when its predecessor's rows are written, so what that left goes, unless `docs` still reads it.

    What a stage left is named in the metadata of its doc_id column, which Parquet keeps: so a run knows its own folders
    only, whatever others do meanwhile. Columns of docs come back under their own names, in their order.
    """

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left = [f for f in docs.schema["doc_id"].metadata.get(LEFT, []) if f.startswith(shared_folder(spark))]
        discard(spark, left, docs)
        carried = {c: c if c in READ else f"carried_{i}" for i, c in enumerate(docs.columns)}
        with recorded() as folders:
            rows = work(spark, docs.toDF(*carried.values()), sf_dir)
        gc.collect()  # what the driver trained with or looked up
        give_back()
        collect_garbage(spark)
        named = {new: old for old, new in carried.items()}
        return rows.toDF(*[named.get(c, c) for c in rows.columns]).withMetadata("doc_id", {LEFT: folders})

    return run


@_stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the model trained on `labels`; the others go.

    Null and empty texts have no words and go; repeated rows are judged each; every column stays.
    """
    rows = quality_rules(docs, read_table(spark, sf_dir, "labels"))
    return rows.filter("kept").select(*docs.columns)


@_stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (white space aside) the one with the smallest doc_id, nulls last; of repeated rows one."""
    return exact_dedup_rows(docs)


@_stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 in five-word shingles the one with the smallest doc_id.

    Texts without words link with nothing and stay; rows that share the smallest id stay all.
    """
    return one_of_each_component(docs)


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them; a null source is one of its own, equal ids share a decision."""
    return mix_rows(docs)


@_stage
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row with their number and the digests of ids and decoded bytes; a null text has none."""
    return bpe_round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality rules", good_quality),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources", mixed),
    ("byte-level BPE", encoded),
]

#: SQL can't express the trained model of the first stage; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`, each written to the shared folder and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
