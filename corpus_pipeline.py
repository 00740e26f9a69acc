"""A training corpus from a table of documents, in five stages.

Each stage gets what its predecessor kept, as a written table, and passes on rows with the
columns of documents; the last returns the packed sequences. How each stage treats nulls, empty
texts, ties and repeated rows is stated by its operator.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm import exact, langid, mixing, packing, simhash
from padron.llm.common import documents, settle
from padron.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough certainty; the model learns from ``lang``."""
    model = langid.fit(docs)
    found = langid.identify(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "text"), model, ["row"])
    return found.where("accepted").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, against an index that is empty at first."""
    return exact.deduplicate(docs, f"digests_{uuid.uuid4().hex}")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word similarity of at least 0.8."""
    return simhash.deduplicate(docs, size=simhash.NEAR_SHINGLE, distance=simhash.NEAR_DISTANCE, similarity=simhash.SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, each of one document and of a power-of-two length."""
    packed = packing.sequences(docs, tokenizer_path())
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket", "ids"
    )


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: A trained model, fingerprints and a tokenizer are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
