"""A corpus from raw documents to token ids, as five stages; each reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import chunks, mixing, pieces, simhash, toxicity
from tallyhouse.session import ship_package
from tallyhouse.sources.staging import stage


def _aside(docs: DataFrame, *read: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Documents whose other columns have names that no operator adds, and how they get their own names back."""
    names = [c if c in read else f"column_{k}" for k, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda df: df.select(*names).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject; it is fitted on the labelled ones among them.

    A missing text is empty and stays. Repeated rows are judged alike and stay; all columns keep their values.
    """
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plain, named = _aside(docs, "doc_id", "text")
    model = toxicity.fit_toxicity(toxicity.labelled_sample(plain, labels))
    return named(toxicity.score_toxicity(plain, model).where("NOT rejected"))


def drop_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the chunks of lines that an earlier one has; their length is counted anew.

    Missing texts stay missing and empty ones empty. Rows equal in everything keep the same chunks; all other columns
    keep their values.
    """
    ship_package(spark)
    plain, named = _aside(docs, "doc_id", "text")
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    cleaned = named(chunks.remove_repeated_chunks(plain))
    return cleaned.select(*[n_chars if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; different ones without an id all stay."""
    ship_package(spark)
    return simhash.keep_first_of_groups(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, dealt to shards and shuffled."""
    ship_package(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the source bytes of every piece; a missing text is empty and has none, repeated rows all come."""
    ship_package(spark)
    docs = docs.select("doc_id", "lang", "source", "text")
    encoded = pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), drop=("text",))
    return encoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "starts", "ends",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_chunks),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode),
]

# Model fits, hashes and encodings have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read back for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
