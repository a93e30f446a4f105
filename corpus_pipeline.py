"""The corpus pipeline: quality, toxicity, near-duplicates, mixing, tokens.

Each stage is one of the operators of ``admitlab.llm``; it takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's documents.  All stages but the last return the columns they
were given.  Models are learned from the stored ``documents`` and ``labels`` of
``sf_dir``; every stage decides on all documents its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitlab.llm import byte_bpe, mixing, pair_rank, simhash, toxicity
from admitlab.llm.common import read, store
from admitlab.llm.queries import ACCEPT, BYTE_RANKS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking accepts.

    NULL and empty texts are scored like texts without words, texts of any length
    whole; equal texts have one fate and repeated rows stay repeated; a score at
    the threshold is accepted; columns of any name are kept; an empty table gives
    an empty one."""
    model = pair_rank.fit_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return docs.where(pair_rank.quality_score(model) >= ACCEPT)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not mark.

    NULL and empty texts are scored like texts on which no voter fires, texts of
    any length whole; equal texts have one fate and repeated rows stay repeated; a
    score at the threshold is marked; columns of any name are kept; an empty table
    gives an empty one."""
    model = toxicity.fit_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxic_score(model) < ACCEPT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each SimHash component.

    NULL and empty texts are one component; of texts under one id that of the
    smallest hash stays, of repeated rows one, and a row without id only where no
    row of its component has one; texts of any length are hashed whole; columns of
    any name are kept; an empty table gives an empty one."""
    read(spark, sf_dir, "documents")  # readies the session
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it.

    NULL and empty texts have size 0, NULL sources are one source; of equal rows
    some may come once more than others; a text longer than its source's target
    may miss it by its length; columns of any name are kept; an empty table gives
    an empty one."""
    read(spark, sf_dir, "documents")
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, token ids, their number, and the digest of the text decoded
    from them.

    NULL and empty texts have no ids; texts and words of any length are encoded
    whole; repeated rows stay repeated; other columns are not read; an empty table
    gives an empty one."""
    read(spark, sf_dir, "documents")
    out = byte_bpe.encode_documents(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    return out.select("doc_id", "source", "token_ids", "n_tokens", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("mix", mix),
          ("tokens", tokens)]

#: Learned models and hashes: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
