"""From raw documents to token ids in five stages: toxicity, near duplicates, privacy, mixing, encoding.

Each stage takes all that its predecessor kept, as a table read back from Parquet. All but the last return the columns
of their input. Null and empty texts pass toxicity and privacy, count as one group of near duplicates, and encode to
no tokens; repeated rows are one group of near duplicates; an empty table passes as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import byte_bpe, mixing, pseudonyms, simhash, toxicity
from riskloom.llm.shared import Stored, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, trained on the labelled ones among them, finds more likely clean than toxic."""
    machine = toxicity.fit(spark, docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(docs, machine) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints hang together within four bits."""
    return simhash.drop_near_duplicates(docs)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values replaced by pseudonyms; ``n_chars`` follows the new text."""
    out = pseudonyms.pseudonymise(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, dealt out by the target weights; a document may come once per epoch."""
    return mixing.mix(docs, share=1.0, epoch=None, domain=None, tokens=None)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the token ids of each whole text."""
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    coded = byte_bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pseudonyms", pseudonymise),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: A trained machine and 64-bit digests are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    stored = Stored(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs, _ = stored.put(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
