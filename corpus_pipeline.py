"""A training-data pipeline over ``documents``, stage by stage.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``; extra columns go along
untouched. ``run(spark, sf_dir)`` applies them to the table ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import written
from fleetlake.llm.mixing import apply_rates, labelled_domains, mix
from fleetlake.llm.ordinal import grades_from_labels, select_documents, train
from fleetlake.llm.packing import pack, token_pieces
from fleetlake.llm.simhash import one_of_each_group
from fleetlake.llm.suffixes import remove_repeats


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose top grade is likelier than not, by a model fitted on the rated ones among
    them. Null and empty texts are judged by the thresholds alone."""
    model = train(docs, grades_from_labels(_labels(spark, sf_dir)))
    return select_documents(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (3-word shingles, at most 3 differing bits):
    the one with the smallest id, those without an id told apart by their text and coming last."""
    return one_of_each_group(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of over 50 words that occur elsewhere: runs of bytes covered by
    strings of 150 bytes that start twice or more (51 words of prose are longer), of 51 words or more.
    ``n_chars`` is that of the text that is left. A null text becomes empty."""
    out = remove_repeats(docs, span=150, least_words=51, keep=tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars")), as_text=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture asks: domains are the languages of labelled documents,
    raised towards the rare ones. No rate is below one, so none is dropped; a rate above one repeats."""
    return apply_rates(docs, mix(docs, labelled_domains(docs, _labels(spark, sf_dir)), least=1.0))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their sequences and offsets."""
    pieces = token_pieces(docs)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Hashing with a seed, a fitted model and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
