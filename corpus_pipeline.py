"""The corpus pipeline: language, exact copies, near copies, repeated passages, packing.

Defined results: an empty table gives no pieces. Rows without a letter in their
text (null, blank, digits) go with the first stage, and so do all rows where
too few declare a language. Rows without an id stay rows of their own: of
equal texts one with an id is kept where there is one. Repeated rows are exact copies: one
stays. Further columns, whatever their names, are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.llm.common import staged
from landfall.llm.exact_dedup import drop_copies
from landfall.llm.language_id import keep_identified
from landfall.llm.queries import documents, packed
from landfall.llm.simhash import drop_near_copies
from landfall.llm.substring_dedup import cut_repeats


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear stay; ``lang`` is the language found."""
    return keep_identified(docs)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for A-Z case, the one with the largest id stays."""
    return drop_copies(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints, the document with the smallest id stays."""
    return drop_near_copies(docs, 4, 4)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 13 words that start in a document with a smaller id are cut out."""
    return cut_repeats(docs, 13)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of a document and its place in a sequence of 2048 tokens."""
    return packed(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", dedup_exact),
    ("simhash", dedup_near),
    ("substring_dedup", dedup_substrings),
    ("best_fit_packing", pack_sequences),
]

#: Language models, fingerprints and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
