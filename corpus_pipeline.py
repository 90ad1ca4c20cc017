"""The corpus pipeline: documents become packed training sequences.

Each stage is a function of (spark, docs, sf_dir), works on all that the stage
before it kept, and is written and read again between stages. All but the last
return the columns of documents.

1. language: documents whose language is not told, for want of letters or of
   likeness to any language learned, go.
2. quality: documents that are likelier bad than good go.
3. near_duplicates: of each group of near duplicates the document with the
   smallest id stays. Texts of one id that are not alike are in groups of their
   own.
4. repeats: words of passages that occur in a document with a smaller id are
   cut. Documents without any stay as they are.
5. packing: what is left becomes sequences of tokens.

Models are fitted on the stage's own input, on labelled rows that their queries
do not hold out. A document with a null text is rejected by the first stage;
one with a null id is in no group of near duplicates and stays. Of a group's
rows with the smallest id, repeated or with texts near to one another, one
stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from simmart.llm import language, neardup, packing, quality, substrings
from simmart.llm.common import prepared, stored, table
from simmart.llm.queries import tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_LANGUAGE = 0.119  # margin over other languages below which none is told; a score of 0.35 of four
LEAST_QUALITY = 0.5


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    held = F.coalesce(language.remainder("doc_id", 5) == 0, F.lit(False))
    found = language.predicted(docs, language.learned(docs, ~held), keep=tuple(COLUMNS), margin=True)
    told = (F.col("lang_pred") != language.UNKNOWN) & (F.col("margin") >= LEAST_LANGUAGE)
    return found.where(told).select(*COLUMNS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = quality.learned(docs, _labels(spark, sf_dir))
    return quality.scored(docs, model, keep=tuple(COLUMNS)).where(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs.select(*COLUMNS), ties=("lang", "source", "n_chars"))


def repeats_cut(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(docs.select(*COLUMNS), carry=("lang", "source"))
    return found.select(
        "doc_id", F.col("kept").alias("text"), "lang", "source", F.char_length("kept").cast("bigint").alias("n_chars")
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"), with_ids=False)


STAGES = [
    ("language", told_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("repeats", repeats_cut),
    ("packing", packed),
]

# No stage but the cutting of repeats can be said in SQL: models are learned,
# tokens are a tokenizer's.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
