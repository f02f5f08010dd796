"""Cleans documents for training, in stages that are each written and read again.

Toxic documents go, one document of each group of near copies stays, personal data is masked, and
what is left becomes token sequences without padding. Every stage but the last returns the columns
of the documents it was given, whatever their names.

Defined results on odd rows: a null or empty text is kept by every stage; it has the score of the
model's bias, no near copies and nothing to mask, and is packed as the end token alone. A null id
is kept like others, and named by no label. Rows equal in id and text are near copies, of which one
stays, whatever their other columns; of others that tie, the smallest id stays. Without documents
there are no sequences, and without labels of both kinds no document is toxic. Texts of any length
are read whole by every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dimloom.llm import jaccard, packing, personal, toxicity
from dimloom.llm.common import stored, table
from dimloom.llm.queries import may_learn, vocabulary

# SQL cannot express the learnt model, the graph of the join, or the tokens.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learnt from the labelled ones among them, does not reject."""
    learnt = toxicity.learned_toxicity(docs, table(spark, sf_dir, "labels"), may_learn())
    return toxicity.scored(docs, learnt).where("score < 0.5").select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of its shingles."""
    return jaccard.one_of_each_group(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their identifiers replaced by marks."""
    return personal.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of up to 2048 tokens, with their ids."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("personal_data", without_personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
