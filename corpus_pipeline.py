"""The corpus pipeline: language, near duplicates, repeated passages, mix of sources, packed sequences.

Every stage takes ``(spark, docs, sf_dir)`` and all documents the stage before kept, and returns a DataFrame that is
written as Parquet and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strataline.llm import near_copies, op1_packing, op5_substrings, op6_language, op10_mixing
from strataline.llm.shared import stored, table


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The columns stages read or change; all others only travel along.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _carrying(stage: Stage) -> Stage:
    """A stage that returns the columns of its documents, whatever the names of those it doesn't use: they bear neutral
    names inside, so that none can clash with a column of an operator."""
    @wraps(stage)
    def carried(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = [c if c in OWN else f"_carried_{i}" for i, c in enumerate(docs.columns)]
        out = stage(spark, docs.toDF(*inside), sf_dir)
        return out.select(*inside).toDF(*docs.columns)
    return carried


def _with_text(frame: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """``frame`` in the columns of ``docs`` with another text and its length."""
    out = frame.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


@_carrying
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those of no known language (null, or without a letter) go. The language
    itself rejects nobody. Repeated rows and rows without an id are judged like any other, texts of any length as a
    whole; where no row names a language, or there is no row, none stays."""
    model = op6_language.fit(docs)
    predicted = op6_language.predict(docs, model, "text", docs.columns)
    return predicted.where("lang_pred <> 'und'").select(docs.columns)


@_carrying
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (Jaccard similarity 0.8 of five-word shingles, checked exactly on the
    candidates of op 8's SimHash links and of minima): the one with the smallest id, a null id last; of repeated rows, one.
    Null, empty and blank texts are one group; no rows give none."""
    return near_copies.kept(docs)


@_carrying
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that occur elsewhere; a text that loses none stays as it was, a null one null.
    Every row stays, also one that loses all its words; repeated rows lose what they share; no rows give none."""
    others = [c for c in docs.columns if c != "doc_id"]
    cut = op5_substrings.remove_repeats(docs, carry=others)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _with_text(cut, docs, text)


@_carrying
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at their target weights, with documents as often as they are taken. Texts without words, null
    ones too, are taken by no slot; a null source is one more source; repeated rows are each taken; no rows give none."""
    return _with_text(op10_mixing.mixed_documents(docs), docs, F.col("text"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix packed into sequences of 1024 tokens, a row per piece. A null or empty text is its end token alone; other
    columns are left out; no rows give none."""
    return op1_packing.pack(docs, with_ids=False)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packed", packed),
]

#: Tokens, fingerprints and learned probabilities have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
