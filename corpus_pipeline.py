"""The corpus pipeline: quality, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns documents with the columns it got, but for the last,
which returns the packed pieces.  A stage works on every row that the one before it kept.

Defined cases, of every stage: an empty table gives an empty table; columns keep their names, order and
types, whatever extra ones are called; a text may be of any length.  How a stage treats null and empty texts,
null ids and repeated rows is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedge.llm.decontamination import decontaminate
from sedge.llm.jaccard_join import keep_one
from sedge.llm.packing import pack
from sedge.llm.pii import fit_pii, redact
from sedge.llm.quality import fit_quality, keep_quality
from sedge.llm.queries import WORD_BPE, table, tokenizer
from sedge.llm.storage import new_folder, removed, written


def _sized(df: DataFrame) -> DataFrame:
    """n_chars brought in line with a changed text."""
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(*df.columns) if "n_chars" in df.columns else df


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, doesn't reject.

    Null and empty texts are scored alike, like any other; a null id is no label's; repeated rows share a score.
    """
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest id.

    Rows of one id but different texts are different documents; rows without an id take part, after those with
    one; of repeated rows one stays.  Texts without words (null, empty, blank) are linked with nothing and stay.
    """
    return keep_one(docs, width=5, num=75, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's windows; all rows stay, and null and empty texts as they are."""
    return _sized(decontaminate(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; all rows stay, and null texts stay null."""
    return _sized(redact(docs, fit_pii(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids packed into sequences of 4096.

    A null or empty text has the end id alone; a null id is passed through; repeated rows are packed each.
    """
    return pack(docs, tokenizer(WORD_BPE), capacity=4096, end_id=2)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("packing", packing)]

#: The stages include trained models and searches that SQL can't express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents, each one's rows written and read again for the next."""
    folder, docs, before = new_folder(spark, "pipeline"), table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}")
        if before:
            removed(before)
        before = f"{folder}/{k}-{name}"
    return docs
