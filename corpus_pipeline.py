"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of `documents`, extra ones too,
whatever their names. Where a stage changes texts, n_chars follows. A document whose text was emptied stays, as an empty one. Every stage returns at
most one row for each row it is given, and rows keep their own columns: null and repeated doc_ids are no keys to join texts back by. Null texts count as
empty, very long ones are worked on whole, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import staged
from voxlake.llm.line_dedup import dedup_lines
from voxlake.llm.minhash import keep_one
from voxlake.llm.packing import pack_documents
from voxlake.llm.quality_rules import filter_documents
from voxlake.llm.suffix_dedup import kept_text, remove_repeats


def _nested(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the whole row but the text as one column, so that no name of its own can clash."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"))


def _with_text(found: DataFrame, text: str, docs: DataFrame) -> DataFrame:
    """The rows of `found`, flat again, with their new text, in the columns and types of `docs`."""
    new = {"text": F.col(text), "n_chars": F.char_length(text)}
    return found.select(*(new.get(f.name, F.col(f"row.`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that any rule rejects go; so do null and empty texts, which have few words. Equal rows share their fate."""
    return filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines go, but in the largest doc_id that holds them; a row for each row. A null doc_id is the smallest; rows of one doc_id count as one document."""
    return _with_text(dedup_lines(_nested(docs), others=("row",)), "kept_text", docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with a similarity of 0.8 or more on five-word shingles the smallest doc_id stays, one row of it; rows without words all stay."""
    return keep_one(docs, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in 50-byte strings that a smaller doc_id holds too go; a row for each row. A null doc_id is the smallest; rows of one doc_id spare each other."""
    return _with_text(kept_text(remove_repeats(_nested(docs), others=("row",)), ("row",)).withColumnRenamed("text", "kept"), "kept", docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's tokens, repeated rows and null doc_ids like others, in sequences of at most 2048; the columns of op4_packing."""
    return pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("packing", packing)]
#: The last stage's tokens aren't expressible in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
