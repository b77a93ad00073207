"""The corpus pipeline: quality rules, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns the columns of ``documents``, all but the last,
which returns the pieces of packed sequences. A run writes each stage's rows to the shared folder, so a lost executor costs a
stage's tasks and not the stages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankops.llm import decontamination, jaccard, packing, pii, quality
from bankops.llm.registry import read, ship
from bankops.session import stored


def _with_row(docs: DataFrame, *read: str) -> DataFrame:
    """The columns that an operator reads beside the whole row in one column, so that no names can clash."""
    return docs.select(*read, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with all their columns as they are.

    Reads text, lang and source. A null or empty text has too few words and goes; a null language or source is a group of its own.
    Repeated rows are judged each, and alike. An empty table stays empty.
    """
    ship(spark)
    judged = quality.judge(_with_row(docs, "text", "lang", "source"), {"row": "row"})
    return judged.where("kept").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id.

    Rows of one id are one document: the smallest id keeps one row of each of its different texts, the one whose other columns have the
    smallest hash. Rows with a null id cannot be told apart and all stay, as do texts without words, which are near duplicates of
    nothing, but for repeated rows. An empty table stays empty.
    """
    ship(spark)
    named = jaccard.jaccard_components(docs)
    first = named.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    known = _with_row(docs.where(F.col("doc_id").isNotNull()), "doc_id", "text").join(first, "doc_id", "left_semi")
    known = known.select("row", "doc_id", F.xxhash64("text").alias("text_hash"), F.xxhash64("row").alias("order"))
    # rows of one id are together already
    kept = known.groupBy("doc_id", "text_hash").agg(F.min_by("row", "order").alias("row")).select("row.*")
    return kept.union(docs.where(F.col("doc_id").isNull()))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found, with all their columns as they are.

    Rows are judged one by one by their text, whatever their ids; null and empty texts stay. An empty table stays empty.
    """
    ship(spark)
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars``, where there is one, follows the text.

    Rows without personal data, null texts among them, stay as they are to the last column. Repeated rows are redacted each.
    """
    ship(spark)
    rows = pii.find_pii(_with_row(docs, "text"), {"row": "row"})
    rows = rows.select("row", pii.redacted(F.col("_text"), F.col("spans")).alias("new"), (F.size("spans") > 0).alias("changed"))
    new = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    return rows.select(
        *(
            (F.when(F.col("changed"), new[c]).otherwise(F.col(f"row.{c}")) if c in new else F.col(f"row.`{c}`")).alias(c)
            for c in docs.columns
        )
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens; see ``packing.pack``. A null text is an empty one: its end token is packed."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", drop_poor),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("personal data", redact),
    ("packing", pack),
]

# tokens and boosted trees are beyond SQL; tests/llm/test_pipeline.py compares each stage with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
