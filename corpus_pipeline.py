"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, packing.

Every stage works on all documents that the one before kept and has the signature ``(spark, docs, sf_dir)``. All but the last
return whole rows with the columns of ``documents``; ``run`` writes what a stage returns and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import block_naming, compression_quality, packing, part_enum, positional_index, queries
from skyledger.llm.common import NULL_ID, stored

REJECT_BELOW = 0.3


def row_id():
    """The id without nulls, for joins."""
    return F.coalesce(F.col("doc_id"), F.lit(NULL_ID))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with two columns that name a row as the operators do, by its id and a hash of its text, and their names."""
    key = [fresh(docs, "_id"), fresh(docs, "_text")]
    return docs.withColumns({key[0]: row_id(), key[1]: F.xxhash64(F.coalesce("text", F.lit("")))}), key


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects rows that the classifier scores below ``REJECT_BELOW``; it learns from all labels that are not held out."""
    name = fresh(docs, "_quality")
    scored = compression_quality.scored(docs, queries.quality_model(spark, sf_dir), name)
    return scored.where(F.col(name) >= REJECT_BELOW).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; of a row repeated whole, one."""
    key = [fresh(docs, "_id"), fresh(docs, "_sha")]
    kept = block_naming.exact_duplicates(docs).where("kept").select(row_id().alias(key[0]), F.col("text_sha256").alias(key[1]))
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = docs.withColumns({key[0]: row_id(), key[1]: sha}).dropDuplicates(key)
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked texts one row stays, that with the smallest id, and of several with this id that of the least hash.

    Rows that share an id but not the text are judged apart. Texts without words all stay; of a row repeated whole, one.
    """
    groups = part_enum.classes(docs).select("doc_id", "text_key", "class")
    first = groups.where("class IS NOT NULL").groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    alone = groups.where("class IS NULL").select("doc_id", "text_key")
    rows, key = keyed(docs)
    kept = first.select("first.doc_id", "first.text_key").unionByName(alone).toDF(*key)
    return rows.dropDuplicates(key).join(kept, key, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a window of a benchmark item go; all others stay, also those that share an id with one that goes."""
    found = positional_index.hits(docs, queries.table(spark, sf_dir, "benchmark"))
    rows, key = keyed(docs)
    gone = found.where("contaminated").select("doc_id", "text_key").distinct().toDF(*key)
    return rows.join(gone, key, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, in sequences of 1024 tokens."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [("quality classifier", quality), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("benchmark decontamination", decontaminate), ("packing", pack)]

# No SQL states the compression classifier, the first stage; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{number + 1}")
    return docs
