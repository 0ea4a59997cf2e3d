"""What the corpus operators share: their view of a document table, stored intermediates and byte blobs.

Conventions of all operators, unless one says otherwise:

* a null text counts as the empty text; a null id is an id like any other and sorts before all of them;
* an operator reads the id and the text column only and returns its own columns, so further columns of the input, whatever
  they are called, neither disturb it nor come back;
* an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.session import work_folder

NULL_ID = -(1 << 63)


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", further: list[str] = ()) -> DataFrame:
    """``(doc_id, text, *further)``, id and text without nulls; a null id becomes ``NULL_ID``, ``public_id`` turns it back."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *further)


def public_id(name: str = "doc_id") -> Column:
    """The id as the caller knows it."""
    return F.when(F.col(name) != NULL_ID, F.col(name)).alias(name)


def fold(doc_id: Column, parts: int = 5) -> Column:
    """Remainder of the checksum of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it: cuts the lineage and survives lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def block_count(docs: DataFrame, block_bytes: int) -> int:
    """Blocks of about ``block_bytes`` bytes of text that a corpus needs. One number comes to the driver."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return math.ceil(total / block_bytes) + 7


def in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """Add ``block``, an even deal of the documents by a hash of id and text."""
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
