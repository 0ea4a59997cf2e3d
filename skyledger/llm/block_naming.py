"""Exact de-duplication by deterministic block naming.

A text is cut into fixed-size byte blocks. All blocks of the corpus are sorted, and equal blocks get one integer name.
Adjacent names are then paired, the pairs are sorted and named in turn, and so on until every document has one name. Two
texts of the same number of blocks have the same last name if and only if they are byte for byte equal: names rely on no
hash being free of collisions (rows go back to their names by id, a hash of the text and length, which matters only where one id
has several texts). Names depend on the texts alone, so a recomputed task gives the same ones.

Hot blocks: rows are dealt over ``salts`` copies of a bucket before they are sorted; only one row per copy and distinct block
goes on to the sort that settles the names, which go back by a join on small integers.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import documents, public_id, stored

DOC = ["doc_id", "text_key", "n_bytes"]


def named(rows: DataFrame, keys: list[str], buckets: int, salts: int) -> DataFrame:
    """``(*DOC, i, name)``: rows with equal ``keys`` get equal names, others different ones."""
    # Both branches below read the same columns of the same exchange, so Spark makes it once. For that, neither must get a
    # filter of its own: columns that cannot be null need no null filter before the join.
    number = lambda column, parts: F.coalesce(F.pmod(column, F.lit(parts)), F.lit(0)).cast("int")
    dealt = rows.withColumns({"bucket": number(F.xxhash64(*keys), buckets), "salt": number(F.hash("doc_id", "i"), salts)})
    inside = W.partitionBy("bucket", "salt")
    local = (dealt.withColumn("nth", F.row_number().over(inside.orderBy(*keys, *DOC, "i")))
             .withColumn("local", F.dense_rank().over(inside.orderBy(*keys)))
             .withColumn("first", F.rank().over(inside.orderBy(*keys))))
    heads = local.where("nth = first").select("bucket", "salt", "local", *keys)
    place = F.dense_rank().over(W.partitionBy("bucket").orderBy(*keys)).cast("long")
    names = heads.withColumn("name", F.col("bucket") * F.lit(1 << 36) + place).select("bucket", "salt", "local", "name")
    return local.select("bucket", "salt", "local", *DOC, "i").join(names, ["bucket", "salt", "local"]).select(
        *DOC, "i", "name")


def identities(docs: DataFrame, block_bytes: int = 4096, bucket_bytes: int = 8 << 20, salts: int = 16) -> DataFrame:
    """``(*DOC, n_blocks, name)``: one identity per document; equal ``(n_blocks, name)`` means equal texts.

    There is a bucket for every ``bucket_bytes`` of text, so what one sort holds does not grow with the corpus.

    ``docs`` is ``(doc_id, text)`` without nulls. A row repeated whole appears once. ``text_key`` only tells rows apart that
    share an id; it takes no part in naming.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.octet_length("text").alias("n_bytes"),
                       F.col("text").cast("binary").alias("bytes"))
    count = F.greatest(F.ceil(F.col("n_bytes") / block_bytes), F.lit(1)).cast("int")
    longest, total = (n or 0 for n in docs.agg(F.max(F.octet_length("text")), F.sum(F.octet_length("text"))).first())
    buckets = math.ceil(total / bucket_bytes) + 7
    blocks = rows.select("*", F.explode(F.sequence(F.lit(0), count - 1)).alias("i")).select(
        *DOC, "i", F.substring("bytes", F.col("i") * block_bytes + 1, F.lit(block_bytes)).alias("block"))
    level = stored(named(blocks, ["block"], buckets, salts).withColumn("n_blocks", count), "block-names")
    done = [level.where("n_blocks = 1")]
    for depth in range(1, math.ceil(math.log2(max(1, math.ceil(longest / block_bytes)))) + 1):
        side = lambda odd: F.max(F.when(F.col("i") % 2 == odd, F.col("name")))
        pairs = level.where(F.col("n_blocks") > 1 << (depth - 1)).groupBy(*DOC, "n_blocks", F.expr("i div 2").cast("int").alias("i")).agg(
            side(0).alias("left"), F.coalesce(side(1), F.lit(-1)).alias("right"))
        level = stored(named(pairs, ["left", "right"], buckets, salts).withColumn("n_blocks", count), "pair-names")
        done.append(level.where((F.col("n_blocks") > 1 << (depth - 1)) & (F.col("n_blocks") <= 1 << depth)))
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select(*DOC, "n_blocks", "name").distinct()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4096,
                     bucket_bytes: int = 8 << 20, salts: int = 16) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per document.

    Of equal texts the row with the largest id stays. A row repeated whole (same id and text) is reported once and counts in
    ``group_size`` as often as it stands there; rows that share an id but not the text are separate documents. Null texts
    are equal to empty ones.
    """
    texts = documents(docs, id_col, text_col)
    name = identities(texts, block_bytes, bucket_bytes, salts)
    rows = texts.groupBy("doc_id", F.xxhash64("text").alias("text_key"), F.octet_length("text").alias("n_bytes")).agg(
        F.min(F.sha2("text", 256)).alias("text_sha256"), F.count(F.lit(1)).alias("copies"))
    members = rows.join(name, DOC)
    groups = members.groupBy("n_blocks", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return members.join(groups, ["n_blocks", "name"]).select(
        public_id(), public_id("keep_id"), "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), "text_sha256")
