"""Benchmark decontamination with a positional inverted index.

The index holds postings ``(term, doc_id, text_key, pos, low, around)`` of the corpus: where a term stands, and the words
around it. Only terms that a search starts from are stored: of every test window its rarest term in the corpus, as counted over
all documents. A search joins windows to the postings of their rarest term, shifts the position by the term's offset in the
window and intersects with the other terms there: an exact match has every one of them at its shifted place, a proximity
match has all of them within the words around.

A window whose rarest term is frequent has as many candidates as that term has postings; they are rejected inside the join,
before anything is shuffled. All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import documents, public_id, stored

# The pattern of a word and the letters that are lowered.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOC = ["doc_id", "text_key"]
END = ""  # the posting of a document's end; no word is empty


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 0)


def windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(window, items)``: every distinct window of words with the items it comes from; a shorter item is one window."""
    split = items.select(F.col(id_col).alias("item_id"), words(F.coalesce(F.col(text_col), F.lit(""))).alias("words")).where(F.size("words") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))).alias("start")
    return split.select("item_id", "words", starts).groupBy(F.slice("words", F.col("start"), F.lit(size)).alias("window")).agg(
        F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("items"))


def tokens(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, words, pos, term)``: every word of every document and one ``END`` behind the last."""
    ended = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.concat(words(F.col("text")), F.array(F.lit(END))).alias("words"))
    return ended.select("*", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("pos")).withColumn(
        "term", F.get("words", F.col("pos")))


def rarest_terms(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """``tests`` with ``term``, the rarest of its words in the corpus, and its ``offset``; windows with an absent word go."""
    terms = stored(tests.select(F.explode("window").alias("term")).distinct(), "test-terms")
    counts = tokens(docs).join(terms, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    placed = tests.select("*", F.posexplode("window").alias("offset", "term"))
    ranked = placed.join(counts, "term", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("term"), F.col("offset"))).alias("rare"),
        F.first("items").alias("items"))
    return ranked.where("rare.n > 0").select("window", "items", "rare.term", "rare.offset")


def index(docs: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """The stored postings of ``terms`` and of document ends; ``around`` holds the words from ``low``, ``reach`` either way."""
    low = F.greatest(F.col("pos") - reach, F.lit(0))
    near = F.slice("words", F.col("low") + 1, F.least(F.col("pos") + reach + 1, F.size("words") - 1) - F.col("low"))
    ends = docs.sparkSession.createDataFrame([(END,)], "term string")
    wanted = stored(terms.select("term").distinct().unionByName(ends), "index-terms")
    found = tokens(docs).join(wanted, "term").withColumn("low", low)
    return stored(found.select("term", *DOC, "pos", "low", F.when(F.col("term") != END, near).alias("around")), "postings")


def phrase_matches(postings: DataFrame, tests: DataFrame) -> DataFrame:
    """``(doc_id, text_key, start, stop, items)``: every place where a window's words stand in order."""
    found = postings.join(tests, "term")
    start = F.col("pos") - F.col("offset")
    here = F.slice("around", F.greatest(start - F.col("low"), F.lit(0)) + 1, F.size("window"))
    return found.where((start >= 0) & (here == F.col("window"))).select(
        *DOC, start.alias("start"), (start + F.size("window")).alias("stop"), "items")


def proximity_matches(postings: DataFrame, tests: DataFrame) -> DataFrame:
    """``(doc_id, text_key, pos, items)``: rarest-term places with all words of the window around, in any order.

    How far a word may stand off is the ``reach`` of the index.
    """
    found = postings.join(tests, "term")
    return found.where(F.size(F.array_except("window", "around")) == 0).select(*DOC, "pos", "items")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one row per document, as ``hits`` finds them."""
    found = hits(docs, items, size, id_col, text_col, item_col, item_text_col)
    return found.select(public_id(), *[name for name in found.columns if name not in DOC])


def hits(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated)``, ids as ``documents`` has them.

    A word is hit if it lies in any occurrence of a window. A row repeated whole (same id and text) is one document; rows that
    share an id but not the text are separate. Null and empty texts have no words; items without words have no window.
    """
    texts = documents(docs, id_col, text_col)
    tests = stored(rarest_terms(texts, windows(items, size, item_col, item_text_col)), "test-windows")
    postings = index(texts, tests, size - 1)
    lengths = postings.where(F.col("term") == END).groupBy(*DOC).agg(F.max("pos").cast("long").alias("n_words"))
    # Copies of a window in a document have one start each; a repeated row repeats them, which adds nothing to a union.
    order = W.partitionBy(*DOC).orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1)
    fresh = F.greatest(F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(order), F.lit(0))), F.lit(0))
    covered = phrase_matches(postings, tests).withColumn("fresh", fresh).groupBy(*DOC).agg(
        F.sum("fresh").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return lengths.join(covered, DOC, "left").select(
        *DOC, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
