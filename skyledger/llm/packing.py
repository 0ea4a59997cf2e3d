"""Packing tokenised documents into sequences by best-fit decreasing.

An overlong document is first cut into full windows; what is left of every document is an item of 1 to ``size`` tokens. Items
of one length are alike, and so are open windows with one remaining capacity. Best-fit decreasing over all items is therefore
planned on the counts per length, of which there are at most ``size`` whatever the corpus holds: a segment tree over the
remaining capacities finds the tightest open window, and a whole run of equal items is placed at once. The plan says which
ranks of a length go where; ranks are dealt out by Spark.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import documents, public_id, stored

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@functools.cache
def tokenizer(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file, with its own ids; ``tiktoken`` runs the same merges several times faster.

    In these files a merged token's rank is its id. Strings of special tokens in a text get their special id, as there.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    # The file writes bytes as printable characters: printable Latin-1 as it is, all others from U+0100 on, in order.
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    shown = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
    special = {token["content"]: token["id"] for token in spec["added_tokens"]}
    ranks = {bytes(shown[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    # Fixed value: the pattern that splits text before the merges of byte-level BPE files of this kind.
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def pieces(docs: DataFrame, path: str, size: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: each document's ids and ``end_id``, cut into full windows and a rest."""
    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = bpe.encode(text.as_py(), allowed_special="all")
                ids.append(end_id)
                raw = np.array(ids, dtype="<u4").tobytes()
                for at in range(0, len(ids), size):
                    part = raw[4 * at:4 * (at + size)]
                    out.append((doc_id, at, len(part) // 4, zlib.crc32(part), len(ids)))
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.mapInArrow(run, PIECE)


class Capacities:
    """Counts of open windows by remaining capacity in a segment tree: ``tightest(n)`` is the least capacity >= n in use."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.tree = [0] * (2 * self.width)
        self.windows: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # runs of window numbers

    def put(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.windows[capacity].append((first, count))
            self._add(capacity, count)

    def take(self, capacity: int) -> tuple[int, int]:
        first, count = self.windows[capacity].pop()
        self._add(capacity, -count)
        return first, count

    def _add(self, capacity: int, count: int) -> None:
        at = capacity + self.width
        while at:
            self.tree[at] += count
            at //= 2

    def tightest(self, least: int) -> int | None:
        at = least + self.width
        if self.tree[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.width
            at //= 2
        return None


def plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing on counts per length: ``(length, first_rank, items, first_window, offset)``.

    Items ``first_rank`` .. ``first_rank + items - 1`` of the length go to as many consecutive windows, at ``offset``. An item
    that fits a window leaves it the tightest for the next equal item, so a window takes as many as it can before the next.
    """
    open_windows, made, placed = Capacities(size), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = open_windows.tightest(length)
            if capacity is None:
                capacity = size
                first, count = made, -(-left // (size // length))
                made += count
            else:
                first, count = open_windows.take(capacity)
            each = capacity // length
            full = min(count, left // each)  # windows that take as many as they can
            for step in range(each if full else 0):
                placed.append((length, rank + step * full, full, first, size - capacity + step * length))
            open_windows.put(capacity - each * length, first, full)
            rank, left = rank + each * full, left - each * full
            if full < count and left < each:
                some = left  # the last window gets the few that remain
                for step in range(some):
                    placed.append((length, rank + step, 1, first + full, size - capacity + step * length))
                if some:
                    open_windows.put(capacity - some * length, first + full, 1)
                    full += 1
                rank, left = rank + some, 0
            open_windows.put(capacity, first + full, count - full)
    return placed


def ranked(items: DataFrame, salts: int) -> DataFrame:
    """Add ``rank``, 0, 1, 2 .. within every length. A length may hold any share of the rows: it is numbered in salted parts."""
    dealt = items.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    parts = dealt.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1
    return dealt.withColumn("place", place).join(parts.withColumn("before", before).drop("n"), ["length", "salt"]).withColumn(
        "rank", F.col("before") + F.col("place")).drop("salt", "before", "place")


def pack(docs: DataFrame, path: str, size: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
         part_rows: int = 100_000) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row per piece.

    ``path`` is a tokenizer file that driver and executors both have. A null or empty text is the end id alone; repeated rows
    are packed as often as they stand there. A sequence is padded to ``size`` unless its tokens are a power of two already.
    Pieces of the commonest length are numbered in parts of about ``part_rows``, however many there are.
    """
    cut = stored(pieces(documents(docs, id_col, text_col), path, size, end_id), "pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    placed = plan(counts, size)
    salts = -(-max(counts.values(), default=1) // part_rows) + 7
    schema = "length long, first_rank long, items long, first_window long, offset long"
    where = cut.sparkSession.createDataFrame(placed, schema)
    # The plan has a bounded number of rows: its size depends on `size` alone, not on the corpus.
    inside = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("items"))
    items = ranked(cut, salts).join(F.broadcast(where.withColumnRenamed("length", "of")), (F.col("length") == F.col("of")) & inside)
    items = items.withColumn("sequence_id", F.col("first_window") + F.col("rank") - F.col("first_rank"))
    return items.select(public_id(), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
