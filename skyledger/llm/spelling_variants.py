"""Grouping of spelling variants by dense prefix-suffix tiling.

Words lie in padded matrices of code points, once from their beginning and once from their end. A tile compares a block of rows
with another: the common prefix and the common suffix of every pair are counted column by column, and two words are a single edit
apart when both together reach the longer length minus one.

Tiles are made only of words that can be near. For a longer length ``L`` a *cell* ``(L, p, s)`` holds the words of length ``L`` and
``L - 1`` and says that the edit lies behind the first ``p`` and before the last ``s`` code points; words meet in it when they
agree on those. The cells of a word halve its positions. A group of more than ``limit`` words is parted again, each word going to
the two halves of its cell, until the cell is a single position, where a group is no larger than the alphabet. So frequent
beginnings and endings cost more cells, not larger groups, and no pair is lost. A pair's edit stands at one position, the length of
its common prefix, and is counted in the one cell that holds this position.

Words, counts and answers are tables; one number, the largest count, comes to the driver, which bounds the length of chains.

Defined cases: null and empty texts have no words, a null id counts as the empty text in the checksum, repeated rows count as often
as they stand there, words of any length are taken, and an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

# Letters of a run and the letters that are lowered.
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HELD = 1 << 17  # distinct words that a task counts before it hands them on
LIMIT = 512  # words of a group that are compared without parting it
ROWS, TILE_BYTES = 192, 1 << 21  # rows of a block, and bytes of one for long words


def counted(docs: DataFrame, one_in: int, length: int, id_col: str, text_col: str) -> DataFrame:
    """``(word, n)`` of all texts, words of at least ``length`` code points. Tasks count before anything is shuffled."""
    pattern = re.compile(f"{LETTERS}{{{length},}}")
    lowered = str.maketrans(UPPER, LOWER)

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                prefix = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
                for word, n in Counter(pattern.findall(text.as_py().translate(lowered))).items():
                    h = zlib.crc32(word.encode(), prefix)
                    if h % one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < length:
                            continue
                    counts[word] += n
                if len(counts) >= HELD:
                    yield batch_of(counts)
                    counts = Counter()
        if counts:
            yield batch_of(counts)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def halves(longer: Column, p: Column, s: Column) -> Column:
    """The two cells that part ``(longer, p, s)``: the edit lies in the right half of its positions, or in the left."""
    left = ((longer - p - s) / 2).cast("int")
    return F.array(F.struct((p + left).alias("p"), s.alias("s")), F.struct(p.alias("p"), (longer - p - left).alias("s")))


def in_cells(rows: DataFrame) -> DataFrame:
    """``(word, n, longer, p, s, cell)`` of rows ``(word, n, longer, p, s)`` parted once; equal ``cell`` means that words meet.

    The key is a hash of what words agree on. Words that meet by a collision are compared and found not to be near.
    """
    parted = rows.select("word", "n", "longer", F.explode(halves(F.col("longer"), F.col("p"), F.col("s"))).alias("to"))
    parted = parted.select("word", "n", "longer", "to.p", "to.s")
    size = F.length("word")
    # Substrings by offset and length: F.right would need an expression for 0 code points.
    head = F.substring(F.col("word"), F.lit(1), F.col("p"))
    tail = F.substring(F.col("word"), (size - F.col("s") + 1).cast("int"), F.col("s"))
    return parted.withColumn("cell", F.xxhash64("longer", "p", "s", head, tail))


def groups(words: DataFrame, limit: int) -> DataFrame:
    """``(word, n, longer, p, s, cell)``: the groups to compare. A group without a word of the longer length, or with a single one, is dropped."""
    size = F.length("word").cast("int")
    rows = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longer"), F.lit(0).alias("p"), F.lit(0).alias("s"))
    longest = words.agg(F.max(size)).first()[0] or 0
    done = []
    for _ in range(max(1, math.ceil(math.log2(longest + 2)))):
        rows = stored(in_cells(rows), "cells")
        sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("members"), F.count_if(F.length("word") == F.col("longer")).alias("long"))
        sizes = stored(sizes.where("members > 1 AND long > 0"), "cell_sizes")
        open_ = (F.col("members") > limit) & (F.col("longer") - F.col("p") - F.col("s") > 1)
        sized = rows.join(sizes, "cell")
        done.append(sized.where(~open_).drop("members", "long"))
        if not sizes.where(F.col("members") > limit).limit(1).count():
            break
        rows = sized.where(open_).drop("members", "long", "cell")
    result = done[0]
    for further in done[1:]:
        result = result.unionByName(further)
    return result


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and the code points of every word in a row: from its beginning, and from its end backwards; padded with 0."""
    sizes = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    if not len(flat) or flat.max() < 256:
        flat = flat.astype(np.uint8)
    inside = np.arange(sizes.max()) < sizes[:, None]
    front = np.zeros(inside.shape, dtype=flat.dtype)
    front[inside] = flat
    back = np.zeros_like(front)
    back[inside[:, ::-1]] = flat
    return sizes, front, back[:, ::-1]


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns every row of ``a`` shares with every row of ``b``."""
    alive, count = np.ones((len(a), len(b)), dtype=bool), np.zeros((len(a), len(b)), dtype=np.int32)
    for column in range(a.shape[1]):
        alive &= a[:, column, None] == b[None, :, column]
        count += alive
        if column % 8 == 7 and not alive.any():
            break
    return count


def tile(sizes: np.ndarray, front: np.ndarray, back: np.ndarray, a: slice, b: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of two blocks of rows: which pairs are a single edit apart, their common prefix and the longer length."""
    shorter, longer = np.minimum(sizes[a, None], sizes[None, b]), np.maximum(sizes[a, None], sizes[None, b])
    prefix = np.minimum(common(front[a], front[b]), shorter)
    suffix = np.minimum(common(back[a], back[b]), shorter)
    return (prefix + suffix >= longer - 1) & (longer - shorter <= 1) & (prefix < longer), prefix, longer


def compared(words: list[str], ns: np.ndarray, longer: np.ndarray, p: np.ndarray, s: np.ndarray, cell: np.ndarray) -> tuple[Counter, dict]:
    """Of rows that lie group by group: near words per word, and per word the best of them as ``(-n, word)``."""
    near, best = Counter(), {}
    width = max(map(len, words))
    step = max(2, min(ROWS, TILE_BYTES // width))
    sizes, front, back = matrices(words)
    # Numbers of groups: a hash may give two cells of different lengths one key.
    group = np.cumsum(np.concatenate(([True], (cell[1:] != cell[:-1]) | (longer[1:] != longer[:-1]) | (p[1:] != p[:-1]) | (s[1:] != s[:-1]))))
    for low in range(0, len(words), step):
        a = slice(low, low + step)
        for other in range(low, len(words), step):
            if other > low and group[other] != group[min(low + step, len(words)) - 1]:
                break
            b = slice(other, other + step)
            hit, prefix, length = tile(sizes, front, back, a, b)
            hit &= group[a, None] == group[None, b]
            hit &= length == longer[a, None]
            hit &= (prefix >= p[a, None]) & (prefix < longer[a, None] - s[a, None])
            if other == low:
                hit &= np.arange(hit.shape[0])[:, None] < np.arange(hit.shape[1])[None, :]
            for i, j in zip(*(x.tolist() for x in np.nonzero(hit)), strict=True):
                i, j = i + low, j + other
                for one, two in ((i, j), (j, i)):
                    near[words[one]] += 1
                    offer = (-int(ns[two]), words[two])
                    if words[one] not in best or offer < best[words[one]]:
                        best[words[one]] = offer
    return near, best


def neighbours(words: DataFrame, limit: int, batch: int = 1 << 14) -> DataFrame:
    """``(word, n_near, form, form_n)``: how many words are near, and the one of largest ``n`` among them, smallest first."""
    rows = groups(words, limit).repartition("cell").sortWithinPartitions("longer", "cell", "p", "s", "word")
    schema = "word string, near long, minus long, form string"

    def answers(held: dict[str, list]) -> Iterator[pa.RecordBatch]:
        kinds = {"n": np.int64, "longer": np.int64, "p": np.int64, "s": np.int64, "cell": np.int64}
        near, best = compared(held["word"], *[np.array(held[name], dtype=kind) for name, kind in kinds.items()])
        if near:
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.keys(), pa.string()), pa.array([near[w] for w in best], pa.int64()),
                 pa.array([x[0] for x in best.values()], pa.int64()), pa.array([x[1] for x in best.values()], pa.string())],
                names=["word", "near", "minus", "form"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A batch is handed over at the end of a group; a group has at most ``limit`` words, or one per letter of the alphabet.
        names = ["word", "n", "longer", "p", "s", "cell"]
        held = {name: [] for name in names}
        for arrived in batches:
            for name in names:
                held[name] += arrived.column(name).to_pylist()
            # Long words make wide matrices, so their batches have fewer rows.
            while len(held["word"]) > batch or len(held["word"]) * len(held["word"][-1]) > 1 << 24:
                cell, cut = held["cell"], len(held["word"]) - 1
                while cut and cell[cut - 1] == cell[-1]:
                    cut -= 1
                if not cut:
                    break
                yield from answers({name: held[name][:cut] for name in names})
                held = {name: held[name][cut:] for name in names}
        if held["word"]:
            yield from answers(held)

    found = rows.select("word", "n", "longer", "p", "s", "cell").mapInArrow(run, schema).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct("minus", "form")).alias("best"))
    return found.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus")).alias("form_n"))


def rooted(forms: DataFrame, steps: int) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: forms followed to the last, where no chain has more than ``steps`` links.

    Every round joins the table with itself and doubles the links that a root lies ahead.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1, steps)))):
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return roots


def variants(docs: DataFrame, length: int = 7, least: int = 2, factor: int = 10, one_in: int = 31, limit: int = LIMIT,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of at least ``length`` code points that occurs ``least`` times.

    A word's form is its near word of largest ``n``, if that is ``factor`` times its own. ``root`` follows forms to the last; a
    chain's counts grow by ``factor`` with each link, so the largest count bounds how often the table is joined with itself.
    """
    words = stored(counted(docs, one_in, length, id_col, text_col).where(F.col("n") >= least), "words")
    near = words.join(neighbours(words, limit), "word", "left")
    has_form = F.col("form_n") >= factor * F.col("n")
    near = stored(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("form")).alias("form"),
                              F.when(has_form, F.col("form_n")).alias("form_n")), "near_words")
    largest = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(largest, factor)))
    roots = rooted(near.where("form IS NOT NULL").select("word", "form"), steps)
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
