"""Substring de-duplication by relative Lempel-Ziv parsing.

Every block of documents is both a reference and a text to parse. The index of the reference blocks holds the anchors of all
their word windows (see ``rolling``): a window can stand in another place only if its anchor does. A document is parsed
greedily, left to right, against the index of all blocks: a factor starts at the first window whose anchor another place
shares and goes on for as long as each further window's anchor is shared too; what is between factors is literal. Factors are
at least a window long, but their windows may have been gathered from several reference places. So each factor is checked
window by window, over its boundaries and inside, against the windows of all other factors, by 127-bit hashes. Windows that
stand anywhere else are duplicate, and the words they cover are removed.

Index and check are packed exchanges (see ``exchange``): a passage that is in a third of all documents is one entry per block.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm import exchange
from skyledger.llm.common import NULL_ID
from skyledger.llm.rolling import Words, anchors, known, tallied, word_pieces

U = np.uint64
ONE = U(1)
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,stop:long>>"


class Windows:
    """The windows of one piece of a text: anchor hashes and, on request, two independent hashes of each."""

    def __init__(self, words: list[bytes], length: int, gram: int):
        self.length = length
        self.count = max(0, len(words) - length + 1)
        if self.count:
            self.words = Words(words)
            grams = self.words.runs(gram)
            # The lowest bit is kept free for marks.
            self.place = anchors(grams, length - gram + 1)
            self.anchor = grams[self.place] & ~ONE

    def names(self, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of the windows that start at the words from ``first`` to ``stop``; together 127 bits."""
        return tuple(x[first:stop] for x in self.both)

    @functools.cached_property
    def both(self) -> tuple[np.ndarray, np.ndarray]:
        return self.words.runs(self.length, 1) & ~ONE, self.words.runs(self.length, 0)


def pieces(table: pa.Table, length: int, gram: int):
    """The windows of every piece of a block's documents."""
    for _, text in exchange.texts_of(table):
        for _, words in word_pieces(text.encode().split(), length - 1):
            windows = Windows(words, length, gram)
            if windows.count:
                yield windows


def index_letters(buckets: int, length: int, gram: int):
    """Step 1, per block: its distinct anchors; the lowest bit marks those that stand in the block more than once."""
    def run(key, table):
        found = [w.anchor[np.concatenate(([True], w.place[1:] != w.place[:-1]))] for w in pieces(table, length, gram)]
        values, counts = tallied(np.concatenate(found) if found else np.zeros(0, dtype=np.uint64))
        marked = values | (counts > 1).astype(np.uint64)
        sent = [(to, key[0].as_py(), part) for to, part in exchange.parcels((values >> U(32)) % U(buckets), anchor=marked)]
        return exchange.letters(sent, ["anchor"])
    return run


def shared(key, table):
    """Step 2, per bucket: answers every block with its anchors that stand more than once in the corpus."""
    block, got = exchange.received(table, anchor="<u8")
    plain = got["anchor"] & ~ONE
    values, place, counts = np.unique(plain, return_inverse=True, return_counts=True)
    twice = counts > 1
    twice[place[(got["anchor"] & ONE) == ONE]] = True
    keep = twice[place]
    sent = [(key[0].as_py(), to, part) for to, part in exchange.parcels(block[keep], anchor=plain[keep])]
    return exchange.letters(sent, ["anchor"])


def answers(table: pa.Table, name: str) -> np.ndarray:
    """The sorted hashes that the buckets answered."""
    return np.sort(exchange.received(table, **{name: "<u8"})[1][name])


def factors(windows: Windows, index: np.ndarray) -> list[tuple[int, int]]:
    """Greedy parse: maximal runs ``(first window, end)`` of windows whose anchors are all in the index."""
    hit = known(windows.anchor, index)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def factor_letters(buckets: int, length: int, gram: int):
    """Step 3, per block: the distinct windows of its factors; the lowest bit marks repeats inside the block."""
    def run(key, table, replies):
        index, firsts, seconds = answers(replies, "anchor"), [], []
        for windows in pieces(table, length, gram):
            for first, stop in factors(windows, index):
                a, b = windows.names(first, stop)
                firsts.append(a)
                seconds.append(b)
        if not firsts:
            return exchange.letters([], ["first", "second"])
        a, b = np.concatenate(firsts), np.concatenate(seconds)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        repeats = np.diff(np.append(np.flatnonzero(fresh), len(a))) > 1
        a, b = a[fresh], b[fresh]
        sent = [(to, key[0].as_py(), part) for to, part in exchange.parcels(
            (a >> U(32)) % U(buckets), first=a | repeats.astype(np.uint64), second=b)]
        return exchange.letters(sent, ["first", "second"])
    return run


def repeated(key, table):
    """Step 4, per bucket: answers every block with its windows that stand more than once in the corpus."""
    block, got = exchange.received(table, first="<u8", second="<u8")
    plain, second = got["first"] & ~ONE, got["second"]
    order = np.lexsort((second, plain))
    fresh = np.concatenate(([True], (plain[order][1:] != plain[order][:-1]) | (second[order][1:] != second[order][:-1])))
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    twice = np.bincount(group) > 1
    twice[group[(got["first"] & ONE) == ONE]] = True
    keep = twice[group]
    sent = [(key[0].as_py(), to, part) for to, part in exchange.parcels(block[keep], first=plain[keep], second=second[keep])]
    return exchange.letters(sent, ["first", "second"])


def among(a: np.ndarray, b: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which pairs of ``a`` and ``b`` are among the pairs of ``first``, which is sorted, and ``second``."""
    at, stop = np.searchsorted(first, a, "left"), np.searchsorted(first, a, "right")
    hit = np.zeros(len(a), dtype=bool)
    while (at < stop).any():
        open_ = at < stop
        hit[open_] |= second[at[open_]] == b[open_]
        at += 1
    return hit


def covered(count: int, length: int, hit: np.ndarray) -> np.ndarray:
    """Which of ``count`` units lie in a window of ``length`` units that starts where ``hit`` says."""
    change = np.zeros(count + 1, dtype=np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, np.minimum(hit + length, count), -1)
    return np.cumsum(change[:-1]) > 0


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs ``(start, stop)`` of a mask."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def cleaner(length: int, gram: int):
    """Step 5, per block: removes the words that repeated windows cover."""
    def run(key, table, replies):
        got, out = exchange.received(replies, first="<u8", second="<u8")[1], {}
        order = np.argsort(got["first"], kind="stable")
        names = got["first"][order], got["second"][order]
        for doc_id, text in set(exchange.texts_of(table)):
            words = text.encode().split()
            hits = []
            for first, part in word_pieces(words, length - 1):
                windows = Windows(part, length, gram)
                if windows.count and len(order):
                    hits.append(first + np.flatnonzero(among(*windows.both, *names)))
            gone = covered(len(words), length, np.concatenate(hits) if hits else np.zeros(0, dtype=np.int64))
            kept = b" ".join(word for word, drop in zip(words, gone.tolist(), strict=True) if not drop)
            out[doc_id, text] = (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                                 [{"start": a, "stop": b} for a, b in runs(gone)])
        rows = list(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True))
        made = [out[row] for row in rows]
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table({
            "doc_id": pa.array([None if i == NULL_ID else i for i, _ in rows], pa.int64()),
            "n_words": pa.array([m[0] for m in made], pa.int64()), "n_removed": pa.array([m[1] for m in made], pa.int64()),
            "kept_sha256": pa.array([m[2] for m in made], pa.string()), "spans": pa.array([m[3] for m in made], span)})
    return run


def remove_repeats(docs: DataFrame, length: int = 35, gram: int = 12, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = exchange.BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, spans)`` per row: ``spans`` are the removed runs of words.

    Words are separated by ASCII white space. A window is ``length`` words of one document; all words of a window whose words
    stand in that order anywhere else, in another document or elsewhere in the same one, are removed. A row repeated whole (same
    id and text) is one document and gets the same result each time; the same text under two ids repeats itself. Null and empty
    texts have no words. ``gram`` is the length of an anchor and does not change the result.
    """
    texts, blocks = exchange.blocked(docs, block_bytes, id_col, text_col)
    per_block = lambda frame: texts.groupBy("block").cogroup(frame.groupBy("block"))
    index = texts.groupBy("block").applyInArrow(index_letters(blocks, length, gram), exchange.schema(["anchor"]))
    index = index.groupBy("bucket").applyInArrow(shared, exchange.schema(["anchor"]))
    names = per_block(index).applyInArrow(factor_letters(blocks, length, gram), exchange.schema(["first", "second"]))
    names = names.groupBy("bucket").applyInArrow(repeated, exchange.schema(["first", "second"]))
    return per_block(names).applyInArrow(cleaner(length, gram), RESULT)
