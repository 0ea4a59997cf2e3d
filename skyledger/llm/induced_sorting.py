"""Substring de-duplication on a suffix array built by external induced sorting.

Only the order of suffixes up to ``length`` bytes matters for windows of that length, and only suffixes that begin inside a
window some other place may share. So the suffix array is built in shards that never need each other:

1. Sample. The anchors of all windows (see ``rolling``) are the sampled suffixes, in the role of the left-most S-type positions of
   induced sorting: content decides where they are, so equal texts have the same ones. Anchors that stand once in the corpus drop out.
2. Shard. The bytes around every remaining anchor go to the shard of its hash through Spark's shuffle, which is an external merge
   sort on disk; a shard is a few megabytes however large the corpus is. A suffix tuple is the anchor's place with those bytes.
3. Induce. In a shard the sampled suffixes are sorted and the common-prefix lengths of neighbours taken. Then order and lengths
   are induced to the suffixes one byte further left, again and again: their order is that of (byte, rank), and the
   common prefix of two neighbours with equal bytes is one more than the least common prefix between them one step before.
4. Name. At every step, neighbours with a common prefix of ``length`` are one window. Its earliest place stays.

Hot substrings: equal stretches inside a block of documents are settled there, and an anchor with more than ``wide`` places is
not one shard entry per place: its windows are sharded by their own content. Nothing is capped.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm import exchange
from skyledger.llm.common import NULL_ID
from skyledger.llm.relative_lz import answers, runs
from skyledger.llm.rolling import PIECE_BYTES, Slices, anchors, tallied

U = np.uint64
LOW = U(63)
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
PLACES = {"doc": "<i8", "text": "<u4", "start": "<u4", "count": "u1"}
TUPLES = PLACES | {"back": "u1"}


class Suffixes:
    """The windows of one piece of a text: for each its anchor; runs of windows with one anchor are stretches."""

    def __init__(self, data: bytes, length: int, gram: int):
        self.count = len(data) - length + 1
        self.slices = Slices(data)
        at = np.arange(len(data) - gram + 1)
        grams = self.slices.hashes(at, at + gram)
        place = anchors(grams, length - gram + 1)
        self.first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        self.stop = np.append(self.first[1:], self.count)
        self.place = place[self.first]
        self.anchor = grams[self.place] & ~LOW


def pieces(table: pa.Table, length: int, gram: int):
    """``(doc_id, text key, offset of the piece, its bytes, its suffixes)`` for all distinct documents, in order of their place."""
    rows = [(doc_id, zlib.crc32(raw), raw) for doc_id, raw in ((i, text.encode()) for i, text in exchange.texts_of(table))]
    for doc_id, key, raw in sorted(rows):
        for at in range(0, max(1, len(raw)), PIECE_BYTES):
            data = raw[at:at + PIECE_BYTES + length - 1]
            if len(data) >= length:
                yield doc_id, key, at, data, Suffixes(data, length, gram)


def sample_letters(shards: int, length: int, gram: int):
    """Step 1, per block: its distinct anchors; the low bits hold how often each stands there, as a power of two."""
    def run(key, table):
        found = [s.anchor for *_, s in pieces(table, length, gram)]
        values, counts = tallied(np.concatenate(found) if found else np.zeros(0, dtype=np.uint64))
        marked = values | np.ceil(np.log2(counts + 1)).astype(np.uint64)  # 1: once
        return exchange.letters([(to, key[0].as_py(), part) for to, part in exchange.parcels(
            (values >> U(32)) % U(shards), anchor=marked)], ["anchor"])
    return run


def sample_answers(wide: int):
    """Step 1, per shard: answers every block with its anchors that stand more than once; the low bit marks wide ones."""
    def run(key, table):
        block, got = exchange.received(table, anchor="<u8")
        plain, power = got["anchor"] & ~LOW, (got["anchor"] & LOW).astype(np.int64)
        values, place = np.unique(plain, return_inverse=True)
        total = np.bincount(place, weights=2.0 ** power - 1) if len(values) else np.zeros(0)
        keep = total[place] > 1
        marked = plain | (total[place] > wide).astype(np.uint64)
        return exchange.letters([(key[0].as_py(), to, part) for to, part in exchange.parcels(block[keep], anchor=marked[keep])], ["anchor"])
    return run


def tuple_letters(shards: int, length: int, gram: int):
    """Step 2, per block: suffix tuples for the shards, and notes to itself on stretches that repeat inside the block."""
    def run(key, table, replies):
        index = answers(replies, "anchor")
        plain, is_wide = index & ~LOW, (index & U(1)) == U(1)
        columns: dict[str, list[np.ndarray]] = {name: [] for name in ["key", "same", *TUPLES]}
        content: list[bytes] = []
        for doc_id, text, at, data, s in pieces(table, length, gram) if len(index) else ():
            where = np.minimum(np.searchsorted(plain, s.anchor), len(plain) - 1)
            hit = plain[where] == s.anchor
            first, stop, place, anchor, wide = (x[hit] for x in (s.first, s.stop, s.place, s.anchor, is_wide[where]))
            if wide.any():  # every window of a wide anchor by itself
                times = np.where(wide, stop - first, 1)
                within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                first, stop, place, anchor, wide = (np.repeat(x, times) for x in (first, stop, place, anchor, wide))
                first = first + within * wide
                stop = np.where(wide, first + 1, stop)
            same = s.slices.hashes(first, stop + length - 1)
            made = {"key": np.where(wide, same, anchor), "same": same, "doc": np.full(len(first), doc_id), "text": np.full(len(first), text),
                    "start": first + at, "count": stop - first, "back": place - first}
            for name, column in made.items():
                columns[name].append(column)
            content += [data[a:b] for a, b in zip(first.tolist(), (stop + length - 1).tolist(), strict=True)]
        if not content:
            return exchange.letters([], [*TUPLES, "bytes"])
        joined = {name: np.concatenate(parts) for name, parts in columns.items()}
        typed = {name: joined[name].astype(kind) for name, kind in TUPLES.items()}
        # Of equal stretches the first is the earliest, as places were visited in order; all others are duplicate.
        order = np.lexsort((np.arange(len(content)), joined["same"], joined["key"]))
        again = np.concatenate(([False], (np.diff(joined["same"][order]) == 0) & (np.diff(joined["key"][order]) == 0)))
        copies, heads = np.sort(order[again]), np.sort(order[~again])
        sent = []
        for to, part in exchange.parcels((joined["key"][heads] >> U(32)) % U(shards), at=heads):
            picked = part["at"]
            sent.append((to, key[0].as_py(), {name: column[picked] for name, column in typed.items()} | {
                "bytes": b"".join([content[i] for i in picked.tolist()])}))
        sent.append((shards + key[0].as_py(), key[0].as_py(), {name: column[copies] for name, column in typed.items()} | {"bytes": b""}))
        return exchange.letters(sent, [*TUPLES, "bytes"])
    return run


class LeastBetween:
    """Least value of ``values[a + 1 .. b]`` for many pairs ``a < b`` at once."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), dtype=self.levels[0].dtype)
        level = np.log2(np.maximum(b - a, 1)).astype(np.int64)
        for n in np.unique(level):
            at = level == n
            out[at] = np.minimum(self.levels[n][a[at] + 1], self.levels[n][b[at] - (1 << n) + 1])
        return out


def induced(content: np.ndarray, begin: np.ndarray, back: np.ndarray, count: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Marks, per tuple and window, of the windows that an earlier tuple has too.

    A tuple's bytes start at ``begin`` in ``content``; its anchor is ``back`` bytes further on, its ``count`` windows start at
    its first bytes. ``order`` ranks the places of the anchors.
    """
    rows = len(begin)
    duplicate = np.zeros((rows, int(count.max())), dtype=bool)
    right = count + length - 1 - back  # bytes from the anchor on
    inside = np.arange(length + (-length) % 8)
    at = np.minimum((begin + back)[:, None] + inside, len(content) - 1)
    suffix = np.where(inside < right[:, None], content[at], 0).astype(np.uint8)
    keys = suffix.view(">u8")
    sa = np.lexsort((right, *[keys[:, n] for n in range(keys.shape[1] - 1, -1, -1)]))  # shorter ones before their extensions
    differ = suffix[sa[1:]] != suffix[sa[:-1]]
    lcp = np.zeros(rows, dtype=np.int64)
    lcp[1:] = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), suffix.shape[1]), np.minimum(right[sa[1:]], right[sa[:-1]]))
    for step in range(int(back.max()) + 1):
        if step:
            least = LeastBetween(lcp)
            old = np.flatnonzero(back[sa] >= step)
            byte = content[begin[sa[old]] + back[sa[old]] - step]
            moved = np.argsort(byte, kind="stable")
            old, byte = old[moved], byte[moved]
            same = byte[1:] == byte[:-1]
            lcp = np.zeros(len(old), dtype=np.int64)
            lcp[1:][same] = 1 + least(old[:-1][same], old[1:][same])
            sa = sa[old]
        live = np.flatnonzero(back[sa] - step < count[sa])  # tuples with a window that starts here
        if len(live) > 1:
            reach = LeastBetween(lcp)(live[:-1], live[1:])
            name = np.concatenate(([0], np.flatnonzero(reach < length) + 1))
            row = sa[live]
            earliest = np.repeat(np.minimum.reduceat(order[row], name), np.diff(np.append(name, len(row))))
            late = row[order[row] != earliest]
            duplicate[late, back[late] - step] = True
    return duplicate


def shard_letters(shards: int, length: int):
    """Step 3 and 4, per shard: answers every block with its windows that stand earlier. Notes of a block go back as they are."""
    def run(key, table):
        block, got = exchange.received(table, **TUPLES)
        shard = key[0].as_py()
        if shard >= shards or not len(block):
            return exchange.letters([(shard, to, part) for to, part in exchange.parcels(block, **{n: got[n] for n in PLACES})], list(PLACES))
        content = np.frombuffer(b"".join(table.column("bytes").to_pylist()), dtype=np.uint8)
        count, back, start = (got[name].astype(np.int64) for name in ("count", "back", "start"))
        size = count + length - 1
        order = np.empty(len(block), dtype=np.int64)
        order[np.lexsort((start + back, got["text"], got["doc"]))] = np.arange(len(block))
        marks = induced(content, np.cumsum(size) - size, back, count, order, length)
        edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        stop = np.nonzero(edge == -1)[1]
        made = {"doc": got["doc"][row], "text": got["text"][row], "start": (start[row] + first).astype("<u4"), "count": (stop - first).astype("u1")}
        return exchange.letters([(shard, to, part) for to, part in exchange.parcels(block[row], **made)], list(PLACES))
    return run


def cleaner(length: int):
    """Step 5, per block: removes the bytes that duplicate windows cover."""
    def run(key, table, replies):
        got = exchange.received(replies, **PLACES)[1]
        order = np.lexsort((got["text"], got["doc"]))
        doc, text, start, count = (got[name][order] for name in PLACES)
        cuts = np.concatenate(([0], np.flatnonzero((np.diff(doc) != 0) | (np.diff(text.astype(np.int64)) != 0)) + 1, [len(doc)])) if len(doc) else [0]
        parts = {(int(doc[a]), int(text[a])): (a, b) for a, b in zip(cuts, cuts[1:], strict=False)}
        out = []
        for doc_id, value in zip(table.column("doc_id").to_pylist(), table.column("text"), strict=True):
            raw = value.as_py().encode()
            a, b = parts.get((doc_id, zlib.crc32(raw)), (0, 0))
            change = np.zeros(len(raw) + 1, dtype=np.int64)
            np.add.at(change, start[a:b].astype(np.int64), 1)
            np.add.at(change, start[a:b].astype(np.int64) + count[a:b].astype(np.int64) + length - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
            out.append((None if doc_id == NULL_ID else doc_id, len(raw), int(gone.sum()), len(runs(gone)), hashlib.sha256(kept).hexdigest()))
        kinds = [pa.int64()] * 4 + [pa.string()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        return pa.table([pa.array([row[n] for row in out], kind) for n, kind in enumerate(kinds)], names=names)
    return run


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = 28, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = exchange.BLOCK_BYTES, wide: int = 20_000) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row.

    Removed are all bytes covered by a string of ``length`` bytes that also starts earlier: in a document with a smaller id, or
    before in the same one. A row repeated whole (same id and text) is one document and gets the same result each time; rows that
    share an id but not the text are ordered by a checksum of it. Null texts are empty. ``length`` is at most 255; ``gram``,
    ``block_bytes`` and ``wide`` do not change the result.
    """
    texts, blocks = exchange.blocked(docs, block_bytes, id_col, text_col)
    per_block = lambda frame: texts.groupBy("block").cogroup(frame.groupBy("block"))
    sample = texts.groupBy("block").applyInArrow(sample_letters(blocks, length, gram), exchange.schema(["anchor"]))
    sample = sample.groupBy("bucket").applyInArrow(sample_answers(wide), exchange.schema(["anchor"]))
    tuples = per_block(sample).applyInArrow(tuple_letters(blocks, length, gram), exchange.schema([*TUPLES, "bytes"]))
    found = tuples.groupBy("bucket").applyInArrow(shard_letters(blocks, length), exchange.schema(list(PLACES)))
    return per_block(found).applyInArrow(cleaner(length), RESULT)
