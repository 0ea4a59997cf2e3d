import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import packing
from tests.llm.conftest import corpus

PATH = public_tokenizers.path("byte_bpe_50k.json")


def slow_best_fit(lengths, size):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(size - n)
    return Counter(room)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    size = rng.choice([7, 16, 64])
    lengths = [rng.randint(1, rng.choice([3, size])) for _ in range(rng.choice([1, 5, 80, 300]))]
    room, seen = defaultdict(lambda: size), set()
    at = defaultdict(list)
    for length, rank, items, first, offset in packing.plan(Counter(lengths), size):
        for k in range(items):
            assert (length, rank + k) not in seen
            seen.add((length, rank + k))
            room[first + k] -= length
            at[first + k].append((offset, length))
    assert len(seen) == len(lengths) and Counter(length for length, _ in seen) == Counter(lengths)
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
    assert Counter(room.values()) == slow_best_fit(lengths, size)


def test_round_trip(spark, docs, small):
    tokens = Tokenizer.from_file(PATH)
    table = spark.read.parquet(f"{small}/documents.parquet")
    texts = [r.text for r in docs.collect()] + [r.text for r in table.collect()] + ["a<|endoftext|>b", "x" * 3000, " " * 5000, "'S it's\r\n\t z"]
    rows = packing.pack(corpus(spark, texts), PATH, part_rows=50).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, text in enumerate(texts):
        ids = np.array(tokens.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        end = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == end and r.doc_tokens == len(ids) and r.length <= 1024
            assert r.ids_crc32 == zlib.crc32(ids[end:end + r.length].tobytes())
            end += r.length
        assert end == len(ids)
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= total // 1024 + 2


def test_hot_length_repeated_and_empty(spark):
    rows = packing.pack(corpus(spark, ["same text"] * 500 + [None, ""], [1] * 500 + [2, None]), PATH, part_rows=7).collect()
    assert len(rows) == 502 and len({(r.sequence_id, r.offset) for r in rows}) == 502
    empty = packing.pack(corpus(spark, []), PATH)
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "start"]
