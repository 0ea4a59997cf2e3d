import hashlib
import random

import pytest

from skyledger.llm import induced_sorting
from tests.llm.conftest import corpus, prose


def expected(rows, length):
    seen, out = set(), {}
    for i, t in sorted(set(((-(1 << 63) if i is None else i), t or "") for i, t in rows)):
        raw = t.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (n and gone[n - 1]) for n, g in enumerate(gone))
        out[None if i == -(1 << 63) else i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length,gram,block,wide", [(100, 28, 1 << 22, 20_000), (100, 28, 3000, 3), (20, 5, 700, 20_000), (20, 5, 700, 2)])
def test_against_brute_force(spark, docs, small, length, gram, block, wide):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    if block == 3000:
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    passage = prose(77, 50)
    rng = random.Random(4)
    rows += [(1000 + n, prose(200 + n, 30) + " " + passage + " " + prose(300 + n, 20)) for n in range(40)]
    rows += [(2000, passage + " " + passage), (2001, "z" * 900), (2002, "ab" * 300 + "\0" * 150 + "c" + "\0" * 140), (None, passage)]
    rows += [(3000 + n, "".join(rng.choice("ab") for _ in range(400))) for n in range(20)] + [(5000, "again " * 40)] * 2
    want = expected(rows, length)
    got = induced_sorting.remove_repeats(corpus(spark, [t for _, t in rows], [i for i, _ in rows]), length, gram, block_bytes=block, wide=wide).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id], r.doc_id


def test_empty_and_other_columns(spark):
    df = corpus(spark, ["a b", None]).selectExpr("*", "1 AS block", "2 AS bucket")
    assert {tuple(r)[:4] for r in induced_sorting.remove_repeats(df).collect()} == {(0, 3, 0, 0), (1, 0, 0, 0)}
    assert induced_sorting.remove_repeats(corpus(spark, [])).count() == 0
