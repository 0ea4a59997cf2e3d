import hashlib
import random
from collections import Counter

import pytest

from skyledger.llm import relative_lz
from tests.llm.conftest import corpus, prose


def expected(rows, length):
    words = {(i, t): (t or "").encode().split() for i, t in rows}
    seen = Counter(tuple(w[p:p + length]) for w in words.values() for p in range(len(w) - length + 1))
    out = {}
    for key, w in words.items():
        gone = set()
        for p in range(len(w) - length + 1):
            if seen[tuple(w[p:p + length])] > 1:
                gone.update(range(p, p + length))
        kept = b" ".join(x for n, x in enumerate(w) if n not in gone)
        out[key] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length,gram,block", [(35, 12, 1 << 22), (35, 12, 2000), (5, 2, 500)])
def test_against_brute_force(spark, docs, small, length, gram, block, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    if block == 2000:
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    passage = prose(77, 50)
    rows += [(1000 + n, prose(200 + n, 30) + " " + passage + " " + prose(300 + n, 20)) for n in range(40)]
    rows += [(2000, passage + " " + passage), (2001, "z " * 100), (5000, "again " * 40), (5000, "again " * 40), (None, passage)]
    want = expected(rows, length)
    got = relative_lz.remove_repeats(corpus(spark, [t for _, t in rows], [i for i, _ in rows]), length, gram, block_bytes=block).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256) in [v for (i, _), v in want.items() if i == r.doc_id], r.doc_id
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed


def test_empty_and_other_columns(spark):
    df = corpus(spark, ["a b", None]).selectExpr("*", "1 AS block", "2 AS bucket")
    assert {tuple(r)[:3] for r in relative_lz.remove_repeats(df).collect()} == {(0, 2, 0), (1, 0, 0)}
    assert relative_lz.remove_repeats(corpus(spark, [])).count() == 0


def test_long_texts_are_cut_in_pieces():
    from skyledger.llm.rolling import word_pieces

    words = prose(3, 500).encode().split()
    seen = []
    for first, part in word_pieces(words, 4, 100):
        seen += [(first + p, tuple(part[p:p + 5])) for p in range(len(part) - 4)]
    assert seen == [(p, tuple(words[p:p + 5])) for p in range(len(words) - 4)]


def mirrored(bits: int = 10):
    """The Thue-Morse sequence and its mirror: polynomials modulo a power of two hash both alike."""
    text = "".join("ab"[n.bit_count() % 2] for n in range(1 << bits))
    return text, text.translate(str.maketrans("ab", "ba"))


def test_mirrored_texts_are_not_equal(spark):
    one, two = mirrored()
    assert not set(relative_lz.Words([one.encode()]).runs(1)) & set(relative_lz.Words([two.encode()]).runs(1))
    texts = [" ".join([t] * 35) for t in (one, two)] + [" ".join(t) for t in (one, two)]
    got = {r.doc_id: (r.n_removed, r.n_words) for r in relative_lz.remove_repeats(corpus(spark, texts)).collect()}
    assert got[0] == (0, 35) and got[1] == (0, 35)


def test_runs_tell_windows_apart():
    rng = random.Random(4)
    words = [rng.choice(["a", "b", "ab", "c"]).encode() for _ in range(400)]
    for length in (1, 2, 3, 5, 12, 35, 64, 400, 401):
        hashes = relative_lz.Words(words).runs(length)
        windows = [tuple(words[i:i + length]) for i in range(len(words) - length + 1)]
        assert len(hashes) == len(windows) and len(set(zip(windows, hashes.tolist()))) == len(set(windows)) == len(set(hashes.tolist()))


def test_both_hashes_decide():
    first, second = (relative_lz.np.array(x, dtype=relative_lz.np.uint64) for x in ([2, 2, 2, 8], [5, 6, 7, 1]))
    asked = [(2, 7), (2, 9), (8, 1), (8, 5), (4, 5)]
    a, b = (relative_lz.np.array(x, dtype=relative_lz.np.uint64) for x in zip(*asked))
    assert relative_lz.among(a, b, first, second).tolist() == [True, False, True, False, False]
