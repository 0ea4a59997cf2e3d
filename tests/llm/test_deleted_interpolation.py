import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyledger.llm import deleted_interpolation as lm
from skyledger.llm.common import fold
from tests.llm.conftest import corpus, prose


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def slow(rows, role):
    """Everything by hand, the weights too."""
    tokens = {i: split(t) for i, t in rows}
    uni, pair, cut_uni, cut_pair = Counter(), Counter(), Counter(), Counter()
    for i, w in tokens.items():
        if role[i]:
            uni.update(w + ["<s>"])
            pair.update(zip(["<s>"] + w, w))
        if role[i] == 2:
            cut_uni.update(w + ["<s>"])
            cut_pair.update(zip(["<s>"] + w, w))
    n, v = sum(c for w, c in uni.items() if w != "<s>"), len([w for w in uni if w != "<s>"])
    level = lambda c: min(int(math.log2(c)) + 1, lm.LEVELS - 1) if c > 0 else 0
    q = lambda p: round(-math.log(p) * lm.GRID) if p > 0 else -1
    cells = Counter()
    gone = sum(c for w, c in cut_uni.items() if w != "<s>")
    for i, w in tokens.items():
        if role[i] == 2:
            for a, b in zip(["<s>"] + w, w):
                c = uni[a] - cut_uni[a]
                cells[level(c), q((pair[a, b] - cut_pair[a, b]) / c if c else 0), q((uni[b] - cut_uni[b]) / (n - gone) if n > gone else 0)] += 1
    import numpy as np
    mix = lm.weights(np.array([(*k, c) for k, c in cells.items()], dtype=float), v)
    out = {}
    for i, w in tokens.items():
        base = sum(math.log10((uni[b] + 0.5) / (n + 0.5 * (v + 1))) for b in w)
        total = 0.0
        for a, b in zip(["<s>"] + w, w):
            m = mix[level(uni[a])]
            total += math.log10(m[0] * (pair[a, b] / uni[a] if uni[a] else 0) + m[1] * (uni[b] / n if n else 0) + m[2] / (v + 1))
        out[i] = (len(w), sum(uni[b] > 0 for b in w), n, base, total)
    return out


@pytest.mark.parametrize("block", [1 << 22, 1500])
def test_against_brute_force(spark, docs, block):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(100, "New NEW new\x0bnew"), (101, "w1 w2")]
    role = {i: (0, 1, 1, 2)[i % 4] for i, _ in rows}
    want = slow(rows, role)
    df = corpus(spark, [t for _, t in rows], [i for i, _ in rows])
    got = lm.score(df, F.col("doc_id") % 4 != 0, F.col("doc_id") % 4 == 3, block_bytes=block).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = want[r.doc_id]
        assert (r.trained, r.n_tokens, r.n_known, r.train_tokens) == (role[r.doc_id] > 0, n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_better_than_unigrams_on_held_out_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm.score(table, fold(F.col("doc_id")) != 1, fold(F.col("doc_id"), 50) % 10 == 4).where("NOT trained").agg(F.sum("base_score"), F.sum("score")).first()
    assert rows[1] > rows[0]


def test_weights_sum_to_one_and_edges(spark):
    assert lm.weights(__import__("numpy").zeros((0, 4)), 5).sum(axis=1) == pytest.approx(1)
    df = corpus(spark, ["a b", None, "a b"], [1, None, 1]).selectExpr("*", "1 AS block", "2 AS words")
    got = lm.score(df, F.lit(True), F.lit(False)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 3, 3] and {r.train_tokens for r in got} == {7}
    none = lm.score(df, F.lit(False), F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in none} == {(0, 0)} and all(r.score < 0 for r in none)
    assert lm.score(corpus(spark, []), F.lit(True), F.lit(True)).count() == 0


def test_mirrored_words_are_counted_apart():
    from tests.llm.test_relative_lz import mirrored

    one, two = mirrored()
    word = lm.Tokens([f"{one} {two} {one}", ""]).word
    assert word[0] == word[2] != word[1] and word[3] == word[4] == lm.END
