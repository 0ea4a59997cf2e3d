import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from skyledger.llm import queries
from skyledger.llm import spelling_variants as sv
from tests.compare import connect, difference
from tests.llm.conftest import corpus


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def expected(rows, length=7, least=2, factor=10, one_in=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= least}
    out, forms = {}, {}
    for w, n in words.items():
        close = [(-words[x], x) for x in words if near(w, x)]
        best = min(close, default=None)
        if best and -best[0] >= factor * n:
            forms[w] = best[1]
        out[w] = (forms.get(w), n, len(close), words[forms[w]] if w in forms else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while root in forms:
            root = forms[root]
        rows.append((w, form or "", root, n, n_near, form_n))
    return sorted(rows, key=lambda r: r[0])


def shown(df):
    return sorted(((r[0], r[1] or "", *r[2:]) for r in df.collect()), key=lambda r: r[0])


def made(seed, n, letters, sizes):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(n)]
    return [w for w in words for _ in range(rng.choice((1, 2, 3, 40)))]


@pytest.mark.parametrize("limit", [2, 5, 512])
def test_against_brute_force(spark, limit):
    words = made(limit, 400, "abÀ", (5, 6, 7)) + made(1, 200, "abcdeé", (4, 5)) + ["Hello", "hello", "heLlo"] * 9
    random.Random(3).shuffle(words)
    texts = [" ".join(words[i::23]) for i in range(23)]
    texts += ["", None, "1 2 3", texts[0], texts[0], "q" * 3000 + " " + "q" * 2999 + "z"] * 2
    ids = [*range(len(texts) - 1), None]
    df = corpus(spark, texts, ids).repartition(5)
    got = shown(sv.variants(df, length=4, one_in=5, limit=limit))
    want = expected(list(zip(ids, texts, strict=True)), length=4, one_in=5)
    assert [tuple(r) for r in got] == want and sum(r[4] for r in got) > 500


def test_hot_beginning_is_parted_and_chains_end(spark):
    """Most words share their first half; every one is compared with all that can be near, in groups of a few words."""
    rng = random.Random(7)
    words = sorted({"common" + "".join(rng.choice("abc") for _ in range(6)) for _ in range(400)})
    ladder = ["chainword"] * 3000 + ["chainwore"] * 250 + ["chainqore"] * 22 + ["chainqoree"] * 2
    text = " ".join([*words, *words, *ladder])
    df = corpus(spark, [text])
    got = shown(sv.variants(df, limit=4, one_in=1 << 40))
    assert [tuple(r) for r in got] == expected([(0, text)], one_in=1 << 40)
    roots = {r[0]: r[2] for r in got}
    assert roots["chainqoree"] == roots["chainqore"] == roots["chainwore"] == "chainword"
    sizes = sv.groups(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), 4).groupBy("cell").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 4


def test_pairs_of_equal_letters_count_once(spark):
    """An added letter in a run of equal letters fits several places."""
    words = ["aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "baaaaaaa", "aaaaaaab", "aaaabaaaa"]
    df = corpus(spark, [" ".join(words * 2)])
    for limit in (1, 2, 100):
        assert [tuple(r) for r in shown(sv.variants(df, limit=limit, one_in=1 << 40))] == expected([(0, " ".join(words * 2))], one_in=1 << 40)


def test_tile_of_padded_matrices():
    words = ["kitten", "sitten", "kittens", "kitte", "mitten", "knitten", "itten", "中itten", "kittne"]
    sizes, front, back = sv.matrices(words)
    hit, prefix, _ = sv.tile(sizes, front, back, slice(0, 9), slice(0, 9))
    assert [[bool(hit[i, j]) for j in range(9)] for i in range(9)] == [[near(a, b) for b in words] for a in words]
    assert prefix[0, 2] == 6 and prefix[0, 1] == 0 and front.dtype == np.uint32


def test_empty_and_other_names(spark):
    df = corpus(spark, ["samewords samewords samewordz samewordz"]).selectExpr("doc_id AS word", "text AS n", "1 AS cell", "2 AS longer")
    got = shown(sv.variants(df, one_in=1 << 40, id_col="word", text_col="n"))
    assert [tuple(r) for r in got] == [("samewords", "", "samewords", 2, 1, None), ("samewordz", "", "samewordz", 2, 1, None)]
    none = sv.variants(corpus(spark, []))
    assert none.columns == ["word", "form", "root", "n", "n_near", "form_n"] and none.count() == 0


def test_same_as_sql(spark, small):
    sql = queries.ORACLES["op12_spelling_variants"]
    assert difference(queries.op12_spelling_variants(spark, small), connect(small), sql) is None
