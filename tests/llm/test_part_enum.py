import random
import re

import numpy as np
import pytest

from skyledger.llm import part_enum
from tests.llm.conftest import corpus, prose


def grams(text, length):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + length]) for i in range(max(1, len(w) - length + 1))} if w else set()


def expected(rows, length=5, percent=80):
    sets = [grams(t, length) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = [(-(1 << 63) if i is None else i) for i, _ in rows]
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return sorted((ids[i], len(sets[i]), least[find(i)]) for i in range(len(rows)))


def result(df, **more):
    return sorted(tuple(-(1 << 63) if v is None else v for v in r) for r in part_enum.join(df, **more).collect())


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        at = rng.randrange(len(w))
        w[at:at + rng.choice([0, 1, 1, 2])] = [f"n{rng.randrange(10**6)}"] * rng.choice([0, 1, 1])
    return " ".join(w)


def rows_for(seed):
    rng = random.Random(seed)
    texts = []
    for n in range(12):
        root = prose(seed * 100 + n, rng.choice([6, 9, 14, 30, 80, 150, 400]), 5000)
        texts += [root] + [edited(rng, root, rng.randrange(0, 1 + len(root.split()) // 20)) for _ in range(rng.choice([0, 1, 2, 9]))]
    chain = [prose(seed, 120, 5000)]
    for _ in range(12):  # each link is close to the threshold
        chain.append(edited(rng, chain[-1], 2))
    passage = prose(1234, 40, 5000)
    return texts + chain + [prose(seed + 7000 + n, 30, 5000) + " " + passage for n in range(90)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, docs, seed, monkeypatch):
    monkeypatch.setattr(part_enum, "SMALL", 1 + seed)
    texts = rows_for(seed) + [r.text for r in docs.collect()]
    rows = list(enumerate(texts)) + [(5, texts[5]), (None, texts[7])]
    df = corpus(spark, [t for _, t in rows], [i for i, _ in rows])
    assert result(df, bucket_bytes=30_000, rounds=1 + seed % 2) == expected(rows)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        size = int(rng.integers(1, rng.choice([12, 60, 400])))
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        drop = int(rng.integers(0, max(1, len(a) // 5) + 1))
        b = np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, max(1, len(a) // 5) + 1)), dtype=np.uint64) * np.uint64(2))))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both) and not np.array_equal(a, b):
            sa = {(t, int(s)) for t, ss, _ in part_enum.signatures(a, 80) for s in ss}
            sb = {(t, int(s)) for t, ss, _ in part_enum.signatures(b, 80) for s in ss}
            assert sa & sb, (len(a), len(b), both)


def test_hot_groups_and_empty(spark):
    rng = random.Random(3)
    root = prose(9, 60, 4000)
    rows = list(enumerate([root] * 200 + [edited(rng, root, 1) for _ in range(200)] + ["", None, "a", "A", "a b"]))
    assert result(corpus(spark, [t for _, t in rows])) == expected(rows)
    df = corpus(spark, []).withColumnRenamed("lang", "node")
    assert part_enum.join(df).count() == 0


def test_mirrored_texts_are_not_linked(spark):
    from tests.llm.test_relative_lz import mirrored

    rows = [(n + 1, " ".join([text] * 9)) for n, text in enumerate(mirrored())]
    assert result(corpus(spark, [t for _, t in rows], [i for i, _ in rows])) == expected(rows) == [(1, 1, 1), (2, 1, 2)]


def test_bitmaps_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(6)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 3000)), dtype=np.uint64)) for _ in range(2))
        b = np.union1d(b, a[:int(rng.integers(0, len(a) + 1))])
        bits = part_enum.bitmap(a) ^ part_enum.bitmap(b)
        assert len(bits) * 64 == part_enum.BITS and sum(int(x).bit_count() for x in bits.view(np.uint64)) <= len(np.setxor1d(a, b))


def test_similar_sets_stay_in_a_group_they_share(spark):
    rng = random.Random(8)
    rows, shared = [], {}
    for tag in range(40):
        lists = [sorted(rng.sample(range(30), rng.randrange(5, 25))) for _ in range(2)]
        both = len(set(lists[0]) & set(lists[1]))
        shared[tag] = both
        for node, own in enumerate(lists):
            rows += [(tag * 100 + g, node, tag, 1 + g % 7 * 3, 50, rng.randrange(0, both + 1) if g == own[0] else 0, 1) for g in own]
    found = spark.createDataFrame(rows, "gid long, node long, tag int, members long, size long, spare long, n long")
    spare = found.groupBy("node", "tag").agg({"spare": "max"}).withColumnRenamed("max(spare)", "spare")
    kept = {}
    for r in part_enum.smaller(found.drop("spare").join(spare, ["node", "tag"])).collect():
        kept.setdefault((r.tag, r.node), []).append(r)
    for tag, both in shared.items():
        if both:
            one, two = kept[tag, 0], kept[tag, 1]
            same = {r.gid for r in one} & {r.gid for r in two}
            assert same and len(same) >= max(one[0].spare, two[0].spare) - max(one[0].left, two[0].left)


def test_last_round_pairs_only_sets_that_bitmaps_allow(spark, monkeypatch):
    # Texts sharing a long passage meet in large groups without being similar; the last round must not pair them all.
    passage = prose(1234, 40, 5000)
    texts = [prose(7000 + n, 30, 5000) + " " + passage for n in range(60)] + [passage, passage + " end"]
    handed, kept = [], []
    real = part_enum.possible

    def counted(pairs, maps, percent):
        out = real(pairs, maps, percent)
        handed.append(pairs.count())
        kept.append(out.count())
        return out
    monkeypatch.setattr(part_enum, "possible", counted)
    df = corpus(spark, texts)
    assert result(df, rounds=0) == expected(list(zip(range(len(texts)), texts, strict=True)))
    assert handed == kept
