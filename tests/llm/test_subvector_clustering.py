import hashlib
import math
import random

import numpy as np
import pytest

from skyledger.llm import queries
from skyledger.llm import subvector_clustering as sc
from tests.compare import connect, difference

SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(rows, k, rounds, dims, scale, seed="1"):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda: [min((far(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        found = nearest()
        for n in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, found, strict=True) if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = nearest()
    inertia = [sum(d for d, c in found if c == n) for n in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, found, strict=True))


def shown(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def vectors(n, dims, seed, spread=1.0):
    rng = random.Random(seed)
    return [[round(rng.gauss(0, spread), 3) for _ in range(dims)] for _ in range(n)]


@pytest.mark.parametrize(("width", "chunk"), [(1, 7), (2, 64), (4, 1000)])
def test_against_brute_force(spark, width, chunk):
    rows = list(enumerate(vectors(150, 8, width)))
    hot = [1.0, -0.25, 0.0, 0.5, 0.5, -1.0, 0.125, 2.0]
    rows += [(1000 + i, hot) for i in range(80)] + [(3, hot), (3, hot), (None, hot), (None, rows[0][1])]
    bad = [(2000, None), (2001, []), (2002, hot[:7]), (2003, [*hot, 1.0]), (2004, [*hot[:7], None]), (2005, [*hot[:7], float("nan")]),
           (2006, [*hot[:7], float("-inf")])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], SCHEMA).repartition(3)
    got = shown(sc.cluster(df, k=5, rounds=3, dims=8, width=width, chunk=chunk))
    assert got == expected(rows, 5, 3, 8, 64)


def test_few_vectors_ties_and_empty(spark):
    same = [(i, [0.5, 0.5], 1) for i in range(4)]
    df = spark.createDataFrame(same, SCHEMA)
    got = shown(sc.cluster(df, k=16, rounds=2, dims=2, width=1))
    assert got == expected([r[:2] for r in same], 16, 2, 2, 64) and {r[1] for r in got} == {0}
    none = sc.cluster(df.where("vec_id < 0"), dims=2)
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and none.count() == 0
    with pytest.raises(ValueError, match="divide"):
        sc.cluster(df, dims=3, width=2)


def test_other_names_and_floats(spark):
    rows = list(enumerate(vectors(40, 4, 5)))
    df = spark.createDataFrame(rows, "key long, v array<float>").selectExpr("key AS cluster", "v AS distance", "'x' AS vec_id", "1 AS codes")
    floats = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    got = shown(sc.cluster(df, k=3, rounds=1, dims=4, scale=10, id_col="cluster", vector_col="distance"))
    assert got == expected(floats, 3, 1, 4, 10)


def test_encoding_loses_nothing_and_distances_are_exact():
    values = np.random.default_rng(1).integers(-9, 9, (500, 12)).astype(np.int32)
    values[100:200] = values[0]
    values[0, 0] = sc.LIMIT
    centroids = values[[3, 7, 7]].astype(np.int64)
    for width in (1, 3, 12):
        chunk = sc.dictionary_encoded(values, width)
        assert (chunk.restored() == values).all() and len(chunk.subvectors) == chunk.starts[-1]
        for low, high in zip(chunk.starts, chunk.starts[1:], strict=False):
            assert len({tuple(r) for r in chunk.subvectors[low:high].tolist()}) == high - low
        table = sc.distances(chunk, centroids)
        wide = values.astype(np.int64)
        assert (table == ((wide[:, None] - centroids[None]) ** 2).sum(axis=2)).all()
        cluster = table.argmin(axis=1)
        assert (sc.cluster_sums(chunk, cluster, 3) == np.stack([wide[cluster == c].sum(axis=0) for c in range(3)])).all()


def test_distinct_subvectors_are_measured_once(spark):
    """A chunk of repeated vectors keeps one subvector per block."""
    df = spark.createDataFrame([(i, [0.5, 1.5, 2.5, 3.5], 0) for i in range(300)], SCHEMA).coalesce(1)
    rows = sc.encoded(df, 2, "1", 4, 64, 2, 1000, "vec_id", "embedding").collect()
    assert len(rows) == 1 and len(rows[0].subvectors) == 2 * 2 * 4


def test_same_as_sql(spark, small):
    sql = queries.ORACLES["op11_subvector_clustering"]
    assert difference(queries.op11_subvector_clustering(spark, small), connect(small), sql) is None
