from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from skyledger.llm import queries
from tests.llm.conftest import corpus
from tests.llm.test_part_enum import edited, expected as components
from tests.llm.test_positional_index import expected as hits, split

import random

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_stage_against_brute_force(spark, small):
    docs = queries.table(spark, small, "documents")
    model = queries.quality_model(spark, small)
    pair = __import__("skyledger.llm.compression_quality", fromlist=["x"])
    good, bad = pair.compressors(model.good, model.bad)
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in queries.table(spark, small, "benchmark").collect()]
    windows = {tuple(split(t)[i:i + 10]) for _, t in items for i in range(max(1, len(split(t)) - 9))}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == COLUMNS and out.schema == docs.schema
        got = {r.doc_id: r.text for r in out.collect()}
        if stage is pipeline.quality:
            want = {i for i, t in rows.items() if model.score(pair.difference((t or "").encode(), good, bad)) >= 0.3}
        elif stage is pipeline.exact_dedup:
            want = set({(t or ""): i for i, t in sorted(rows.items())}.values())
        elif stage is pipeline.near_dedup:
            want = {i for i, _, c in components(list(rows.items())) if i == c}
        else:
            want = set()
            for i, t in rows.items():
                w = split(t)
                if not any(tuple(w[p:p + n]) in windows for n in {len(x) for x in windows} for p in range(len(w) - n + 1)):
                    want.add(i)
        assert set(got) == want, name
        assert all(rows[i] == t for i, t in got.items()) and 0 < len(got) <= len(rows)
        docs, rows = spark.createDataFrame(out.collect(), out.schema), got
    pieces = pipeline.pack(spark, docs, small).collect()
    assert {r.doc_id for r in pieces} == set(rows)
    assert pipeline.run(spark, small).count() == len(pieces)


def test_nulls_repeats_ties_and_names(spark, small):
    rng = random.Random(1)
    from tests.llm.conftest import prose
    root = prose(1, 100, 4000)
    texts = [root, root, edited(rng, root, 1), None, None, "", "x y", "x y", "x y", prose(2, 300, 50)]
    docs = corpus(spark, texts, [1, 2, 3, 4, None, 6, 7, 7, 8, 9]).withColumn("_id", F.lit(1)).withColumn("_SHA", F.lit(2)).withColumn("name", F.lit("n"))
    exact = pipeline.exact_dedup(spark, docs, small)
    assert exact.columns == docs.columns
    assert sorted(r.doc_id for r in exact.collect()) == [2, 3, 6, 8, 9]
    near = pipeline.near_dedup(spark, exact, small)
    assert sorted(r.doc_id for r in near.collect()) == [2, 6, 8, 9]
    assert pipeline.decontaminate(spark, near, small).count() == 4
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), small).count() == 0


def test_rows_that_share_an_id_are_judged_apart(spark, small):
    from tests.llm.conftest import prose
    item = next(r.text for r in queries.table(spark, small, "benchmark").orderBy("item_id").collect() if len(split(r.text)) >= 10)
    rng = random.Random(3)
    one, two = prose(11, 120, 4000), prose(12, 120, 4000)
    texts = ["before " + item + " after", "clean words only", one, edited(rng, one, 1), two, edited(rng, two, 1), two, "", None, "again a b", "again a b"]
    ids = [1, 1, 2, 5, 2, 2, 9, 3, None, 4, 4]
    docs = corpus(spark, texts, ids)
    clean = sorted(((r.doc_id or 0), r.text or "") for r in pipeline.decontaminate(spark, docs, small).collect())
    assert clean == sorted(((i or 0), t or "") for i, t in list(zip(ids, texts, strict=True))[1:])
    near = [(r.doc_id, r.text) for r in pipeline.near_dedup(spark, docs, small).collect()]
    assert sum(t in texts[4:7] for _, t in near) == 1 and (2, one) in near and (5, texts[3]) not in near
    assert sorted((i or 0, t or "") for i, t in near if t not in texts[4:7]) == sorted([(1, texts[0]), (1, texts[1]), (2, one), (3, ""), (0, ""), (4, "again a b")])
