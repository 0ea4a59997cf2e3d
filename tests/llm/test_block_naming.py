import hashlib
from collections import defaultdict

from skyledger.llm import block_naming
from tests.llm.conftest import corpus


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(-(1 << 63) if i is None else i)
    out = set()
    for t, ids in groups.items():
        for i in set(ids):
            out.add((None if i == -(1 << 63) else i, None if max(ids) == -(1 << 63) else max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()))
    return out


def test_against_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for size, step in ((3, 1 << 30), (64, 500), (4096, 8 << 20)):
        got = {tuple(r) for r in block_naming.exact_duplicates(docs, block_bytes=size, bucket_bytes=step, salts=2).collect()}
        assert got == expected(rows)


def test_hot_group_repeated_rows_null_ids_and_other_names(spark):
    texts = ["hot text"] * 300 + ["a", "b", "a", None, ""] + ["again", "again", "x", "y"]
    ids = [*range(300), 300, 301, 302, 303, 304, 400, 400, 401, None]
    df = corpus(spark, texts, ids).withColumnsRenamed({"text": "body", "doc_id": "key"}).selectExpr(
        "key", "body", "1 AS name", "2 AS bucket", "'x' AS text")
    got = [tuple(r) for r in block_naming.exact_duplicates(df, "key", "body", block_bytes=2, salts=4).collect()]
    assert set(got) == expected(list(zip(ids, texts, strict=True))) and len(got) == len(set(zip(ids, texts, strict=True)))


def test_empty(spark):
    df = block_naming.exact_duplicates(corpus(spark, []))
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and df.count() == 0
