import hashlib
import re

from skyledger.llm import positional_index as index
from skyledger.llm.common import documents
from tests.llm.conftest import corpus, prose


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(text, items, size):
    words, hit, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        for i in range(max(1, len(w) - size + 1)) if w else []:
            win = w[i:i + size]
            for j in range(len(words) - len(win) + 1):
                if words[j:j + len(win)] == win:
                    hit.update(range(j, j + len(win)))
                    found.add(item)
    digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
    return (len(words), len(hit), len(found), digest, bool(hit))


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark, docs):
    passage = prose(5, 75)
    items = [(1, passage), (2, "w1 w2"), (10, "One"), (11, "one"), (3, None), (4, "  "), (5, "nowhere " + prose(1, 30)), (6, prose(2, 12).upper())]
    texts = [r.text for r in docs.collect()] + ["One! " + passage + " " + passage, "w1 w2 w1 w2 w2 w1, w2"]
    rows = index.decontaminate(corpus(spark, texts), items_of(spark, items)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == expected(texts[r.doc_id], items, 10), texts[r.doc_id]


def test_proximity(spark):
    docs = documents(corpus(spark, ["a z b y c", "c x x x b x x x x x x x a", "a b"]))
    tests = index.rarest_terms(docs, index.windows(items_of(spark, [(1, "b c a")]), 3))
    found = index.proximity_matches(index.index(docs, tests, 5), tests).collect()
    assert {r.doc_id for r in found} == {0}
    assert index.phrase_matches(index.index(docs, tests, 5), tests).count() == 0


def test_repeated_null_and_empty(spark):
    df = corpus(spark, ["a b c", "a b c", "c", None], [7, 7, 7, None]).selectExpr("*", "1 AS term", "2 AS pos")
    got = sorted(((r.doc_id or -1, r.n_words, r.n_hit) for r in index.decontaminate(df, items_of(spark, [(1, "b c")])).collect()))
    assert got == [(-1, 0, 0), (7, 1, 0), (7, 3, 2)]
    assert index.decontaminate(corpus(spark, []), items_of(spark, [(1, "b c")])).count() == 0
    none = index.decontaminate(df, items_of(spark, [])).collect()
    assert len(none) == 3 and not any(r.contaminated for r in none)
