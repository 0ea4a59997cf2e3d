import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n, words=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Plain, empty, null, very long, repeated and near-repeated texts, and odd white space."""
    base = [prose(i, 40 + 7 * i) for i in range(12)]
    near = [base[5].replace("w7 ", "x7 ", 2), base[5] + " tail words here", "lead in " + base[9]]
    odd = ["", None, "one", "two words", "MIT License", "a b　c d\x0be\x0cf", "éè \U0001f600 中文 ok", "\n\n  \t",
           "same same same same same same same same", base[3], base[3], " ".join(base), prose(99, 9000, 900)]
    return corpus(spark, base + near + odd)
