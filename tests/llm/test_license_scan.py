import re

from skyledger.llm import license_scan as scan
from tests.llm.conftest import corpus

PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def base(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def test_base_against_brute_force(spark, docs, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    texts = [r.text for r in docs.collect()] + [r.text for r in table.collect()] + [
        "MIT License MIT\nLICENSE", "mit-license apache, license", "general public license general public", "MİT License İmit license", "mit license " * 4000]
    rows = scan.report(corpus(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id]), texts[r.doc_id][:100]
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_texts_by_merged_diagonals(spark):
    mit = scan.TEXTS[0].text
    changed = mit.replace("to any person", "to any and every single person").replace("a copy", "one copy")
    half = " ".join(mit.split()[:8])
    rows = {r.doc_id: r for r in scan.report(corpus(spark, ["intro words " + changed, half, "x " * 50 + scan.TEXTS[3].text, "plain words"])).collect()}
    assert rows[0].labels == "mit" and 0.7 <= rows[0].score < 1 and rows[0].n_base == 0
    assert rows[1].labels == "" and rows[2].labels == "bsd" and rows[2].score == 1.0 and rows[3].score == 0.0


def test_notice_alone_and_behind_year_and_name(spark):
    texts = ["All rights reserved.", "Copyright 2020 Acme. All rights reserved.", "Copyright. All rights reserved", "all rights are reserved, rights reserved"]
    rows = {r.doc_id: r for r in scan.report(corpus(spark, texts)).collect()}
    assert all((rows[i].labels, rows[i].score, rows[i].n_base, rows[i].base_labels) == ("proprietary", 1.0, 0, "") for i in range(3))
    assert rows[3].labels == "" and rows[3].score == 0.0


def test_strays_do_not_break_a_span(spark):
    apache = scan.TEXTS[1].text.replace("may not use", "may not ever use")
    pairs = len(scan.words_of(scan.TEXTS[1].text)) - 1
    texts = [apache, "plain words", "this software " * 40, "the license " * 40]
    rows = {r.doc_id: r for r in scan.report(corpus(spark, texts)).collect()}
    assert rows[0].labels == "apache" and abs(rows[0].score - (pairs - 1) / pairs) < 1e-9
    assert rows[2].labels == "" and rows[2].score == 0.0  # one pair, however often, covers no more of a template
    assert rows[3].labels == "" and rows[3].score == 0.0


def test_chain_reaches_past_strays_and_counts_pairs_once():
    rows = [("a", 0, 0, 8, range(8)), ("a", 12, 5, 5, [3]), ("a", 1, 10, 20, range(9, 18)), ("a", 2, 60, 70, range(10)),
            ("b", 0, 0, 3, [0, 1]), ("b", 5, 1, 3, [7]), ("b", 3, 4, 6, [1, 2]), ("b", 3, 90, 91, [2])]
    assert sorted(scan.chained(rows, 4, 12)) == [("a", 0, 17), ("a", 5, 1), ("a", 60, 10), ("b", 0, 4), ("b", 90, 1)]
    assert list(scan.chained([], 4, 12)) == []


def test_repeated_null_ids_and_empty(spark):
    df = corpus(spark, ["mit license", "mit license", "apache license", None], [7, 7, 7, None]).selectExpr("*", "1 AS words", "2 AS pos")
    got = sorted((r.doc_id or -1, r.labels, r.n_words) for r in scan.report(df).collect())
    assert got == [(-1, "", 0), (7, "apache", 2), (7, "mit", 2)]
    assert scan.report(corpus(spark, [])).count() == 0
