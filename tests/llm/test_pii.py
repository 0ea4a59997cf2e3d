import hashlib
import re

from skyledger.llm import pii
from tests.llm.conftest import corpus

ORDER = ["email", "ip", "card", "phone"]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    digits = lambda s: len(re.sub("[^0-9]", "", s))
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= digits(m[0]) <= 19 and luhn(m[0]):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= digits(m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def shown(spans):
    return ",".join(f"{ORDER[k]}:{a}:{b}" for a, k, b in spans)


HARD = [
    "write to a.b@c.d.e, x_y@z.org@q.com a@b.cd_x@e.fg.hi ..a@b..c@d.e.", "1.2.3.4.5 300.1.1.1 001.02.255.256 9.9.9.9",
    "card 4111 1111 1111 1111, 4111-1111-1111-1111 4111  1111 1111 1111 411111111111111111111111", "+1 (301) 555-034 +12 345-678-9012) + 1 22",
    "é@x.yz \U0001f600 4012888888881881 +44 20 7946 0958", "mark  41111111 1111 1111 a@bc.d", "5" * 30000, "1-" * 20000,
    "a@" + "b." * 20000 + "c", "x" * 200000 + "@y.z", "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000.", "ssn 123-45-6789 or 123-45-6780",
    None, "", "4111 1111 1111 1111 4111 1111 1111 1111", "+1 2 3 4 5 6 7 8 9 +1.2.3.4", "-@-.- a@b.-",
]


def test_base_kinds_against_brute_force(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    texts = HARD + [r.text for r in table.collect()]
    rows = {r.doc_id: r for r in pii.report(corpus(spark, texts)).collect()}
    for i, text in enumerate(texts):
        want = base(text or "")
        assert rows[i].base_sha256 == hashlib.sha256(shown(want).encode()).hexdigest(), (i, text and text[:80], rows[i].spans[:200], shown(want)[:200])
        assert [rows[i].n_email, rows[i].n_ip, rows[i].n_card, rows[i].n_phone] == [sum(k == n for _, k, _ in want) for n in range(4)]
        assert set(filter(None, shown(want).split(","))) <= set(rows[i].spans.split(","))


def test_added_kinds_scores_and_redaction(spark):
    df = corpus(spark, ["my IBAN GB82 WEST 1234 5698 7654 32", "IBAN GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789", "part 123-45-6789", "mail a@b.cd"])
    got = {r.doc_id: (r.spans, r.scores) for r in pii.report(df).collect()}
    assert got[0][0] == "iban:8:35" and got[0][1][0] > 1.0 and got[1][0] == "" and got[2][0] == "ssn:4:15" and got[3][0] == ""
    assert got[4][1] == [1.2]
    text = {r.doc_id: r.text for r in pii.redact(pii.find(df)).collect()}
    assert text[0] == "my IBAN [IBAN]" and text[4] == "mail [EMAIL]" and text[3] == "part 123-45-6789"


def test_account_numbers_end_where_their_country_says(spark):
    texts = {
        "BE68 5390 0754 7034 EUR 250": ["BE68 5390 0754 7034"], "ES9121000418450200051332 2024": ["ES9121000418450200051332"],
        "to AT61 1904 3002 3457 3201 BIC1, PL61 1090 1014 0000 0712 1981 2874 A": ["AT61 1904 3002 3457 3201", "PL61 1090 1014 0000 0712 1981 2874"],
        "BE68 5390 0754 7034 DE89 3704 0044 0532 0130 00 NO93 8601 1117 947": ["BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"],
        "BE12 BE68 5390 0754 7034": ["BE68 5390 0754 7034"], "ZZ12 BE68 5390 0754 7034 X": ["BE68 5390 0754 7034"],
        "\U0001f600 é MT84 MALT 0110 0001 2345 MTLC AST0 01S US": ["MT84 MALT 0110 0001 2345 MTLC AST0 01S"],
        "BE68 5390 0754 7035 EUR": [], "BE68 5390 0754 703": [], "BE685390075470341": [], "xBE68539007547034 ABE68539007547034": ["BE68539007547034"],
    }
    rows = {r.doc_id: r.spans for r in pii.report(corpus(spark, list(texts))).collect()}
    for i, (text, want) in enumerate(texts.items()):
        got = [tuple(map(int, s.split(":")[1:])) for s in rows[i].split(",") if s.startswith("iban")]
        assert [text[a:b] for a, b in got] == want, text


def test_no_python_and_empty(spark):
    df = pii.report(corpus(spark, []))
    assert df.count() == 0 and "Python" not in df._jdf.queryExecution().toString()
