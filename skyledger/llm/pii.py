"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is a column expression. Spark's functions return what a pattern matched but not where, so a position is the running
length of the pieces between the matches (``split``) and of the matches before (``regexp_extract_all``).

A pattern with a repeated group recurses in the regular-expression engine and fails on long runs. The inner separators of
numbers and host names are therefore first replaced, one character for one, by a private mark wherever they stand between two
members; the patterns then need character classes only. Marks already in the text are blanked out before.

An account number is as long as its country code says, whatever word follows it. Its pattern looks ahead only, so a proposal that
the checksum rejects does not hide one that begins inside it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT_MARK, DOT_MARK, BLANK = "\ue000", "\ue001", "\ufffd"


@dataclass(frozen=True)
class Kind:
    """One kind of personal data: ``pattern`` on the ``view`` of the text, texts without ``needs`` are skipped."""
    name: str
    pattern: str
    view: str
    needs: str
    valid: object
    base: bool
    confidence: float
    context: tuple[str, ...] = field(default=())
    context_only: bool = False
    ahead: bool = False  # the pattern is without width, its first group holds the value


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = F.split(F.reverse(_digits(value)), "")
    weighed = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number passes the mod-97 check: first four characters last, letters as 10 to 35."""
    plain = F.regexp_replace(value, "[ -]", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    number = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(number, F.lit(0), lambda a, n: (a * F.when(n > 9, 100).otherwise(10) + n) % 97) == 1


def _digit_count(low: int, high: int):
    return lambda value: F.length(_digits(value)).between(low, high)


# Characters of an account number by country code.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}


def iban_pattern() -> str:
    """Places where an account number may begin: of the length of its country, or the longest for a code without one."""
    codes = lambda listed: listed.replace(" ", "|")
    known = [f"(?:{codes(listed)})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
             for n, listed in IBAN_LENGTHS.items()]
    other = f"(?!{codes(' '.join(IBAN_LENGTHS.values()))})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return f"(?<![A-Z0-9])(?=((?:{'|'.join([*known, other])})(?![A-Z0-9])))"


# The base kinds, their order in a listing, patterns and limits.
KINDS = [
    Kind("email", "(?:(?<![A-Za-z0-9._%+\ue001-])|\\G)[A-Za-z0-9._%+\ue001-]+@[A-Za-z0-9-]+\ue001[A-Za-z0-9\ue001-]+", "dots", "@",
         lambda v: F.lit(True), True, 0.9, ("mail", "contact", "write")),
    Kind("ip", "(?<![0-9])[0-9]+[0-9]+[0-9]+[0-9]+", "dots", ".",
         lambda v: v.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:[.]0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"),
         True, 0.6, ("ip", "address", "host", "server")),
    Kind("card", "[0-9][0-9]{10,}[0-9]", "digits", "", lambda v: _digit_count(12, 19)(v) & luhn(v), True, 0.7,
         ("card", "visa", "credit", "payment")),
    Kind("phone", "\\+[0-9][\\x20().0-9-]+[0-9]", "text", "+", _digit_count(9, 15), True, 0.7, ("phone", "tel", "call", "mobile")),
    Kind("iban", iban_pattern(), "text", "",
         lambda v: F.length(F.regexp_replace(v, " ", "")).between(15, 34) & mod97(v), False, 0.8, ("iban", "account", "bank"), ahead=True),
    Kind("ssn", "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "text", "-",
         lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"), False, 0.4, ("ssn", "social", "security"), True),
]
REACH, RAISE, THRESHOLD = 40, 0.3, 0.5


def _view(text: Column, view: str) -> Column:
    if view == "digits":
        return F.regexp_replace(F.translate(text, DIGIT_MARK, BLANK), "(?<=[0-9])[\\x20-](?=[0-9])", DIGIT_MARK)
    if view == "dots":
        return F.regexp_replace(F.translate(text, DOT_MARK, BLANK), "(?<=[A-Za-z0-9-])\\.(?=[A-Za-z0-9-])", DOT_MARK)
    return text


def _worth(text: Column, kind: Kind) -> Column:
    """Whether the pattern can match at all; a cheap test that spares most texts the two pattern runs."""
    if kind.name == "card":
        return F.col("_cardlike")
    if kind.name == "ip":
        return text.rlike("[0-9]\\.[0-9]+\\.[0-9]+\\.[0-9]")
    if kind.name == "iban":
        return text.rlike("[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}")
    return text.contains(kind.needs)


def _proposed(kind: Kind, number: int) -> Column:
    """All matches as ``(start, kind, stop, value)``; confirmed ones only."""
    shown = _view(F.col("text"), kind.view)
    # A match without width at the very beginning does not split, so a blank goes before it.
    between = F.split(F.concat(F.lit(" "), shown) if kind.ahead else shown, kind.pattern, -1)
    found = F.regexp_extract_all(shown, F.lit(kind.pattern), int(kind.ahead))
    passed = lambda s: F.lit(0) if kind.ahead else F.length(s["value"])
    steps = F.arrays_zip(F.transform(between, lambda x: F.length(x)).alias("gap"), found.alias("value"))
    start = F.struct(F.lit(-int(kind.ahead)).alias("at"),
                     F.array().cast("array<struct<start:int,kind:int,stop:int,value:string>>").alias("spans"))
    walked = F.aggregate(
        steps, start,
        lambda a, s: F.when(s["value"].isNull(), a).otherwise(F.struct(
            (a["at"] + s["gap"] + passed(s)).alias("at"),
            F.concat(a["spans"], F.array(F.struct(
                (a["at"] + s["gap"]).alias("start"), F.lit(number).alias("kind"),
                (a["at"] + s["gap"] + F.length(s["value"])).alias("stop"),
                F.translate(s["value"], DIGIT_MARK + DOT_MARK, " .").alias("value")))).alias("spans"))))
    return F.when(_worth(F.col("text"), kind), F.filter(walked["spans"], lambda s: kind.valid(s["value"])))


def _scored(kind: Kind, spans: Column) -> Column:
    """Confidence of every span: that of its kind, raised when a context word stands shortly before it."""
    words = "(?i)(?<![a-z])(?:" + "|".join(kind.context) + ")"
    near = lambda s: F.substring(F.col("text"), F.greatest(s["start"] - REACH, F.lit(0)) + 1, F.least(s["start"], F.lit(REACH)))
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"),
        (F.lit(kind.confidence) + F.when(near(s).rlike(words), RAISE).otherwise(0.0)).alias("score")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """``(doc_id, text, found)``: per row all confirmed spans as ``(start, kind, stop, score)``, by start and kind.

    Positions count characters, the end is exclusive, and ``kind`` is the place in ``kinds``. Kinds marked ``context_only``
    are reported only where the score reaches ``THRESHOLD``. Rows are looked at one by one, so repeated rows repeat their
    result; null texts are empty.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("_cardlike", F.col("text").rlike("[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9]"))
    for number, kind in enumerate(kinds):
        rows = rows.withColumn(f"_{kind.name}", _proposed(kind, number))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,score:double>>")
    for kind in kinds:
        scored = _scored(kind, F.col(f"_{kind.name}"))
        if kind.context_only:
            scored = F.filter(scored, lambda s: s["score"] >= THRESHOLD)
        rows = rows.withColumn(f"_{kind.name}", F.coalesce(scored, none))
    return rows.select("doc_id", "text", F.array_sort(F.concat(*[F.col(f"_{kind.name}") for kind in kinds])).alias("found"))


def redact(found: DataFrame, kinds: list[Kind] = KINDS) -> DataFrame:
    """``(doc_id, text)`` with every span replaced by ``[KIND]``; overlapping spans become one."""
    names = F.array(*[F.lit(f"[{kind.name.upper()}]") for kind in kinds])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    cut = F.aggregate("found", start, lambda a, s: F.struct(
        F.greatest(a["at"], s["stop"]).alias("at"),
        F.when(s["start"] < a["at"], a["text"]).otherwise(F.concat(
            a["text"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"]))).alias("text")))
    return found.select("doc_id", F.concat(cut["text"], F.substring(F.col("text"), cut["at"] + 1, F.length("text"))).alias("text"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, a digest of their spans and the list of all spans, one row per row of ``docs``."""
    found = find(docs, id_col, text_col)
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    base = sum(kind.base for kind in KINDS)
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    of_kind = lambda n: F.filter("found", lambda s: s["kind"] == n)
    counts = [F.size(of_kind(n)).cast("long").alias(f"n_{kind.name}") for n, kind in enumerate(KINDS) if kind.base]
    return found.select(
        "doc_id", *counts, F.sha2(shown(F.filter("found", lambda s: s["kind"] < base)), 256).alias("base_sha256"),
        shown(F.col("found")).alias("spans"), F.transform("found", lambda s: s["score"]).alias("scores"))
