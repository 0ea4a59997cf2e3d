"""Secret scan with corpus-wide ownership frequency.

Patterns propose candidates in every text. Of a candidate's value only a hash leaves the task. Hashes are counted over the whole
corpus: in how many repositories and with how many owners each stands. What many owners hold is a widely copied example; what one
owner alone holds, and looks random, is taken for a live credential. Values without any mark of their own (long mixed tokens) are
reported only where one owner holds them: the corpus says that they are secrets, not their shape.

Rows without candidates, nearly all, never take part in an exchange. Counts combine inside map tasks: first per value, owner and
repository, then per value and owner, then per value, so a value that a third of all rows hold is one row per task. Verdicts return
to the spans in two joins: values with at least ``1 / HOT_SHARE`` of all candidates are at most ``HOT_SHARE`` and are broadcast, the
others are each below that share of a shuffle.

Defined cases: null texts are empty; a null owner or repository is an owner or repository like any other; repeated rows repeat
their result and count once as a repository; an empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored


@dataclass(frozen=True)
class Kind:
    """Candidates of one kind: ``group`` of the match is the value, which has ``low`` to ``high`` characters.

    ``quick`` finds the same confirmed matches in less time where it is given.
    """
    name: str
    pattern: str
    base: bool = False
    group: int = 0
    low: int = 0
    high: int = 1 << 30
    mixed: bool = False  # lower and upper case letters and digits
    owned: bool = False  # reported only where one owner holds the value
    quick: str | None = None


# The base kinds, in the order of a listing.
BASE = [
    Kind("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6,
         quick=r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+))"""),
    Kind("access", "AKIA[A-Z0-9]+", True, 0, 20),
    Kind("hex", "[0-9a-f]+", True, 0, 24, quick="(?<![0-9a-f])[0-9a-f]{24,}"),
]
# Public formats of credentials, and tokens without a format.
ADDED = [
    Kind("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Kind("slack", "xox[abpr]-[A-Za-z0-9-]{10,}"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Kind("google", "AIza[A-Za-z0-9_-]{35}"),
    Kind("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Kind("url", r"://[^\x00-\x20/:@]{1,100}:([^\x00-\x20/:@]{3,100})@", group=1),
    Kind("token", "[A-Za-z0-9+/_-]{32,}", high=200, mixed=True, owned=True, quick="(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}"),
]
KINDS = [*BASE, *ADDED]
# Fixed value: values written to be replaced.
PLACEHOLDER = "[eE][xX][aA][mM][pP][lL][eE]|[cC][hH][aA][nN][gG][eE][mM][eE]|[pP][lL][aA][cC][eE][hH][oO][lL][dD][eE][rR]|[yY][oO][uU][rR]_|[xX]{4}"

HOT_SHARE = 1000
LOOKS = ("placeholder", "plain", "random")
# Verdicts by how alarming they are, with the score of a span.
SCORES = {"example": 0.1, "plain": 0.3, "shared": 0.6, "live": 0.9}
SPAN = "array<struct<start:int,kind:int,stop:int,look:int,owned:boolean,value:binary>>"


def looks(value: str) -> int:
    """Place in ``LOOKS``: written to be replaced, made by a person, or random: 16 characters, 10 different ones and a digit."""
    if re.search(PLACEHOLDER, value):
        return 0
    return 2 if len(value) >= 16 and len(set(value)) >= 10 and re.search("[0-9]", value) else 1


def candidates(text: str, kinds: list[tuple[Kind, re.Pattern]]) -> list[tuple]:
    """``(start, kind, stop, value)`` of all confirmed matches, by start and kind; positions count code points."""
    found = []
    for number, (kind, pattern) in enumerate(kinds):
        for match in pattern.finditer(text):
            value = match[kind.group]
            if not kind.low <= len(value) <= kind.high:
                continue
            if kind.mixed and not (re.search("[a-z]", value) and re.search("[A-Z]", value) and re.search("[0-9]", value)):
                continue
            found.append((match.start(), number, match.end(), value))
    return sorted(found)


def scanned(docs: DataFrame, kinds: list[Kind], id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    """``(row, doc_id, owner, repository, base_sha256, spans)`` per row of ``docs``, stored; values are hashes."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), owner.alias("owner"), repository.alias("repository"))
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("look", pa.int32()), ("owned", pa.bool_()), ("value", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(kind, re.compile(kind.quick or kind.pattern)) for kind in kinds]
        for batch in batches:
            spans, digests = [], []
            for text in batch.column("text"):
                found = candidates(text.as_py(), known) if text.is_valid else []
                listed = ",".join(f"{kinds[k].name}:{a}:{b}" for a, k, b, _ in found if kinds[k].base)
                digests.append(hashlib.sha256(listed.encode()).hexdigest())
                spans.append([(a, k, b, looks(v), kinds[k].owned, hashlib.sha256(v.encode()).digest()[:16]) for a, k, b, v in found])
            columns = [batch.column("doc_id"), batch.column("owner"), batch.column("repository"), pa.array(digests, pa.string()), pa.array(spans, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "owner", "repository", "base_sha256", "spans"])

    kind_of = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind_of}, owner string, repository string, base_sha256 string, spans {SPAN}")
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "candidates")


def ownership(spans: DataFrame) -> DataFrame:
    """``(value, n_rows, n_repositories, n_owners)`` of rows ``(value, owner, repository)``, one per distinct value."""
    per_repository = spans.groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("n_rows"))
    per_owner = per_repository.groupBy("value", "owner").agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_repositories"))
    return per_owner.groupBy("value").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_repositories").alias("n_repositories"),
                                          F.count(F.lit(1)).alias("n_owners"))


def verdict(wide_owners: int, wide_repositories: int) -> Column:
    """What a span's look and its value's holders say, as a number by ``SCORES``."""
    copied = (F.col("n_owners") >= wide_owners) | (F.col("n_repositories") >= wide_repositories)
    order = {name: F.lit(place) for place, name in enumerate(SCORES)}
    return (F.when(copied | (F.col("look") == 0), order["example"]).when(F.col("look") == 1, order["plain"])
            .when(F.col("n_owners") == 1, order["live"]).otherwise(order["shared"]))


def judged(candidates_: DataFrame, wide_owners: int, wide_repositories: int) -> DataFrame:
    """``(row, found)``: the spans ``(start, kind, stop, verdict, n_owners)`` of every row that has any, by start and kind."""
    spans = candidates_.where(F.size("spans") > 0).select("row", "owner", "repository", F.explode("spans").alias("span")).select(
        "row", "owner", "repository", "span.*")
    holders = stored(ownership(spans), "ownership")
    total = holders.agg(F.sum("n_rows")).first()[0] or 0
    hot = F.col("n_rows") * HOT_SHARE >= total
    few = F.broadcast(holders.where(hot))  # at most HOT_SHARE rows
    rest = spans.join(F.broadcast(holders.where(hot).select("value")), "value", "left_anti").join(holders.where(~hot), "value")
    known = spans.join(few, "value").unionByName(rest)
    kept = known.withColumn("verdict", verdict(wide_owners, wide_repositories)).where("NOT owned OR (n_owners = 1 AND look = 2)")
    return kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "verdict", "n_owners"))).alias("found"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None, repository: Column | None = None,
         kinds: list[Kind] = KINDS, wide_owners: int = 3, wide_repositories: int = 6) -> DataFrame:
    """``(doc_id, base_sha256, found)`` per row of ``docs``; ``found`` holds ``(start, kind, stop, verdict, n_owners)``.

    ``kind`` and ``verdict`` are places in ``kinds`` and ``SCORES``. A value with ``wide_owners`` owners or in
    ``wide_repositories`` repositories is an example. By default the owner is the column ``source``, and a repository is what an
    owner has in one ``lang``.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.col("lang") if repository is None else repository
    rows = scanned(docs, kinds, id_col, text_col, owner.cast("string"), repository.cast("string"))
    found = judged(rows, wide_owners, wide_repositories)
    none = F.array().cast(found.schema["found"].dataType)
    with_any = rows.where(F.size("spans") > 0).join(found, "row", "left").select("doc_id", "base_sha256", F.coalesce("found", none).alias("found"))
    return rows.where(F.size("spans") == 0).select("doc_id", "base_sha256", none.alias("found")).unionByName(with_any)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, the list of all spans with their verdicts, and the worst one's score."""
    names, verdicts = (F.array(*[F.lit(x) for x in listed]) for listed in ([kind.name for kind in KINDS], list(SCORES)))
    joined = lambda each: F.array_join(F.transform("found", each), ",")
    count = lambda test: F.size(F.filter("found", test)).cast("long")
    of_kind = lambda n: count(lambda s: s["kind"] == n)
    scores = F.array(*[F.lit(x) for x in SCORES.values()])
    at = list(SCORES).index
    return scan(docs, id_col, text_col, **options).select(
        "doc_id", *[of_kind(n).alias(f"n_{kind.name}") for n, kind in enumerate(KINDS) if kind.base], "base_sha256",
        joined(lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))).alias("spans"),
        joined(lambda s: F.get(verdicts, s["verdict"])).alias("verdicts"),
        count(lambda s: s["verdict"] == at("live")).alias("n_live"), count(lambda s: s["verdict"] == at("example")).alias("n_example"),
        F.coalesce(F.get(scores, F.array_max(F.transform("found", lambda s: s["verdict"]))), F.lit(0.0)).alias("score"))
