"""Searches and route pages for a whole table of requests at once.

A request gives some of the search fields. Which ones is its *mask*; only masks that occur matter, and there are at most two to the
power of the fields. Requests with equal fields are one *criterion*, whatever their number. A row of the searched table has one key
per mask, a hash of the mask and of its values in it, so all masks share a single equi-join and a single scan. What the hash brings
together is confirmed on the fields.

Hits are counted and ranked per criterion. Ranks are limited inside the map tasks before anything is shuffled (Spark's window group
limit), counts are combined there, so a criterion that a third of all rows meet costs each task a page of rows and a number.
Without a field all rows are hits; that criterion is ranked the same way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.operators.search import PAGE_SIZE, order_columns

_WORDS = r"[\p{L}\p{N}_]+"
# Up to this many distinct criteria are broadcast: a row's keys, one per mask, then never leave the task that reads it.
FEW_CRITERIA = 100_000


def tokens(value: Column) -> Column:
    """The distinct words of a text, lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(value.cast("string")), F.lit(_WORDS), 0))


def given(value: Column) -> Column:
    """A request's field, null where it is absent or empty."""
    return F.when(value.cast("string") != "", value.cast("string"))


def _mask(fields: tuple[str, ...]) -> Column:
    """Bit ``i`` tells that field ``i`` is given."""
    return reduce(lambda a, b: a + b, [F.when(F.col(name).isNotNull(), 1 << i).otherwise(0) for i, name in enumerate(fields)])


def _hashes(fields: tuple[str, ...], words: tuple[str, ...], value) -> dict[str, Column]:
    """One hash per plain field, null where it is missing, and an array of hashes, one per word, for a field of words."""
    made = {}
    for place, name in enumerate(fields):
        if name in words:
            made[name] = _word_hashes(place, value(name))
        else:
            made[name] = F.when(value(name).isNotNull(), F.xxhash64(F.lit(place), value(name)))
    return made


def _word_hashes(place: int, value: Column) -> Column:
    return F.transform(tokens(value), lambda word: F.xxhash64(F.lit(place), word))


def _spread(keys: Column, words: Column) -> Column:
    """Every key with every word."""
    return F.flatten(F.transform(words, lambda word: F.transform(keys, lambda key: key.bitwiseXOR(word))))


def _keys(mask: int, fields: tuple[str, ...], words: tuple[str, ...], hashed) -> Column:
    """The keys of a row for one mask, an array: one for plain fields, one for each choice of a word where fields hold words.

    A key is the exclusive or of the fields' hashes, so a field is hashed once for all masks. A missing field gives no key.
    """
    made = [name for place, name in enumerate(fields) if mask >> place & 1]
    plain = reduce(lambda a, b: a.bitwiseXOR(b), [hashed(name) for name in made if name not in words], F.xxhash64(F.lit(mask)))
    keys = F.array(plain)
    for name in made:
        if name in words:
            keys = _spread(keys, hashed(name))
    return keys


def _all_keys(masks: list[int], fields: tuple[str, ...], words: tuple[str, ...], hashed) -> Column:
    """The keys of a row for all masks; a mask with a missing field gives none."""
    if not words:
        return F.array_compact(F.array(*[F.get(_keys(mask, fields, words, hashed), F.lit(0)) for mask in masks]))
    none = F.array().cast("array<bigint>")
    return F.array_distinct(F.flatten(F.array(*[F.coalesce(_keys(mask, fields, words, hashed), none) for mask in masks])))


def matched(table: DataFrame, criteria: DataFrame, masks: list[int], fields: tuple[str, ...], words: tuple[str, ...] = (),
            few: bool = False) -> DataFrame:
    """``(criterion, *table.columns)`` for every row and criterion that meet, each pair once.

    ``criteria`` has ``criterion`` and the fields, null where they are not given. A field in ``words`` meets when it shares a word.
    Several shared words are several keys; the pair is kept for the one of smallest hash. ``few`` criteria are sent to every task,
    so a row's keys for all masks meet them where the row is read and are never shuffled. A value that none of the few gives counts
    as missing there: a row then has keys for those masks only in which each of its values is asked for by some criterion.
    """
    of_row, row_hash = (lambda name: F.col(name).cast("string")), (lambda name: F.col(f"_row_{name}"))
    of_request, request_hash = (lambda name: F.col(f"_want_{name}")), (lambda name: F.col(f"_asked_{name}"))
    hashes, rows = _hashes(fields, words, of_row), table
    if few:
        for name in [name for place, name in enumerate(fields) if name not in words and any(mask >> place & 1 for mask in masks)]:
            asked_values = criteria.where(F.col(name).isNotNull()).select(F.col(name).alias(f"_any_{name}")).distinct()
            rows = rows.join(F.broadcast(asked_values), of_row(name) == F.col(f"_any_{name}"), "left")
            hashes[name] = F.when(F.col(f"_any_{name}").isNotNull(), hashes[name])
    rows = rows.withColumns({f"_row_{name}": value for name, value in hashes.items()})
    rows = rows.withColumn("_key", F.explode(_all_keys(masks, fields, words, row_hash)))

    asked = criteria.select("criterion", _mask(fields).alias("_mask"), *[F.col(name).alias(f"_want_{name}") for name in fields])
    asked = asked.withColumns({f"_asked_{name}": value for name, value in _hashes(fields, words, of_request).items()})
    by_mask = lambda keys: reduce(lambda rest, mask: F.when(F.col("_mask") == mask, keys(mask)).otherwise(rest), masks, F.lit(None))
    asked = asked.withColumn("_key", F.explode(F.array_distinct(by_mask(lambda mask: _keys(mask, fields, words, request_hash)))))

    pairs = rows.join(F.broadcast(asked) if few else asked, "_key")
    for name in fields:
        meets = F.arrays_overlap(tokens(of_row(name)), tokens(of_request(name))) if name in words else of_request(name) == of_row(name)
        pairs = pairs.where(of_request(name).isNull() | meets)
    if words:
        shared = lambda name: F.array(F.array_min(F.array_intersect(row_hash(name), request_hash(name)))) if name in words else request_hash(name)
        pairs = pairs.where(F.col("_key") == by_mask(lambda mask: F.get(_keys(mask, fields, words, shared), F.lit(0))))
    return pairs.select("criterion", *table.columns)


def search_many(table: DataFrame, requests: DataFrame, fields: tuple[str, ...], order: tuple[str, ...], ties: tuple[str, ...],
                words: tuple[str, ...] = (), id_col: str = "request", start_col: str = "start", size: int = PAGE_SIZE,
                count_name: str = "hit_count") -> DataFrame:
    """One page of hits for every request: ``(request, start, hit_count, position, *table.columns)``.

    ``requests`` has an id, the number of hits to skip and the fields; a missing column is a field that nobody gives, a missing
    start is 0. ``position`` counts from 1 over all hits of the request. A request whose page is empty has one row without a
    position. ``ties`` must tell rows apart.

    Ranks reach as far as the deepest page asked for. Depths beyond ``spark.sql.optimizer.windowGroupLimitThreshold`` are right but
    ranked without the early limit: deep pages belong to ``operators.directory``.
    """
    absent = F.lit(None).cast("string")
    start = F.coalesce(F.col(start_col).cast("int"), F.lit(0)) if start_col in requests.columns else F.lit(0)
    asked = requests.select(F.col(id_col).alias("_request"), F.greatest(start, F.lit(0)).alias("_start"),
                            *[(given(F.col(name)) if name in requests.columns else absent).alias(name) for name in fields])
    # The text of the given fields names a criterion exactly; null fields are left out of it.
    asked = asked.withColumn("_mask", _mask(fields)).withColumn("criterion", F.to_json(F.struct(*fields)))
    # At most two to the power of the fields, and two numbers each.
    shape = asked.groupBy("_mask").agg(F.max("_start").alias("deepest"), F.countDistinct("criterion").alias("criteria")).collect()
    depth = max((row.deepest for row in shape), default=0) + size
    few = sum(row.criteria for row in shape) <= FEW_CRITERIA
    hits = matched(table, asked.select("criterion", *fields).distinct(), sorted(row["_mask"] for row in shape) or [0], fields, words, few)

    counts = hits.groupBy("criterion").agg(F.count(F.lit(1)).alias("_hits"))
    rank = F.row_number().over(W.partitionBy("criterion").orderBy(*order_columns(table, order, ties)))
    ranked = hits.withColumn("position", rank).where(F.col("position") <= depth)
    pages = asked.select("_request", "_start", "criterion").join(counts, "criterion", "left")
    shown = pages.join(ranked.withColumnRenamed("criterion", "_criterion"), (F.col("criterion") == F.col("_criterion")) & (
        F.col("position") > F.col("_start")) & (F.col("position") <= F.col("_start") + size), "left")
    return shown.select(F.col("_request").alias(id_col), F.col("_start").alias(start_col), F.coalesce("_hits", F.lit(0)).alias(count_name),
                        "position", *[F.col(name) for name in table.columns])
