"""Layouts that let a scan skip what a filter on any search field cannot need.

Sorting by one field serves that field alone. In Z-order the bits of all fields' ranks take turns in one key, so rows that lie
together are alike in every field: each row group spans a part of every field's values, and its minimum and maximum prune it for a
filter on any of them. Fields count by rank, not by value, so that texts, dates and uneven numbers all part their rows evenly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 4_000  # rows that come to the driver to find rank bounds; only the layout depends on them, no result does
BITS = 5


def rank_bounds(df: DataFrame, fields: tuple[str, ...], bits: int = BITS, sample: int = SAMPLE) -> dict[str, list]:
    """Ascending values that part the rows of every field into at most ``2 ** bits`` parts of about equal size.

    They are read off the ``sample`` rows of smallest hash: the same on every run, and a value that many rows have is drawn as often.
    A value that fills several parts is one bound.
    """
    drawn = df.select(*fields).orderBy(F.xxhash64(*df.columns)).limit(sample).collect()
    bounds = {}
    for name in fields:
        values = sorted(row[name] for row in drawn if row[name] is not None)
        cuts = (len(values) * part >> bits for part in range(1, 1 << bits))
        bounds[name] = sorted({values[cut] for cut in cuts if values[cut] != values[0]}) if values else []
    return bounds


def rank(value: Column, bounds: list) -> Column:
    """How many bounds a value reaches; a missing value reaches none."""
    if not bounds:
        return F.lit(0)
    reached = F.size(F.filter(F.array(*[F.lit(bound) for bound in bounds]), lambda bound: bound <= value))
    return F.when(value.isNotNull(), reached).otherwise(0)


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """The bits of all ranks in turn, the highest of each first."""
    if len(ranks) * bits > 62:
        raise ValueError(f"{len(ranks)} fields of {bits} bits do not fit a long")
    taken = [F.shiftleft(F.shiftright(value, bit).bitwiseAND(1).cast("long"), bit * len(ranks) + place)
             for bit in range(bits) for place, value in enumerate(ranks)]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


def z_key(fields: tuple[str, ...], bounds: dict[str, list], bits: int = BITS) -> Column:
    """The Z-order key of a row. Ranks stand below the top of their bits where a field has few bounds, so they are raised to it."""
    raised = []
    for name in fields:
        used = len(bounds[name]).bit_length()
        raised.append(F.shiftleft(rank(F.col(name), bounds[name]), bits - used) if used else F.lit(0))
    return interleaved(raised, bits)


def write_z_ordered(df: DataFrame, path: str, fields: tuple[str, ...], files: int, bits: int = BITS, row_group_bytes: int | None = None) -> None:
    """Write ``df`` to ``files`` files by ranges of the Z-order key of ``fields``, sorted by it inside.

    A hash of the row follows the key in the ranges, so that rows with equal fields do not all end up in one file.
    """
    keyed = df.withColumn("_z", z_key(fields, rank_bounds(df, fields, bits), bits))
    ranged = keyed.repartitionByRange(files, "_z", F.xxhash64(*df.columns)).sortWithinPartitions("_z").drop("_z")
    writer = ranged.write.mode("overwrite")
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
