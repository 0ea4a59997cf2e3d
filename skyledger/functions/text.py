"""Labels, search tokens and URL clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class messages. Four classes is the default; the three-class texts belong to the results table.
DELAY_CLASSES = {
    0: "Early (15+ Minutes Early)",
    1: "Slightly Early (0-15 Minute Early)",
    2: "Slightly Late (0-30 Minute Delay)",
    3: "Very Late (30+ Minutes Late)",
}
DELAY_CLASSES_3 = {
    0: "On Time (0-15 Minute Delay)",
    1: "Slightly Late (15-60 Minute Delay)",
    2: "Very Late (60+ Minute Delay)",
}

_WORD = r"[\p{L}\p{N}_]"


def route(origin: Column, dest: Column) -> Column:
    """``Origin-Dest``; null when either end is null."""
    return F.concat(origin, F.lit("-"), dest)


def class_label(prediction: Column, labels: dict[int, str] = DELAY_CLASSES) -> Column:
    """Class code (number or numeric text) to its message; unknown codes give null."""
    code = prediction.cast("string").try_cast("double")
    message = None
    for value, text in labels.items():
        message = (F if message is None else message).when(code == value, F.lit(text))
    return message


def shorten(label: Column, length: int = 14) -> Column:
    """Cut a long label and mark the cut with three dots."""
    return F.when(F.length(label) > length, F.concat(F.substring(label, 1, length), F.lit("..."))).otherwise(label)


def strip_paging(url: Column) -> Column:
    """Remove the last ``?start=..&end=..`` part of a URL; other URLs come back as they are."""
    base = F.regexp_extract(url, r"(?d)^(.+)\?start=.+&end=.+", 1)
    return F.when(base == "", url).otherwise(base)


def matches(field: Column, query: str) -> Column:
    """True when the field and the query share at least one word, in any case.

    One regular expression looks for the words between word boundaries; no word list is built per row.
    """
    words = re.findall(r"\w+", query.lower())
    if not words:
        return F.lit(False)
    pattern = f"(?<!{_WORD})(?:{'|'.join(words)})(?!{_WORD})"
    return F.lower(field.cast("string")).rlike(pattern)
