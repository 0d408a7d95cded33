"""Text expressions: all native, so they stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{M}\p{N}]+"
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"


class Rules(NamedTuple):
    """Patterns of a word and of a token (a word or a single symbol); together the tokens cover all but white space."""

    word: str
    token: str


PLAIN = Rules(WORD, TOKEN)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def non_blank(text: Column) -> Column:
    """True for text with at least one character that is not Unicode white space."""
    return F.coalesce(F.regexp_like(text, F.lit(r"(?U)\S")), F.lit(False))


def collapse(text: Column) -> Column:
    """Lower case with every run of white space as one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def words(text: Column, rules: Rules = PLAIN) -> Column:
    """Lower-case words, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(rules.word), F.lit(0))


# To give each array element a row, the operators use ``explode_outer`` and drop the null row: for
# ``explode`` the optimizer adds a filter on the size of the array, which computes the array again.


def surface_tokens(text: Column, rules: Rules = PLAIN) -> Column:
    """Words and single symbols, in order, case kept."""
    return F.regexp_extract_all(text, F.lit(rules.token), F.lit(0))


def ngrams(items: Column, n: int, sep: str = " ") -> Column:
    """Consecutive ``n``-item phrases of an array; empty if it is shorter than ``n``."""
    def build(bound: Column) -> Column:
        count = F.size(bound) - n + 1
        return F.when(
            count >= 1,
            F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
                        lambda i: F.concat_ws(sep, *[F.get(bound, i + (k - 1)) for k in range(n)])),
        ).otherwise(F.array().cast("array<string>"))

    return let(items, build)


def hash32(text: Column) -> Column:
    """An unsigned 32-bit value that any SQL engine with md5 can reproduce."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where ``whole`` is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def half_up(value: Column, places: int = 6) -> Column:
    return F.round(value.cast("double"), places)
