"""Column expressions that the [native] operators share: words and n-gram hashes as arrays, without Python on rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed. Pure ASCII texts, told by their byte length, take the fast function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, SMALL))


def split_words(text: Column, separators: str) -> Column:
    """The non-empty parts between runs of the separator class; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{separators}]+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def places(count: Column) -> Column:
    """0 .. count - 1; empty for a count of 0 or less."""
    return F.when(count > 0, F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)).otherwise(F.expr("cast(array() as array<int>)"))


def grams(hashes: str, n: int) -> Column:
    """64-bit hash of the n items that start at each place of an array column of hashes."""
    h = F.col(hashes)
    if n == 1:
        return F.transform(h, lambda x: F.xxhash64(x))
    return let(h, lambda a: F.transform(places(F.size(a) - (n - 1)), lambda i: F.xxhash64(*[a[i + j] if j else a[i] for j in range(n)])))


def pair_least(values: str, step: int) -> Column:
    """Smaller of each item and the one `step` further on."""
    v = F.col(values)
    count = F.greatest(F.size(v) - step, F.lit(0))
    return F.zip_with(F.slice(v, F.lit(1), count), F.slice(v, F.lit(1 + step), count), lambda a, b: F.least(a, b))
