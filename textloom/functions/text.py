"""Column expressions for Unicode text. No UDFs: all of them stay inside the JVM.

White space is what a Unicode-aware ``strip`` removes: the White_Space property and the separators U+001C-U+001F.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\s\x1C-\x1F"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^[{SPACE}]+|[{SPACE}]+$", "")


def words(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.regexp_extract_all(text, F.lit(f"(?U)[^{SPACE}]+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"(?U)[^{SPACE}]")


def count_in(text: Column, chars: str) -> Column:
    """How many code points of ``text`` belong to the regex class body ``chars``."""
    return F.length(F.regexp_replace(text, f"(?U)[^{chars}]+", ""))


def share_in(text: Column, chars: str) -> Column:
    return count_in(text, chars).cast("double") / F.greatest(F.length(text), F.lit(1))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used; never null for a null value."""
    return F.element_at(F.transform(F.array(value), use), 1)


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def ngrams(tokens: Column, n: int, separator: str = " ") -> Column:
    """All runs of ``n`` tokens, joined; empty when there are fewer."""
    count = F.size(tokens) - n + 1
    runs = F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), separator))
    return F.when(count >= 1, runs).otherwise(F.array().cast("array<string>"))


def distinct_share_lost(values: Column) -> Column:
    """Share of an array's elements that repeat another one: (size - distinct) / size; null for an empty array."""
    return (F.size(values) - F.size(F.array_distinct(values))).cast("double") / F.nullif(F.size(values), F.lit(0))


def sentences(text: Column) -> Column:
    """Stripped non-blank pieces between runs of ``.``, ``!`` and ``?``."""
    return F.filter(F.transform(F.split(text, "[.!?]+", -1), strip), lambda s: s != "")


def term_tokens(text: Column) -> Column:
    """Lower-case ASCII words of a term tokenizer: letters with inner hyphens or apostrophes, or one letter."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b[a-z][a-z\-']*[a-z]\b|\b[a-z]\b"), F.lit(0))


def hash_rank(*parts: Column | str) -> Column:
    """A reproducible pseudo-random order key: the md5 of the parts joined by ``|``."""
    return F.md5(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts]).cast("binary"))


def hash_pick(n: int, *parts: Column | str) -> Column:
    """A reproducible pseudo-random index from 0 to n - 1."""
    return (F.conv(F.substring(hash_rank(*parts), 1, 8), 16, 10).cast("long") % n).cast("int")
