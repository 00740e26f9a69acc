"""Small text and truth-value helpers shared by every column builder."""

from __future__ import annotations

import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python treats as whitespace in strip() and split().
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same as the body of a regex class.
BLANK = "".join(rf"\x{{{ord(ch):x}}}" for ch in BLANKS)


def strip(c: Column) -> Column:
    """Remove blanks of any kind from both ends."""
    return F.btrim(c, F.lit(BLANKS))


def words(c: Column) -> Column:
    """Words of a text; a blank text gives one empty word, null gives null.

    ``regexp_replace`` keeps its compiled pattern between rows and a split on a single
    character needs no pattern at all, so this beats splitting on the class itself.
    """
    return F.split(F.trim(F.regexp_replace(c, f"[{BLANK}]+", " ")), " ")


def has_text(c: Column) -> Column:
    """Neither null nor empty; never null itself."""
    return c.isNotNull() & (c != "")


def has_number(c: Column) -> Column:
    """Neither null nor zero; never null itself."""
    return c.isNotNull() & (c != 0)


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def is_one_of(c: Column, values) -> Column:
    """Membership that is false, not null, for null input."""
    return c.isNotNull() & c.isin(*values)


def div(c: Column, n: int) -> Column:
    """Whole-number division."""
    return F.call_function("div", c, F.lit(n))


@lru_cache(maxsize=1)
def digit_class() -> str:
    """Body of a regex class with every character Python's ``isdigit`` accepts.

    Decimal digits are ``\\p{Nd}``; superscripts, circled digits and the like come on top.
    """
    extra = [
        i for i in range(sys.maxunicode + 1) if chr(i).isdigit() and not chr(i).isdecimal()
    ]
    ranges: list[list[int]] = []
    for i in extra:
        if ranges and ranges[-1][1] == i - 1:
            ranges[-1][1] = i
        else:
            ranges.append([i, i])
    return r"\p{Nd}" + "".join(rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in ranges)
