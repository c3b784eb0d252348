"""Column masking rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def salted_hash(value: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def pseudonym(value: Column, salt: str, prefix: str = "P") -> Column:
    """A stable stand-in id: equal inputs stay joinable, the input cannot be read back."""
    return F.concat(F.lit(prefix), salted_hash(value, salt))


def keep_tail(value: Column, visible: int = 4, filler: str = "*") -> Column:
    """Hide all but the last characters; short values are hidden whole."""
    text = value.cast("string")
    size = F.length(text)
    hidden = F.when(size > visible, size - visible).otherwise(size)
    return F.concat(F.repeat(F.lit(filler), hidden), F.substr(text, hidden + 1))
