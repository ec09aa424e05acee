"""String expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def slice0(s: str | Column, start, end) -> Column:
    """Python-style ``s[start:end]`` with 0-based half-open bounds.

    A negative start is clamped at 0 (we never slice from the end), an end
    before the start gives ``''`` and bounds past the string clamp, exactly as
    Python slices of non-negative bounds do.
    """
    s = col_(s)
    a = F.greatest(lit_(start), F.lit(0))
    n = F.greatest(lit_(end) - a, F.lit(0))
    return _substr(s, a + 1, n)


def _substr(s: Column, pos: Column, length: Column) -> Column:
    # Column.substr accepts Column positions/lengths (F.substring wants ints).
    return s.substr(pos, length)


def tail0(s: str | Column, start) -> Column:
    """Python ``s[start:]`` (start clamped at 0)."""
    s = col_(s)
    a = F.greatest(lit_(start), F.lit(0))
    return s.substr(a + 1, F.greatest(F.length(s) - a, F.lit(0)))


def first_diff(a: str | Column, b: str | Column) -> Column:
    """0-based index of the first position where ``a`` and ``b`` differ over
    their common length, or NULL when the common part is equal (C12)."""
    a, b = col_(a), col_(b)
    n = F.least(F.length(a), F.length(b))
    diffs = F.when(
        n > 0,
        F.transform(F.sequence(F.lit(1), n), lambda i: a.substr(i, F.lit(1)) != b.substr(i, F.lit(1))),
    ).otherwise(F.array().cast("array<boolean>"))
    pos = F.array_position(diffs, True)
    return F.when(pos > 0, (pos - 1).cast("int"))


def nth_token(s: str | Column, pattern: str, n: int) -> Column:
    """``n``-th (0-based) token of ``split(s, pattern)``; NULL when missing."""
    return F.try_element_at(F.split(col_(s), pattern), F.lit(n + 1))


def compound_id(*parts: str | Column, sep: str = "|") -> Column:
    """Join parts with ``sep``; NULL when any part is NULL, like string
    concatenation of pandas objects (P9) — hence ``concat`` not ``concat_ws``."""
    items = []
    for i, p in enumerate(parts):
        if i:
            items.append(F.lit(sep))
        items.append(col_(p).cast("string"))
    return F.concat(*items)


def cds_slice(seq: str | Column, first: str | Column, last: str | Column) -> Column:
    """Coding slice of an mRNA by a 1-based inclusive range."""
    f, l = col_(first), col_(last)
    return slice0(seq, f - 1, l)
