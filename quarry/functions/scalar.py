"""Scalar column helpers. Each returns a built-in Column expression (whole-stage codegen,
no Python per row)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c, dtype: str = "double") -> Column:
    """Numeric coercion where anything unparsable (``' '``, ``'abc'``) becomes null (ANSI-safe)."""
    return _col(c).try_cast(dtype)


def map_values(c, mapping: Mapping) -> Column:
    """Literal dictionary lookup; keys missing from the dictionary give null."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.try_element_at(m, _col(c))


def index_values(c, names: Sequence) -> Column:
    """P7 (positional form): ``names[c]`` for a 0-based integer code; out of range gives null."""
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), _col(c) + 1)


def parse_date(c, fmt: str = "dd-MM-yyyy", strict: bool = False) -> Column:
    """Day-first (or any pattern) date parsing; lenient by default (bad value → null)."""
    return F.to_date(_col(c), fmt) if strict else F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")


def any_of(c, items: Sequence[str]) -> Column:
    """The array column shares at least one element with a literal list."""
    return F.arrays_overlap(_col(c), F.array(*[F.lit(i) for i in items]))


def is_subset(a, b) -> Column:
    """Every element of array ``a`` occurs in array ``b``."""
    return F.size(F.array_except(_col(a), _col(b))) == 0


def not_in(item, arr) -> Column:
    """Element not contained in the array column."""
    return ~F.array_contains(_col(arr), _col(item))


def round_half_up(c, places: int = 4) -> Column:
    """Decimal rounding (half-up; Python's ``round`` is half-even)."""
    return F.round(_col(c), places)
