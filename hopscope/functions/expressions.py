"""Column expressions shared by the readers, writers and operators.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the text formats (must stay as they are to read and write
# files in the original layout).
#   INFINITY       text form of "unreachable" in distance files: 2147483647
#   NO_NEIGHBOURS  word written as the neighbour list of a vertex without one: null
#   KEY_SEPARATOR  joins vertex and source in multi-source state keys: to
#   DEFAULT_SAMPLE_SEED  seed of the vertex sample: 0
# ---------------------------------------------------------------------------
INFINITY = 2147483647
NO_NEIGHBOURS = "null"
KEY_SEPARATOR = "to"
DEFAULT_SAMPLE_SEED = 0


def col_or_name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_trailing(c: Column | str, chars_regex: str) -> Column:
    """Drop trailing separators so split() matches a split that ignores
    trailing empty fields (``'a,b,'`` gives ``['a','b']``)."""
    return F.regexp_replace(col_or_name(c), f"(?:{chars_regex})+$", "")


def whitespace_tokens(c: Column | str) -> Column:
    """Split a line on runs of whitespace, ignoring trailing whitespace."""
    return F.split(strip_trailing(c, r"\s"), r"\s+")


def comma_tokens(c: Column | str) -> Column:
    """Split on commas, ignoring trailing commas."""
    return F.split(strip_trailing(c, ","), ",")


def sample_key(id_col: Column | str, seed: int = DEFAULT_SAMPLE_SEED) -> Column:
    """Hex md5 of ``'<seed>:<id>'``; ordering by it (then by id) draws a
    seeded uniform sample that any engine with md5 reproduces."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col_or_name(id_col).cast("string")))


def next_hop(dist: Column | str) -> Column:
    """Distance one hop further. NULL stands for infinity, and NULL + 1 stays
    NULL, so infinity never turns finite."""
    return (col_or_name(dist) + F.lit(1)).cast("int")


def finite_or_zero(dist: Column | str) -> Column:
    """Unreachable counted as 0, as in the global longest-path summary."""
    return F.coalesce(col_or_name(dist), F.lit(0)).cast("int")


def infinity_to_null(dist: Column | str) -> Column:
    """Text distance -> int, with the infinity marker read as NULL."""
    d = col_or_name(dist).try_cast("long")
    return F.when(d >= F.lit(INFINITY), F.lit(None)).otherwise(d).cast("int")


def null_to_infinity(dist: Column | str) -> Column:
    """int distance -> the integer written in text files (NULL -> infinity)."""
    return F.coalesce(col_or_name(dist), F.lit(INFINITY)).cast("int")
