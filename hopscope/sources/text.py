"""Readers for edge lists, adjacency lists and traversal state.

Text layouts (no header, one record per line):

* edge list       ``src,dst`` (further fields ignored)
* adjacency list  ``vertex<whitespace>n1,n2,...``
* state           ``vertex<ws>n1,n2 dist`` (one source) or
                  ``vertex"to"source<ws>n1,n2 dist`` (several sources); the
                  list is the word ``null`` for a vertex without neighbours,
                  and infinity is 2147483647.

Lines with too few fields are skipped; ``count_malformed_*`` tell how many.
Trailing separators are ignored (``a,b,`` lists ``a`` and ``b``).
All parsing is column expressions over ``spark.read.text``; every format is
also readable from csv or parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.functions.expressions import (
    KEY_SEPARATOR,
    NO_NEIGHBOURS,
    comma_tokens,
    infinity_to_null,
    whitespace_tokens,
)


# ---------------------------------------------------------------- edge lists
def parse_edge_lines(lines: DataFrame, sep: str = ",", col: str = "value") -> DataFrame:
    """``(src, dst)`` from lines ``src<sep>dst[<sep>...]``."""
    tok = F.split(F.regexp_replace(F.col(col), f"(?:{_re(sep)})+$", ""), _re(sep))
    return (
        lines.select(tok.alias("t"))
        .where(F.size("t") >= 2)
        .select(F.col("t")[0].alias("src"), F.col("t")[1].alias("dst"))
    )


def count_malformed_edge_lines(lines: DataFrame, sep: str = ",", col: str = "value") -> DataFrame:
    """One row ``malformed``: lines with fewer than two fields."""
    tok = F.split(F.regexp_replace(F.col(col), f"(?:{_re(sep)})+$", ""), _re(sep))
    return lines.agg(F.count_if(F.size(tok) < 2).alias("malformed"))


def read_edges(spark: SparkSession, path: str, fmt: str = "text", sep: str = ",") -> DataFrame:
    """Edge list from ``text`` (``src,dst`` lines), ``csv`` (first two
    columns) or ``parquet`` (columns ``src``, ``dst``)."""
    if fmt == "text":
        return parse_edge_lines(spark.read.text(path), sep=sep)
    if fmt == "csv":
        df = spark.read.csv(path, sep=sep, header=False, schema="src string, dst string")
        return df.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if fmt == "parquet":
        return spark.read.parquet(path).select(F.col("src").cast("string"), F.col("dst").cast("string"))
    raise ValueError(f"unknown edge format {fmt!r}")


# ----------------------------------------------------------- adjacency lists
def parse_adjacency_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(vertex, neighbors array<string>)`` from ``vertex<ws>n1,n2,...``."""
    return (
        lines.select(whitespace_tokens(F.col(col)).alias("t"))
        .where(F.size("t") >= 2)
        .select(F.col("t")[0].alias("vertex"), comma_tokens(F.col("t")[1]).alias("neighbors"))
    )


def count_malformed_adjacency_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row ``malformed``: lines with fewer than two fields."""
    return lines.agg(F.count_if(F.size(whitespace_tokens(F.col(col))) < 2).alias("malformed"))


def read_adjacency(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    if fmt == "text":
        return parse_adjacency_lines(spark.read.text(path))
    if fmt == "parquet":
        return spark.read.parquet(path).select(
            F.col("vertex").cast("string"), F.col("neighbors").cast("array<string>")
        )
    raise ValueError(f"unknown adjacency format {fmt!r}")


# ------------------------------------------------------------------- state
def parse_state_lines(lines: DataFrame, source: str | None = None, col: str = "value",
                      sources: list[str] | None = None) -> DataFrame:
    """``(source, vertex, neighbors, dist)`` from state lines (3+ fields).

    With ``source`` given, keys are plain vertices of that one traversal;
    otherwise keys are ``vertex"to"source``. With ``sources``, a key is cut
    before the one ``to<source>`` of these that it ends in; keys of other
    sources are left out and a key that ends in two of them is an error.
    Without, it is cut at the first separator, which is right only for ids
    that don't hold it. Infinity becomes NULL.
    """
    t = whitespace_tokens(F.col(col))
    rows = lines.select(t.alias("t")).where(F.size("t") >= 3)
    key = F.col("t")[0]
    if source is not None:
        src, vtx = F.lit(str(source)), key
    elif sources is not None:
        ends = F.filter(F.array(*[F.lit(str(s)) for s in dict.fromkeys(sources)]), lambda s: key.endswith(F.concat(F.lit(KEY_SEPARATOR), s)))
        two = F.raise_error(F.concat(F.lit("a state key ends in two of the sources: "), key))
        rows = rows.withColumn("src", F.when(F.size(ends) > 1, two).otherwise(F.get(ends, F.lit(0)))).where("src IS NOT NULL")
        src = F.col("src")
        vtx = F.substring(key, F.lit(1), F.length(key) - F.length(src) - len(KEY_SEPARATOR))
    else:
        pattern = f"^(.*?){KEY_SEPARATOR}(.*)$"
        vtx, src = F.regexp_extract(key, pattern, 1), F.regexp_extract(key, pattern, 2)
    nb = F.when(F.col("t")[1] == F.lit(NO_NEIGHBOURS), F.array().cast("array<string>")).otherwise(
        comma_tokens(F.col("t")[1])
    )
    return rows.select(
        src.alias("source"), vtx.alias("vertex"), nb.alias("neighbors"), infinity_to_null(F.col("t")[2]).alias("dist")
    )


def read_state(spark: SparkSession, path: str, fmt: str = "parquet", source: str | None = None,
               sources: list[str] | None = None) -> DataFrame:
    """Stored traversal state ``(source, vertex, dist)`` (plus ``neighbors``
    when read from text)."""
    if fmt == "parquet":
        return spark.read.parquet(path).select(
            F.col("source").cast("string"), F.col("vertex").cast("string"), F.col("dist").cast("int")
        )
    if fmt == "text":
        return parse_state_lines(spark.read.text(path), source=source, sources=sources)
    raise ValueError(f"unknown state format {fmt!r}")


def _re(sep: str) -> str:
    """Escape a literal separator for a Java regex."""
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
