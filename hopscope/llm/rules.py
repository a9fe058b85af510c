"""Quality rules as a short-circuit cascade, in Spark functions only.

A rule is a condition under which a document fails. Each rule's cost (seconds a
row) and selectivity (share of rows that fail) are measured on a sample; rules
run in order of rejections per cost, as a nested CASE, so that a document that
failed a cheap rule never reaches a dear one. The order decides the cost alone:
a document is kept if no rule fails, whatever the order.

The sample is drawn row by row, ``SAMPLE_ROWS`` of them about, wherever they
are; the verdict covers all rows. A rule's cost is the shortest of ``REPEATS``
jobs over the sample, after one that compiles it, less the shortest job that
only reads the sample. A rule may read other columns beside the text, such as
figures that are wanted of all rows anyhow; it then costs what it adds to them.

Defined results: a null text counts as empty; a text without words has zero in
every figure and fails the base rule; ties in rejections per cost keep the
order in which the rules were given; repeated rows are judged each; an empty
table gives no rows and the given order; other columns pass through.

Repeated words: the windows of three words are hashed to 64 bits and sorted
within the row. Equal hashes count as equal windows.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopscope.llm.common import WORD, stored

SAMPLE_ROWS = 1000
REPEATS = 3

SPACE = r"[\x20\x09-\x0D]"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_chars(text: Column) -> Column:
    return (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _covered(places: Column) -> Column:
    """Words in windows of three that begin at these sorted places."""
    step = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last"))
    return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), step, lambda acc: acc["n"])


def n_repeat_words(text: Column) -> Column:
    """Words in windows of three words that occur twice or more in the text."""
    w = F.transform(words(text), lambda x: F.xxhash64(x))

    def count(w: Column) -> Column:
        windows = F.zip_with(
            F.zip_with(F.slice(w, 1, F.size(w) - 2), F.slice(w, 2, F.size(w) - 2), lambda a, b: F.xxhash64(a, b)),
            F.slice(w, 3, F.size(w) - 2),
            lambda a, b: F.xxhash64(a, b),
        )
        return F.get(F.transform(F.array(windows), _repeats), F.lit(0))

    return F.get(F.transform(F.array(w), lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(count(w))), F.lit(0)).cast("long")


def _repeats(windows: Column) -> Column:
    def places(run: Column) -> Column:
        # Neighbours in sorted order with one hash are repeats of one window.
        same = lambda i, j: F.get(run, i)["h"] == F.get(run, j)["h"]
        hit = F.filter(run, lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
        return _covered(F.sort_array(F.transform(hit, lambda x: x["i"])))

    run = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        F.get(F.transform(F.array(run), places), F.lit(0))
    )


@dataclass(frozen=True)
class Rule:
    """``fails`` makes, from the text, the condition of failure."""

    name: str
    fails: Callable[[Column], Column]


def base_failed(words: Column, repeats: Column) -> Column:
    return (words < 50) | (100 * repeats > 50 * words)


FIGURES = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words}


def rules_over(of: Callable[[str, Column], Column]) -> tuple[Rule, ...]:
    """The rules, given each figure of a text by its name. Thresholds in the
    manner of published web-text filters."""
    return (
        Rule("few_words_or_repeats", lambda t: base_failed(of("n_words", t), of("n_repeat_words", t))),
        Rule("symbols", lambda t: of("n_symbols", t) * 10 > of("n_words", t)),
        Rule("word_length", lambda t: (of("word_chars", t) < 3 * of("n_words", t)) | (of("word_chars", t) > 12 * of("n_words", t))),
        Rule("dup_lines", lambda t: of("n_dup_lines", t) * 10 > 3 * F.size(F.split(t, "\n"))),
        Rule("capitals", lambda t: F.regexp_count(t, F.lit(r"\p{Lu}")) * 10 > 4 * of("word_chars", t)),
        Rule("marks", lambda t: F.regexp_count(t, F.lit(r"[!?]")) * 5 > of("n_words", t)),
    )


#: Rules that work their figures out, and rules that read them from columns.
RULES = rules_over(lambda name, t: FIGURES[name](t))
FIGURE_RULES = rules_over(lambda name, _: F.col(name))


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, text: str = "text", figures: dict[str, Callable[[Column], Column]] | None = None) -> list[tuple[str, float, float]]:
    """(name, seconds a row, share of rows that fail) on a sample; ``figures``:
    columns that the rules read beside the text."""
    share = min(1.0, sample_rows / max(docs.count(), 1))
    drawn = docs.sample(share, seed=1).select(F.coalesce(F.col(text), F.lit("")).alias("t")).repartition(4)
    sample = stored(drawn.withColumns({name: f(F.col("t")) for name, f in (figures or {}).items()}), "rule-sample")

    def run(condition: Column) -> tuple[float, int, int]:
        took = []
        for _ in range(REPEATS + 1):
            began = time.perf_counter()
            n, failed = sample.agg(F.count("*"), F.coalesce(F.sum(condition.cast("int")), F.lit(0))).first()
            took.append(time.perf_counter() - began)
        return min(took[1:]), n, failed

    idle, n, _ = run(F.octet_length("t") < 0)
    out = []
    for rule in rules:
        took, _, failed = run(rule.fails(F.col("t")))
        out.append((rule.name, max(took - idle, 1e-3) / max(n, 1), failed / max(n, 1)))
    return out


def order(rules: tuple[Rule, ...], measured: list[tuple[str, float, float]]) -> list[Rule]:
    rank = {name: share / max(cost, 1e-9) for name, cost, share in measured}
    return sorted(rules, key=lambda r: -rank[r.name])


def cascade(text: Column, ordered: list[Rule]) -> Column:
    """Name of the first rule, in this order, that fails; null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(ordered):
        out = F.when(rule.fails(text), F.lit(rule.name)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", verdict: str = "kept", figures: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """The documents with a boolean column ``verdict``: no rule fails.
    ``figures``: columns that are added too, which the rules may read."""
    ordered = order(rules, measure(docs, rules, text=text, figures=figures))
    whole = F.coalesce(F.col(text), F.lit(""))
    told = docs.withColumns({name: f(whole) for name, f in (figures or {}).items()})
    return told.withColumn(verdict, cascade(whole, ordered).isNull())
