"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

A document stays if it passes the base and every rule, so the order of the rules decides what
the verdict costs and never what it is. ``estimate`` times each rule alone on a sample and counts
which sets of rules the sample's documents fail; ``ordered`` then puts first the rule that rejects
most per second, next the one that rejects most per second of what the first leaves, and so on,
for rules that fail together are not independent. ``verdict`` is one CASE expression in that order:
Spark evaluates a branch only for the documents that all branches before it have passed.

Statistics are array expressions within a row: nothing is exploded and nothing is shuffled, so
that hot sources, copies and common words cost no more than other rows. Windows of words are
looked up in a hash set; only documents that repeat one sort their positions.

The sample is a Bernoulli sample of ``SAMPLE_ROWS`` documents on average. It costs a second read of
the text column, or none where the caller passes a sample or an order; no verdict depends on it.

Defined cases: a null text is the empty text, which has no words and fails the base; lines
without a word are no lines; texts of fewer than three words have no window; repeated rows and null ids are
rows like any other; an empty table gives an empty result, and the rules as they are listed;
other columns are kept, whatever their names. Windows of one text are told apart by 64-bit hashes.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import WORD, by_place, named, unused

BLANKS = " \t\n\x0b\x0c\r"
#: What is no symbol.
NO_SYMBOLS = r"[^#*$%&|<>]+"
#: A word without a letter, looked for where words start.
WITHOUT_LETTER = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]++(?![^\x20\x09-\x0D])"
WINDOW = 3
#: Documents that the rules are timed on, on average, and the tasks that hold them.
SAMPLE_ROWS, SAMPLE_TASKS = 2_000, 4
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The base: words at least, and percent of words in repeated windows at most.
LEAST_WORDS, MOST_REPEATED = 50, 50


def text_of(text: Column) -> Column:
    """A text, null as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def remaining(text: Column, pattern: str) -> Column:
    """How many characters a text has beside the runs that match."""
    return F.length(F.regexp_replace(text, F.lit(pattern), F.lit(""))).cast("bigint")


def once(computed: Column) -> Column:
    """The same, but as an expression that the optimizer moves into no filter, where each use of it would be computed anew."""
    return F.when(F.spark_partition_id() >= 0, computed)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def lines_of(text: Column) -> Column:
    """The lines with a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")


def repeats(items: Column) -> Column:
    """Items that equal an earlier one."""
    return (F.size(items) - F.size(F.array_distinct(items))).cast("bigint")


def window_hashes(words: Column, width: int = WINDOW) -> Column:
    """A hash of each run of ``width`` words, in order; none if there are fewer."""
    at = F.when(F.size(words) >= width, F.sequence(F.lit(0), F.size(words) - width)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(width))))


def repeated_starts(placed: Column) -> Column:
    """Where repeated windows start; ``placed``: their hashes and positions, sorted, so that equal ones are neighbours."""
    hash_at = lambda i: F.when(i >= 0, F.get(placed, i)["h"])
    twice = F.filter(placed, lambda x, k: hash_at(k - 1).eqNullSafe(x["h"]) | hash_at(k + 1).eqNullSafe(x["h"]))
    return F.transform(twice, lambda x: x["i"])


def with_statistics(docs: DataFrame, text: Column) -> DataFrame:
    """The table with ``__text`` and the columns of ``STATISTICS``, which take the names ``__n_words`` and so on.

    Each step is a projection of its own, so that nothing is computed twice; the lines stay, for the rules, as ``__lines``.
    """
    rows = docs.withColumn("__text", text_of(text)).withColumn("__lines", once(lines_of(F.col("__text"))))
    rows = rows.withColumn("__words", once(words_of(F.col("__text")))).withColumn("__hashes", once(window_hashes(F.col("__words"))))
    rows = rows.withColumns({"__n_words": F.size("__words").cast("bigint"), "__word_chars": F.length(F.array_join("__words", "")).cast("bigint"), "__twice": F.size("__hashes") > F.size(F.array_distinct("__hashes"))}).drop("__words")
    rows = rows.withColumn("__placed", once(F.when(F.col("__twice"), F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))).drop("__hashes")
    starts = rows.withColumn("__starts", once(repeated_starts(F.col("__placed")))).drop("__placed")
    covered = F.size(F.array_distinct(F.flatten(F.transform("__starts", lambda i: F.sequence(i, i + (WINDOW - 1))))))
    return starts.withColumns({
        "__n_symbols": remaining(F.col("__text"), NO_SYMBOLS),
        "__n_dup_lines": repeats(F.col("__lines")),
        "__n_repeat_words": F.when(F.col("__twice"), covered).otherwise(0).cast("bigint"),
    }).drop("__twice", "__starts")


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows; over the columns of ``with_statistics``."""
    return (F.col("__n_words") < LEAST_WORDS) | (100 * F.col("__n_repeat_words") > MOST_REPEATED * F.col("__n_words"))


@dataclass(frozen=True)
class Rule:
    """A rule: what passes it, over the columns of ``with_statistics``."""

    name: str
    passes: Callable[[], Column]


def _share(part: Column, percent: int, whole: Column) -> Column:
    return 100 * part <= percent * whole


_n, _text = lambda name: F.col(f"__{name}"), lambda: F.col("__text")
_lines_such = lambda pattern: F.size(F.filter("__lines", lambda line: line.rlike(pattern)))
#: Limits in the manner of published filters for web text, wide enough to leave clean prose of any language alone.
RULES = (
    Rule("mean_word_length", lambda: (_n("word_chars") >= 2 * _n("n_words")) & (_n("word_chars") <= 12 * _n("n_words"))),
    Rule("symbols", lambda: _share(_n("n_symbols"), 10, _n("n_words"))),
    Rule("duplicate_lines", lambda: _share(_n("n_dup_lines"), 40, F.size("__lines"))),
    Rule("bullets", lambda: _share(_lines_such(r"^[ \t]*[-*•‣●]"), 90, F.size("__lines"))),
    Rule("ellipses", lambda: _share(_lines_such(r"(?:\.\.\.|…)[ \t\r]*\z"), 30, F.size("__lines"))),
    Rule("exclamations", lambda: _share(remaining(_text(), "[^!]+"), 50, _n("n_words"))),
    Rule("digits", lambda: _share(remaining(_text(), "[^0-9]+"), 30, _n("word_chars"))),
    Rule("capitals", lambda: _share(remaining(_text(), r"\P{Lu}+"), 30, _n("word_chars"))),
    Rule("words_with_letters", lambda: _share(F.regexp_count(_text(), F.lit(WITHOUT_LETTER)), 25, _n("n_words"))),
)


@dataclass(frozen=True)
class Estimate:
    """Seconds of each rule over the sample, and how many of its documents fail which set of rules."""

    seconds: dict[str, float]
    failing: dict[frozenset[str], int]


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 11) -> DataFrame:
    """``rows`` documents on average, written to the shared folder."""
    n = docs.count()  # of a Parquet table the footers tell
    some = docs.sample(min(1.0, rows / n), seed) if n > rows else docs
    return cut(some.repartition(SAMPLE_TASKS))


def estimate(sample: DataFrame, rules: tuple[Rule, ...] = RULES, runs: int = 2) -> Estimate:
    """What each rule costs and rejects of a small table with the columns of ``with_statistics``.

    The driver gets a row for each set of rules that some document fails, at most as many as the sample has rows.
    """
    rows = sample.filter(~base_failed())

    def seconds(condition: Column) -> float:
        took = []
        for _ in range(runs):
            began = time.perf_counter()
            rows.agg(F.count_if(condition)).collect()
            took.append(time.perf_counter() - began)
        return min(took)

    idle = seconds(F.length("__text") >= 0)
    names = F.array_compact(F.array(*(F.when(~F.coalesce(r.passes(), F.lit(False)), r.name) for r in rules)))
    failing = {frozenset(r["f"]): r["n"] for r in rows.groupBy(names.alias("f")).agg(F.count("*").alias("n")).collect()}
    return Estimate({r.name: max(seconds(r.passes()) - idle, 1e-3) for r in rules}, failing)


def ordered(found: Estimate, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """The rules by rejections per second of what those before leave; where none rejects, the cheap ones first."""
    left, out, rest = dict(found.failing), [], list(rules)
    while rest:
        rejected = {r.name: sum(n for failed, n in left.items() if r.name in failed) for r in rest}
        best = max(rest, key=lambda r: (rejected[r.name] / found.seconds[r.name], -found.seconds[r.name]))
        rest.remove(best)
        out.append(best)
        left = {failed: n for failed, n in left.items() if best.name not in failed}
    return tuple(out)


def verdict(rules: tuple[Rule, ...]) -> Column:
    """The name of what rejects a document first, ``base`` or a rule, or null; later rules aren't evaluated."""
    return reduce(lambda c, r: c.when(~F.coalesce(r.passes(), F.lit(False)), r.name), rules, F.when(base_failed(), "base"))


def judged(docs: DataFrame, rules: tuple[Rule, ...] | None = None, text_col: str = "text", sample: DataFrame | None = None, names: tuple[str, ...] = (*STATISTICS, "base_failed", "rejected_by")) -> DataFrame:
    """The documents with their statistics, whether they fail the base, and what rejects them, null if nothing does.

    ``rules``: in this order, else in the order that a sample tells. ``names`` of the columns added get underscores after them
    where the documents have such a column. What rejects a document first depends on the order; whether anything does, not.
    """
    rows, (t,) = by_place(docs, text_col)
    if rules is None:
        some = sample_of(docs) if sample is None else sample
        measured = with_statistics(some.select(named(text_col).alias("__given")), F.col("__given")).drop("__given")
        rules = ordered(estimate(cut(measured)))
    counted = with_statistics(rows, F.col(t)).withColumn("__base", base_failed())
    out = counted.select(*rows.columns, *(f"__{s}" for s in STATISTICS), "__base", once(verdict(rules)))
    return out.toDF(*docs.columns, *unused(docs, *names))


def keep(docs: DataFrame, rules: tuple[Rule, ...] | None = None, text_col: str = "text", sample: DataFrame | None = None) -> DataFrame:
    """The documents that pass, with their own columns."""
    out = judged(docs, rules, text_col, sample)
    return out.filter(named(out.columns[-1]).isNull()).drop(*out.columns[len(docs.columns):])


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """(doc_id, the statistics, base_failed, kept) of every document."""
    out = judged(docs.select("doc_id", "text"), rules)
    return out.select("doc_id", *STATISTICS, "base_failed", F.col("rejected_by").isNull().alias("kept"))
