"""Filter interaction audit: what every filter removes, in every order in which filters can run.

What a filter removes as the next step depends only on the set of filters applied before, not on their
order: n filters have n * 2**(n - 1) edges (set applied, next filter) in the lattice of sets, 80 for five,
and every order of the filters is a path through them. Documents are counted on edges, and the counted
edges are joined to the steps of all orders: 600 for five filters, whatever the number of documents.

Plan: a document becomes a narrow row (id, part, digest of the text, the filters that its text fails). Rows that
repeat are counted, labels are joined to them, and copies are counted by (digest, part, failures, labels), with
partial aggregation before every shuffle, so that a text, part or id that a third of all rows share costs a row
for each map task. The smallest id of a digest is then sought among those counts, at most one for each
combination of part and labels. What is left is a row for each part, set of failed filters and pair of labels; each is
put on all edges by two explodes of constants. Only the steps, whose number the filters fix, are broadcast, and
labels where a count shows that they are few.

Defined cases: a null text is the empty text; a null part is the empty string, and one part with it; a null id has no order, so
such a row is no copy of a smaller id and makes none, and has no labels; rows that repeat an id and a text are no copies
of each other; a document with several rows of labels has a label if one of them says so; null labels say nothing; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded, content, named
from .rules import once, remaining, text_of, words_of

#: What fails a filter, over a text and its words; the last filter, COPIES, looks at the whole table.
FILTERS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
    "C": lambda text, words: 100 * remaining(text, "[^A-Z]+") > 2 * F.length(text),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
COPIES = "E"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(docs: DataFrame, filters: dict[str, Callable[[Column, Column], Column]] = FILTERS, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, part, digest, failed, n): a bit for each filter that the text fails, and how often the row occurs."""
    part = F.coalesce(named(part_col).cast("string"), F.lit("")).alias("part")
    rows = docs.select(named(id_col).cast("bigint").alias("id"), part, text_of(named(text_col)).alias("text")).withColumn("words", once(words_of(F.col("text"))))
    bits = [F.when(fails(F.col("text"), F.col("words")), 1 << k).otherwise(0) for k, fails in enumerate(filters.values())]
    failed = sum(bits[1:], bits[0]).cast("int").alias("failed")
    return rows.select("id", "part", F.unhex(F.sha2(content(F.col("text")), 256)).alias("digest"), failed).groupBy("id", "part", "digest", "failed").agg(F.count("*").alias("n"))


def labelled(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """The rows with ``good`` and ``toxic``; those without an id are dealt by their digest, as none of them finds a label."""
    says = lambda c: F.max((named(c) == 1).cast("int")).alias(c)
    known = labels.filter(named(id_col).isNotNull()).groupBy(named(id_col).cast("bigint").alias("__id")).agg(says(good), says(toxic))
    known = known.select("__id", F.lit(0).alias("__deal"), F.coalesce(named(good), F.lit(0)).alias("good"), F.coalesce(named(toxic), F.lit(0)).alias("toxic"))
    dealt = rows.withColumn("__of", F.when(F.col("id").isNull(), F.hash("digest")).otherwise(0))
    out = dealt.join(bounded(known), (F.col("id") == F.col("__id")) & (F.col("__of") == F.col("__deal")), "left")
    return out.select(*rows.columns, *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")))


def counted(rows: DataFrame, bit: int) -> DataFrame:
    """(part, failed, good, toxic, n), with ``bit`` set for documents that a smaller id has the text of."""
    by = ("part", "failed", "good", "toxic")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))  # ids are not repeated within such a group
    groups = rows.groupBy("digest", *by).agg(F.sum("n").alias("n"), first.alias("first"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id"))
    least = F.min("first.id").over(Window.partitionBy("digest"))
    originals = F.col("without_id") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = groups.withColumn("least", least).select(*by, originals.alias("own"), "n")
    each = split.select(*by, F.explode(F.array(F.struct(F.col("failed"), F.col("own").alias("n")), F.struct(F.col("failed").bitwiseOR(bit).alias("failed"), (F.col("n") - F.col("own")).alias("n")))).alias("x"))
    return each.select("part", "x.failed", "good", "toxic", "x.n").groupBy(*by).agg(F.sum("n").alias("n"))


def edges(counts: DataFrame, n: int) -> DataFrame:
    """(part, applied, next, the counts, shapley): every edge of the lattice for every part, zeros included.

    ``shapley`` sums up what the next filter removes over all orders, in all of which it stands once.
    """
    on = counts.withColumn("applied", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1)))).withColumn("next", F.explode(F.array(*(F.lit(k) for k in range(n)))))
    own = F.element_at(F.array(*(F.lit(1 << k) for k in range(n))), F.col("next") + 1)
    on = on.withColumn("own", own).filter(F.col("applied").bitwiseAND(F.col("own")) == 0)
    fails, before = F.col("failed").bitwiseAND(F.col("own")) != 0, F.col("failed").bitwiseAND(F.col("applied")) != 0
    removed = fails & ~before
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("bigint")
    found = on.groupBy("part", "applied", "next").agg(
        total(~fails & ~before).alias("kept"),
        total(removed).alias("removed"),
        total(fails & before).alias("redundant"),
        total(F.col("failed") == F.col("own")).alias("unique_fails"),
        total(removed & (F.col("good") == 1)).alias("good_lost"),
        total(removed & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    # As many orders pass through an edge as there are orders of what comes before, times those of what comes after.
    orders = F.element_at(F.array(*(F.lit(math.factorial(k) * math.factorial(n - 1 - k)).cast("bigint") for k in range(n))), F.bit_count("applied") + 1)
    return found.withColumn("shapley", F.sum(F.col("removed") * orders).over(Window.partitionBy("part", "next")))


def steps(spark, letters: str) -> DataFrame:
    """(filter_order, step, applied, next): every order of the filters as a path of edges."""
    rows = [("".join(letters[k] for k in order), at + 1, sum(1 << k for k in order[:at]), order[at]) for order in permutations(range(len(letters))) for at in range(len(letters))]
    return spark.createDataFrame(rows, "filter_order string, step int, applied int, next int")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column, Column], Column]] = FILTERS, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, filter_order, step, the counts, shapley): a row for each part and step of each order; the filters and then COPIES have letters."""
    letters = "".join(filters) + COPIES
    if len(letters) > 7:
        raise ValueError("seven filters at most: their orders are written out")
    rows = labelled(failures(docs, filters, part_col, id_col, text_col), labels, id_col)
    lattice = edges(counted(rows, 1 << len(filters)), len(letters))
    out = lattice.join(F.broadcast(steps(docs.sparkSession, letters)), ["applied", "next"])  # bounded by the number of filters
    return out.select("part", "filter_order", "step", *COUNTS, "shapley")
