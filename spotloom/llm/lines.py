"""Line deduplication by overlapping three-line windows, in DataFrame functions alone.

Every run of three consecutive lines of a document is hashed to 128 bits. A window's first
occurrence is the one of the smallest (doc_id, text, position); all others are later occurrences,
within a document too. A line goes if a later occurrence covers it: the covered positions of
a document are merged, and the remaining lines are joined again.

Lines are what newline characters separate; a line of more than ``LONG`` words counts as
several, cut after the ends of its sentences, so that a long passage spans windows wherever it
stands. The parts of a cut line are compared without the spaces after them, and what is left
of it stays one line.

Plan: documents become narrow rows (id, position, hash) and only these are shuffled, with
partial aggregation by hash, so that a passage that many documents share costs a row for each
map task; the first occurrences of repeated windows, one row for each hash, are joined back
to the narrow rows, a join whose hot partitions Spark's adaptive execution splits. Texts are
shuffled once, by id and a hash of the text, to be rebuilt.

Defined cases: a null text stays null and an empty text stays empty; documents of fewer than
three lines have no window and stay whole; windows of blank lines alone don't count; a
document all of whose lines go becomes the empty text; rows that repeat id and text are one
document at one place, so none of them loses a line to the other; rows that repeat an id with
other texts are documents of their own, in the order of a hash of the text, and so are rows
with a null id, which come before all others; an empty table gives an empty result; other
columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import WORD, by_place, named, unused

WINDOW = 3
#: Words of a line that isn't cut, at most.
LONG = 50
#: A sentence with the space after it, or the rest of a line.
SENTENCE = r"(?s)[^.!?]*+(?:[.!?](?! )[^.!?]*+)*+[.!?] |.+"


def _pieces(line: Column, long: int, whole: Callable[[Column], Column], piece: Callable[[Column], Column]) -> Column:
    """What a line counts as: itself, or its sentences with the spaces after them if it has more than ``long`` words."""
    # Found after that many words, which with the spaces between them need twice as many characters.
    many = (F.length(line) > 2 * long) & line.rlike(rf"^[\x20\x09-\x0D]*+(?:{WORD}+[\x20\x09-\x0D]++){{{long}}}{WORD}")
    return F.when(many, F.transform(F.regexp_extract_all(line, F.lit(SENTENCE), F.lit(0)), piece)).otherwise(F.array(whole(line)))


def split_lines(text: Column, long: int = LONG) -> Column:
    """What is compared: the lines of a text, and the sentences of its long lines without the spaces after them."""
    return F.flatten(F.transform(F.split(text.cast("string"), "\n", -1), lambda line: _pieces(line, long, lambda x: x, lambda x: F.rtrim(x))))


def written_lines(text: Column, long: int = LONG) -> Column:
    """What is written: (at, piece) of every line, ``at`` being the number of the line that it is of."""

    def one(line: Column, at: Column) -> Column:
        put = lambda x: F.struct(at.alias("at"), x.alias("piece"))
        return _pieces(line, long, put, put)

    return F.flatten(F.transform(F.split(text.cast("string"), "\n", -1), one))


def _document(id_col: str, text_col: str) -> tuple[Column, Column]:
    """What names a document: its id and a hash of its text."""
    return named(id_col).cast("bigint"), F.xxhash64(named(text_col).cast("string"))


def windows(docs: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc, pos, h1, h2): every window of consecutive lines that isn't blank; ``doc`` is a hash of the text."""
    doc_id, doc = _document(id_col, text_col)
    rows = docs.select(doc_id.alias("doc_id"), doc.alias("doc"), split_lines(named(text_col)).alias("l")).filter(F.size("l") >= width)
    each = rows.select("doc_id", "doc", "l", F.explode(F.sequence(F.lit(0), F.size("l") - width)).alias("pos"))
    own = [F.get(F.col("l"), F.col("pos") + k) for k in range(width)]
    full = reduce(Column.__or__, (F.trim(x) != "" for x in own))
    # Two independent 64-bit hashes of the lines in order.
    return each.filter(full).select("doc_id", "doc", "pos", F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit(7), *own).alias("h2"))


def later(docs: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc, pos): the start of every window that occurred before."""
    every = windows(docs, width, id_col, text_col)
    place = F.struct(F.col("doc_id"), F.col("doc"), F.col("pos"))
    repeated = every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    # Cut, so that the join reads two plain shuffles, whose hot partitions can be split.
    found = every.join(cut(repeated.select("h1", "h2", "first")), ["h1", "h2"])
    return found.filter(~place.eqNullSafe(F.col("first"))).select("doc_id", "doc", "pos")


def dedup_lines(docs: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, ...] = ("__lines", "__removed")) -> DataFrame:
    """The documents with later occurrences cut out; ``counts`` names two columns of lines and of removed lines, or is empty.

    Where the documents have a column of such a name, the count's name gets an underscore more.
    """
    rows, (i, t) = by_place(docs, id_col, text_col)
    doc_id, doc = _document(i, t)
    covered = later(rows, width, i, t).groupBy(F.col("doc_id").alias("__id"), F.col("doc").alias("__doc")).agg(F.collect_set("pos").alias("__at"))
    joined = rows.join(covered, doc_id.eqNullSafe(F.col("__id")) & (doc == F.col("__doc")), "left")
    # A line goes if a covered window starts at it or at one of the lines just before.
    at = F.col("__at")
    gone = F.flatten(F.transform(at, lambda p: F.sequence(p, p + (width - 1))))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__l") - 1), gone)
    out = joined.withColumn("__l", F.when(at.isNotNull(), written_lines(F.col(t)))).withColumn("__stay", stay)
    out = out.withColumn("__kept", F.transform("__stay", lambda i: F.get("__l", i)))
    # Pieces of one line are written side by side, those of another after a newline.
    before = lambda k: F.when((k > 0) & (F.get("__kept", k - 1)["at"] != F.get("__kept", k)["at"]), "\n").otherwise("")
    rebuilt = F.array_join(F.transform("__kept", lambda x, k: F.concat(before(k), x["piece"])), "")
    text = F.when(at.isNull(), F.col(t)).otherwise(rebuilt)
    names = [F.col(c) if c != t else text.alias(t) for c in rows.columns]
    if not counts:
        return out.select(*names).toDF(*docs.columns)
    count = F.when(F.col(t).isNull(), 0).otherwise(F.coalesce(F.size("__l"), F.size(split_lines(F.col(t)))))
    removed = F.when(at.isNull(), 0).otherwise(F.size("__l") - F.size("__kept"))
    return out.select(*names, count.cast("bigint"), removed.cast("bigint")).toDF(*docs.columns, *unused(docs, *counts))
