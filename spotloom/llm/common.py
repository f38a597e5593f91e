"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def named(name: str) -> Column:
    """A column by its whole name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def by_place(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """The table with its columns named by place, so that no name clashes with an operator's own, and the new names of some."""
    return docs.toDF(*(f"c{k}" for k in range(len(docs.columns)))), [f"c{docs.columns.index(n)}" for n in names]


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Names for columns to be added: each as given, or with underscores after it where the table has it already."""
    taken, out = {c.lower() for c in docs.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def content(text: str | Column) -> Column:
    """A text as UTF-8 bytes, null as the empty text."""
    c = named(text) if isinstance(text, str) else text
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """Whether crc32 of the id's decimal text leaves ``rest``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod == rest


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows, so that Python objects of few rows live at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: Rows of a narrow table up to which it is broadcast: some 32 MB of two numbers each.
BROADCAST_ROWS = 500_000


def bounded(narrow: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow table, to be broadcast if a count shows that it is small; a join's result is the same either way."""
    return F.broadcast(narrow) if narrow.limit(rows + 1).count() <= rows else narrow


def labelled_sample(docs: DataFrame, labels: DataFrame, keep: Column, rows: int, id_col: str = "doc_id") -> DataFrame:
    """The documents of at most ``rows`` label rows that ``keep`` admits, chosen by a hash of the id.

    Only the chosen label rows are broadcast: their number is bounded by ``rows``.
    """
    chosen = labels.filter(keep).orderBy(F.xxhash64(F.col(id_col)), F.col(id_col)).limit(rows)
    return docs.join(F.broadcast(chosen), id_col)
