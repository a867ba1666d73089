"""Helpers shared by the operators on documents."""
import re

from pyspark.sql import functions as F

_SPACE = re.compile(r"\s")
#: White space where a contract means ASCII white space only.
ASCII_SPACE = re.compile(r"[\x20\x09-\x0D]")


def id_and_text(docs, id_col="doc_id", text_col="text"):
    """doc_id and text alone, so that other columns cannot clash; null text counts as empty."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def apart(totals):
    """Totals per key in partitions of their own, for a join of rows with them on that key.

    Where the join takes totals straight from their aggregation, a hot key's rows must follow into one
    task; with an exchange on both sides adaptive execution divides them.
    """
    return totals.hint("rebalance")


def blocks(text, size=1 << 19, space=_SPACE):
    """The text in parts of about `size` characters, cut before white space only.

    Bounds the memory of what is derived from a very long text. `space` is what separates words
    for the caller; a run without any is never cut.
    """
    start = 0
    while len(text) - start > size:
        cut = space.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text
