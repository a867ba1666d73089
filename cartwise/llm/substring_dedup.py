"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text and a chunk ends where it falls below a bound, so chunk
boundaries depend on the 32 bytes before them only: text inserted elsewhere shifts no chunk. What is compared
is a chunk with those after it, as many as it takes to hold `min_words` whole words (or 12 bytes for each of
them, whichever comes first: text without white space has no words). Such a window is known by a 96-bit
digest of its bytes (two of 10^13 agree by chance in less than one run in a thousand), and the document with
the smallest id that has it is its original. Every window whose original is another document is repeated:
that document has its bytes in one piece. Overlapping windows make a span; common phrases and single
lines are shorter than a window and left alone. Every distinct chunk stays somewhere.

A window that comes again in its own document is a repetition inside; those are returned if asked for,
marked, and are no reason to change a text unless asked for.

Spans count characters; when they are taken out, no word is cut if there is white space in them. Null
text counts as empty. Rows with the same id count as one document, whose texts are told apart by a
64-bit hash; rows that repeat an id with its text have their spans once. Every row with a null id is a
document of its own, and an original only of windows that no document with an id has.
Documents without a repeated span have no row; an empty table gives an empty result.
"""
import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..staging import checkpointed
from .common import apart

#: A chunk ends with probability 1 / CUT_EVERY at each byte beyond the least length.
CUT_EVERY = 24
LEAST, MOST = 12, 256
MIN_WORDS = 16
_WINDOW = 32
_ROWS = 1 << 15
#: Bytes that count as much as a word, and the most words that an extent has room for.
WORD_BYTES, MOST_WORDS = 12, 64
#: Parts of an extent: start, length and whole words, whether the document had the window before, and the
#: lowest bits of the number of words before it.
START, LENGTH, WORDS, INSIDE, BEFORE = (
    "cast(shiftright(extent, 33) as int)", "cast(shiftright(extent, 22) & 2047 as int)",
    "cast(shiftright(extent, 12) & 1023 as int)", "(extent & 2048) <> 0", "cast(extent & 2047 as int)")
_EDGE_SPACE = re.compile(r"\s")

_GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "little")
                  for b in range(256)], np.uint32)


def gear(data):
    """Gear hash at every byte: the sum of table[byte] << age over the last 32 bytes."""
    h, reach = _GEAR[data], 1
    while reach < min(_WINDOW, len(h)):
        older = np.zeros_like(h)
        older[reach:] = h[:-reach] << np.uint32(reach)
        h = h + older
        reach *= 2
    return h


def chunk_ends(data, cut_every=CUT_EVERY, least=LEAST, most=MOST):
    """Ends of the chunks of a UTF-8 text, at character boundaries only."""
    n = len(data)
    if not n:
        return []
    whole = np.append((data[1:] & 0xC0) != 0x80, True)  # the next byte begins a character
    # The highest bits of the hash have seen the whole window.
    cut = np.flatnonzero(whole & (gear(data) < np.uint32((1 << 32) // cut_every))) + 1
    ends, start = [], 0
    for end in [*cut.tolist(), n]:
        while end - start > most:
            at = start + most
            while not whole[at - 1]:
                at -= 1
            ends.append(at)
            start = at
        if end - start >= least or end == n and end > start:
            ends.append(end)
            start = end
    return ends


def windows_of(text, min_words=MIN_WORDS):
    """(start, length, words, inside, before, digests) of every window of a text; see START."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    at = np.array([0, *chunk_ends(data)])
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inner = np.append(False, ~space[1:] & ~space[:-1])  # the byte goes on with the word of the one before
    last = ~space & np.append(space[1:], True)[:len(space)]
    ended = np.append(0, np.cumsum(last))[at]  # words that end before a boundary
    # Words that begin before a boundary and end after it are whole on neither side.
    before = ended + np.append(inner, False)[at]
    enough = np.minimum(np.searchsorted(ended, before + min_words),
                        np.searchsorted(at, at + min_words * WORD_BYTES))
    first = np.flatnonzero(enough < len(at))
    until = enough[first]
    digests = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(at[first].tolist(), at[until].tolist())])
    digests = np.frombuffer(digests, "<i8").reshape(-1, 2)
    chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))[at] if len(raw) != len(text) else at
    inside = np.zeros(len(first), bool)
    if len(first) > 1:
        _, index, inverse = np.unique(digests.view("i8,i8").ravel(), return_index=True, return_inverse=True)
        inside = index[inverse] != np.arange(len(first))
    return (chars[first], chars[until] - chars[first], np.maximum(ended[until] - before[first], 0), inside,
            before[first], digests)


def windows(rows, min_words=MIN_WORDS):
    """Windows of the rows (doc_id, text_number, text): doc_id, text_number, extent, d1, d2."""
    if not 0 < min_words <= MOST_WORDS:
        raise ValueError(f"min_words must be between 1 and {MOST_WORDS}")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def of_text(text):
        start, length, words, inside, before, digests = (
            x.astype(np.int64) for x in windows_of(text, min_words))
        return start << 33 | length << 22 | words << 12 | inside << 11 | before & 2047, digests

    def run(batches):
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            out, held = [], 0
            for doc_id, number, text in zip(
                    *(batch.column(c) for c in ("doc_id", "text_number", "text"))):
                out.append((doc_id.as_py(), number.as_py(), *of_text(text.as_py())))
                held += len(out[-1][3])
                if held > _ROWS:
                    yield _batch(out, kind)
                    out, held = [], 0
            if held:
                yield _batch(out, kind)

    def _batch(out, kind):
        ids, numbers, extents, digests = zip(*out)
        document = np.repeat(np.arange(len(out)), [len(d) for d in digests])
        digests = np.concatenate(digests)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind).take(pa.array(document)), pa.array(np.array(numbers, np.int64)[document]),
             pa.array(np.concatenate(extents)), pa.array(np.ascontiguousarray(digests[:, 0])),
             pa.array(digests[:, 1].astype(np.int32))], ["doc_id", "text_number", "extent", "d1", "d2"])

    return rows.mapInArrow(run, f"doc_id {id_type}, text_number long, extent long, d1 long, d2 int")


def numbered(docs, id_col="doc_id", text_col="text"):
    """(row, doc_id, text, text_number): each row as it is, and what tells apart the texts of an id, a hash of
    the text.

    A row without an id is a document of its own and has the number of its place. Places are not the same
    whenever rows are read again, so these rows are kept.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), text.alias("text"))
    nameless = rows.where("doc_id IS NULL").withColumn("text_number", F.monotonically_increasing_id())
    named = rows.withColumn("text_number", F.xxhash64("text"))
    if nameless.isEmpty():
        return named
    return named.where("doc_id IS NOT NULL").unionByName(checkpointed(nameless))


def repeated_spans(docs, min_words=MIN_WORDS, inside=False, id_col="doc_id", text_col="text"):
    """Spans that repeat: doc_id, text_number, start, end, words, first_id, first_ids, inside.

    first_id is the smallest of the documents that hold the originals, first_ids has all of them; an
    original without an id is null in the one and missing in the other. With inside=True repetitions within
    a document have rows of their own, marked by `inside`.
    """
    return _spans(numbered(docs, id_col, text_col), min_words, inside)


def _spans(rows, min_words, inside=False):
    parts = windows(rows.select("doc_id", "text_number", "text"), min_words)
    # Numeric minima are summed up before the shuffle, however often a window occurs.
    place = F.when(F.col("doc_id").isNull(), F.col("text_number"))
    first = (parts.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
        F.min(place).alias("first_place"), F.max(place).alias("last_place"))
        .where("last_id > first_id OR first_id IS NOT NULL AND first_place IS NOT NULL "
               "OR first_id IS NULL AND last_place > first_place")
        .select("d1", "d2", "first_id", "first_place", F.lit(True).alias("shared")))
    elsewhere = F.expr("coalesce(shared AND (NOT doc_id <=> first_id OR doc_id IS NULL AND "
                       "text_number <> first_place), false)")
    repeated = parts.join(apart(first), ["d1", "d2"], "left" if inside else "inner").withColumn("inside", ~elsewhere)
    repeated = (repeated.where(f"NOT inside OR {INSIDE}" if inside else "NOT inside")
                .select("doc_id", "text_number", "inside", "extent", F.when(~F.col("inside"), F.col("first_id"))
                        .otherwise(F.col("doc_id")).alias("first_id")).distinct()
                .select("*", F.expr(START).alias("start"), F.expr(f"{START} + {LENGTH}").alias("end"),
                        F.expr(WORDS).alias("words"), F.expr(BEFORE).alias("before")))
    # Windows begin and end in the same order, so the one before tells whether a span goes on.
    order = Window.partitionBy("doc_id", "text_number", "inside").orderBy("start")
    gap = F.coalesce(F.col("start") > F.lag("end").over(order), F.lit(True))
    more = F.pmod(F.col("before") - F.lag("before").over(order), F.lit(2048)) - F.lag("words").over(order)
    runs = (repeated.withColumns({"new": gap, "more": F.col("words") + F.when(gap, 0).otherwise(more)})
            .withColumn("run", F.sum(F.col("new").cast("int")).over(
                order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return (runs.groupBy("doc_id", "text_number", "inside", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                 F.sum("more").alias("words"), F.min("first_id").alias("first_id"),
                 F.array_sort(F.collect_set("first_id")).alias("first_ids")).drop("run"))


def without(text, spans):
    """The text without the spans [(start, end)], each drawn in to whole words."""
    kept, at = [], 0
    for start, end in sorted(spans):
        if start > 0 and not text[start - 1].isspace():
            space = _EDGE_SPACE.search(text, start, end)
            start = space.start() if space else start
        if end < len(text) and not text[end].isspace():
            while end > start and not text[end - 1].isspace():
                end -= 1
        if 0 < start < end < len(text) and not (text[start - 1].isspace() or text[end].isspace()):
            start += text[start].isspace()  # one space stays between what is joined
        kept.append(text[at:start])
        at = max(at, end)
    return "".join([*kept, text[at:]])


def remove_repeats(docs, min_words=MIN_WORDS, inside=False, id_col="doc_id", text_col="text"):
    """The rows with repeated spans taken out of their texts; all other columns as they are.

    Null texts stay null.
    """
    rows = numbered(docs, id_col, text_col)
    found = (_spans(rows, min_words, inside)
             .groupBy(F.col("doc_id").alias("span_id"), F.col("text_number").alias("span_number"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")))
    same = F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("text_number") == F.col("span_number"))

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else without(t, zip(a, b)) for t, a, b in zip(texts, starts, ends)],
                         dtype=object)

    # Only texts that lose something are sent to Python.
    some = F.col("spans").isNotNull()
    shorter = cleaned(F.when(some, F.col("text")), "spans.start", "spans.end")
    text = F.when(some, shorter).otherwise(F.col("row").getField(text_col))
    return rows.join(found, same, "left").select(F.col("row").withField(text_col, text).alias("row")).select("row.*")


def op2_substring_dedup(spark, sf_dir):
    """Repeated spans of all documents; those inside a document are marked."""
    found = repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"), inside=True)
    return found.select("doc_id", F.col("start").cast("long"), (F.col("end") - F.col("start"))
                        .cast("long").alias("length"), "words", "first_id", "first_ids", "inside")
