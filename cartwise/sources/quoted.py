"""CSV files whose quoted cells hold line breaks, read by as many tasks as the files have parts.

A part of a file cannot tell by itself whether it begins inside a quoted cell. Every line is a function of
that: from outside or from inside a quoted cell it ends in one of the two. The functions of a part's lines
are put together in its task; so are, for both cases, the records that begin in it. One narrow row per part
then gives every part its true start and the number of its first record, and a second pass puts the records
together in the task that reads their part; only pieces of records that reach over the end of a part, at most
two a part, are brought together, by file and number of the record. Both passes look at whole columns of
lines, whose quotes are found at once.

A quote opens a cell only where a cell begins; within a quoted cell two quotes stand for one.
"""
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window, functions as F

from ..staging import checkpointed

#: Parts whose starts are broadcast (some 150 MB); with more the lines are dealt out to them.
BROADCAST_PARTS = 1_000_000
_QUOTE, _COMMA = ord('"'), ord(",")
#: A quote follows another one, stands where a cell begins, or neither.
_FOLLOWS, _BEGINS, _NEITHER = 0, 1, 2
#: What a quote makes of being outside a quoted cell, inside, or just behind its closing quote, by its place.
_OUTSIDE, _INSIDE, _BEHIND = 0, 1, 2
_AFTER = ((_OUTSIDE, _INSIDE, _OUTSIDE), (_BEHIND, _BEHIND, _BEHIND), (_INSIDE, _INSIDE, _OUTSIDE))


def ends_inside(line, inside):
    """Whether a line ends inside a quoted cell, by where it begins."""
    return bool(states_of(pa.array([line]), inside)[1])


def lines_of(spark, paths):
    """(file, part, at, line) in the order of the files within each task."""
    return (spark.read.option("lineSep", "\n").text(paths)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"),
                    F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")))


def states_of(column, inside):
    """For consecutive lines: whether each begins inside a quoted cell, and whether the last one ends there.

    Quotes are found and placed in the bytes of the whole column at once; only they are gone through.
    """
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1]
    low = int(offsets[0])
    text = np.frombuffer(column.buffers()[2] or b"", np.uint8)[low:int(offsets[-1])]
    at = np.flatnonzero(text == _QUOTE)
    upto = np.searchsorted(at, offsets - low)  # quotes before every line
    of = np.searchsorted(upto, np.arange(len(at)), side="right") - 1
    before = text[np.maximum(at - 1, 0)]
    begins = (before == _COMMA) | (at == offsets[of] - low)
    places = np.where(begins, _BEGINS, np.where(before == _QUOTE, _FOLLOWS, _NEITHER))
    state = _INSIDE if inside else _OUTSIDE
    states = [state]
    for place in places.tolist():
        state = _AFTER[state][place]
        states.append(state)
    within = (np.array(states, np.int8) == _INSIDE)[upto]
    return within[:-1], int(within[-1])


def runs_of(batch):
    """(file, part, first row, row after the last) of the consecutive lines of a part."""
    files, parts = batch.column("file"), batch.column("part")
    new = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(parts[1:], parts[:-1])).to_numpy(False)
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield files[low].as_py(), parts[low].as_py(), low, high


def functions_of_parts(lines):
    """(file, part, end0, end1, records0, records1, head): per case of the start, where a part ends (inside: 1)
    and the records that begin in it; of the first part also the first record, if the next one begins there."""

    def run(batches):
        known, heads = {}, {}
        for batch in batches:
            for file, part, low, high in runs_of(batch):
                own, column = known.setdefault((file, part), [0, 1, 0, 0]), batch.column("line")[low:high]
                alike = own[0] == own[1]
                begun, own[0] = states_of(column, own[0])
                if part == 0 and own[2] < 2:
                    starts = np.flatnonzero(~begun)
                    second = starts[1 - own[2]] if len(starts) > 1 - own[2] else len(column)
                    heads.setdefault(file, []).extend(column[:second].to_pylist())
                own[2] += int((~begun).sum())
                # Once both cases have met they go on alike.
                begun, own[1] = (begun, own[0]) if alike else states_of(column, own[1])
                own[3] += int((~begun).sum())
        if known:
            rows = [(*key, *own, "\n".join(heads[key[0]]) if key[1] == 0 and (own[2] > 1 or not own[0]) else None)
                    for key, own in known.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows), [pa.string(), *[pa.int64()] * 5, pa.string()])],
                ["file", "part", "end0", "end1", "records0", "records1", "head"])

    return lines.mapInArrow(
        run, "file string, part long, end0 long, end1 long, records0 long, records1 long, head string")


def starts_of_parts(functions):
    """(file, part, inside, first, cut, head): the true start of every part, the number of records before it,
    and whether a record of it goes on in another part."""
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("part")
    # A part that ends alike in both cases settles the matter; of the others some turn the state round.
    turns = F.sum(F.when((F.col("end0") == 1) & (F.col("end1") == 0), 1).otherwise(0))
    settled = F.when(F.col("end0") == F.col("end1"), F.col("end0").bitwiseXOR(F.col("turned") % 2))
    states = (functions.withColumn("turned", turns.over(upto)).withColumn("settled", settled)
              .withColumn("known", F.coalesce(F.last("settled", True).over(before), F.lit(0)))
              .withColumn("inside", F.col("known").bitwiseXOR(F.coalesce(F.lag("turned").over(upto), F.lit(0)) % 2)))
    records = F.when(F.col("inside") == 1, F.col("records1")).otherwise(F.col("records0"))
    cut = (F.col("inside") == 1) | F.coalesce(F.lead("inside").over(upto) == 1, F.lit(False))
    return states.select("file", "part", "inside", F.coalesce(F.sum(records).over(before), F.lit(0)).alias("first"),
                         cut.alias("cut"), "head")


def _started(lines, starts):
    """The lines with the start of their part, those of a part one after the other."""
    starts = starts.select("file", "part", "inside", "first")
    if starts.count() <= BROADCAST_PARTS:
        # One narrow row per part: the lines stay where they are and in their order.
        return lines.join(F.broadcast(starts), ["file", "part"])
    return (lines.join(starts, ["file", "part"]).repartition("file", "part")
            .sortWithinPartitions("file", "part", "at"))


def _followed(batches):
    """(file, part, lines, whether each begins inside, state after them, number of the record before them,
    whether the part begins here) of the consecutive lines of a part."""
    where, state, number = None, 0, 0
    for batch in batches:
        for file, part, low, high in runs_of(batch):
            new = (file, part) != where
            if new:
                where, state = (file, part), batch.column("inside")[low].as_py()
                number = batch.column("first")[low].as_py()
            column = batch.column("line")[low:high]
            begun, state = states_of(column, state)
            yield file, part, column, begun, state, number, new
            number += int((~begun).sum())


def numbered(lines, starts):
    """(file, record, place, whole, line): record of every line, and whether the line is all of it."""

    def run(batches):
        place = 0
        for file, part, column, begun, state, number, new in _followed(batches):
            n, place = len(column), 0 if new else place
            ended = np.append(begun[1:], bool(state))
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(file, n), pa.array(number + np.cumsum(~begun), pa.int64()), pa.repeat(part, n),
                 pa.array(place + 1 + np.arange(n), pa.int64()), pa.array(~begun & ~ended), column],
                ["file", "record", "part", "place", "whole", "line"])
            place += n

    return _started(lines, starts).mapInArrow(
        run, "file string, record long, part long, place long, whole boolean, line string")


_TEXT = "file string, record long, part long, text string"


def _whole_records(batches):
    """The records that begin and end in a part."""
    return (batch for batch, whole in _put_together(batches) if whole)


def _pieces(batches):
    """The pieces of the other records, one for each part."""
    return (batch for batch, whole in _put_together(batches) if not whole)


def _put_together(batches):
    """(file, record, part, text) as batches, and whether they hold whole records."""

    def batch(file, record, part, text):
        n = len(text)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(file, n), pa.array(record, pa.int64()), pa.repeat(part, n), text],
            ["file", "record", "part", "text"])

    def rest(open_at_end):
        if held:
            yield batch(where[0], [record], where[1], pa.array(["\n".join(held)])), not entered and not open_at_end

    where, held, record, entered, last = None, [], 0, False, 0
    for file, part, column, begun, state, number, new in _followed(batches):
        if new:
            yield from rest(last)
            # Lines of a record that began in an earlier part come first.
            where, held, record, entered = (file, part), [], number, bool(begun[0])
        last, starts = state, np.flatnonzero(~begun)
        if not len(starts):
            held += column.to_pylist()
            continue
        held += column[:starts[0]].to_pylist()
        yield from rest(0)
        # The last record may go on in the next batch.
        record, entered, held = number + len(starts), False, column[starts[-1]:].to_pylist()
        if len(starts) > 1:
            own = pa.ListArray.from_arrays(pa.array(starts - starts[0], pa.int32()), column[starts[0]:starts[-1]])
            yield batch(file, number + 1 + np.arange(len(own)), part, pc.binary_join(own, "\n")), True
    yield from rest(last)


def _records(lines, starts):
    alone = _started(lines, starts).mapInArrow(_whole_records, _TEXT).select("file", "record", "text")
    cut = starts.where("cut")
    if cut.isEmpty():
        return alone
    pieces = F.sort_array(F.collect_list(F.struct("part", "text"))).alias("pieces")
    together = (_started(lines, cut).mapInArrow(_pieces, _TEXT).groupBy("file", "record").agg(pieces)
                .select("file", "record", F.array_join("pieces.text", "\n").alias("text")))
    return alone.unionByName(together)


def records(spark, paths):
    """(file, record, text) of all records of CSV files; record 1 of a file is its header."""
    lines = lines_of(spark, paths)
    return _records(lines, checkpointed(starts_of_parts(functions_of_parts(lines))))


def read_quoted_csv(spark, paths, columns, corrupt):
    """Rows of CSV files with a header as text columns, and `corrupt` with records that do not fit."""
    # A record that ends with a carriage return is from a file with such line ends, in cells as well.
    plain = F.expr("replace(substring(text, 1, length(text) - 1), '\\r\\n', '\\n')")
    text = F.when(F.endswith("text", F.lit("\r")), plain).otherwise(F.col("text")).alias("text")
    lines = lines_of(spark, paths)
    starts = checkpointed(starts_of_parts(functions_of_parts(lines)))
    found = _records(lines, starts).select("record", text)
    options = {"escape": '"', "mode": "PERMISSIVE"}
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    # The first records are known from the first pass, but for one that goes on in the second part of its file.
    first = starts.where("part = 0")
    if first.where("head IS NULL").isEmpty():
        heads = first.select(F.col("head").alias("text")).select(text)
    else:
        heads = found.where("record = 1").select("text")
    heads = heads.select(F.from_csv("text", schema, options).alias("r")).distinct()
    wrong = heads.where(F.array(*[F.col("r").getField(c) for c in columns]) != F.array(*map(F.lit, columns)))
    for row in wrong.limit(1).collect():
        raise ValueError(f"the header is {tuple(row.r)}, expected {tuple(columns)}")
    rows = found.where("record > 1 AND text <> ''")
    options["columnNameOfCorruptRecord"] = corrupt
    # A generator parses every record once; as a column it would be parsed for every field that is asked for.
    return rows.select(F.inline(F.array(F.from_csv("text", f"{schema}, `{corrupt}` STRING", options))))
