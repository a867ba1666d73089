"""Adding a period that overlaps the loaded table: lines that are there already are left out.

Beside the base table lies a filter: per month a Bloom filter of the lines' digests in words of 64 bits, a
row per word. A new line whose bits are not all set is certainly new. The few others are candidates; they
alone are compared with the base table, all columns and null equal to null, and only with the months that
they are from. The filter is a table like any other: a batch appends the words of its new lines, and
reading combines the words by OR.

The filter gets a batch's words before the base table gets its lines. If the job is lost in between, the
filter knows lines that are not there, which costs a comparison and no line.
"""
from datetime import date, timedelta

from pyspark.sql import functions as F

from ..functions.columns import as_time
from ..schemas import RAW_TRANSACTIONS
from ..staging import written
from .files import append_to_base_table, create_base_table

#: Lines to a word of 64 bits, and bits set for a line: one in some 40 new lines is a candidate.
LINES_PER_WORD, BITS = 8, 4


def filter_name(name):
    return f"{name}_filter"


def _keyed(lines):
    """The lines with month ('' without a date), digest and the bits of their word."""
    columns = [f.name for f in RAW_TRANSACTIONS.fields]
    bits = F.xxhash64(F.lit("bits"), *columns)
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63).cast("long"))
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int")))
    month = F.coalesce(F.date_format("invoice_date", "yyyy-MM"), F.lit(""))
    return lines.select("*", month.alias("month"), F.xxhash64(*columns).alias("digest"), mask.alias("mask"))


def _words(keyed, sizes):
    """(month, words, word, bits) of lines; sizes: (month, words), a row per month, so the lines stay in place."""
    return (keyed.join(F.broadcast(sizes), "month")
            .groupBy("month", "words", F.pmod(F.col("digest"), F.col("words")).alias("word"))
            .agg(F.bit_or("mask").alias("bits")))


def _sizes(keyed):
    """Words for the filter of each month."""
    return keyed.groupBy("month").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / LINES_PER_WORD)).cast("long").alias("words"))


def create_filtered_table(lines, name="raw_transactions"):
    """Create the base table and its filter."""
    create_base_table(lines, name)
    keyed = _keyed(lines.sparkSession.table(name))
    _words(keyed, _sizes(keyed)).write.mode("overwrite").saveAsTable(filter_name(name))


def candidates(keyed, known):
    """The lines, distinct, with `maybe`: whether the filter cannot rule out that they are there."""
    words = known.groupBy("month", "words", "word").agg(F.bit_or("bits").alias("bits"))
    sizes = known.groupBy("month").agg(F.max("words").alias("words"))
    placed = keyed.dropDuplicates().join(F.broadcast(sizes), "month", "left").withColumn(
        "word", F.pmod(F.col("digest"), F.col("words")))
    return placed.join(words, ["month", "words", "word"], "left").withColumn(
        "maybe", F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    ).drop("bits", "word")


def in_months(months):
    """Condition on invoice_date for months given as 'yyyy-MM', neighbours as one range; '' is no date."""
    starts = sorted(date.fromisoformat(f"{m}-01") for m in months if m)
    ranges = []
    for start in starts:
        end = (start + timedelta(days=31)).replace(day=1)
        if ranges and ranges[-1][1] == start:
            ranges[-1][1] = end
        else:
            ranges.append([start, end])
    moment = F.col("invoice_date")
    condition = moment.isNull() if "" in months else F.lit(False)
    for start, end in ranges:
        condition = condition | ((moment >= as_time(f"{start} 00:00:00")) & (moment < as_time(f"{end} 00:00:00")))
    return condition


def not_there(maybe, base):
    """Those of the lines that the base table does not have; reads only the months that they are from."""
    months = [r.month for r in maybe.select("month").distinct().collect()]  # months of one batch
    columns = [f.name for f in RAW_TRANSACTIONS.fields]
    old = base.where(in_months(months)).select(
        F.xxhash64(*columns).alias("old_digest"), *[F.col(c).alias(f"old_{c}") for c in columns])
    same = F.col("digest") == F.col("old_digest")
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    return maybe.join(old, same, "left_anti")


def append_new_lines(lines, name="raw_transactions"):
    """Append the lines that the table does not have, each once, and return how many."""
    spark = lines.sparkSession
    keyed = _keyed(lines.to(RAW_TRANSACTIONS).dropDuplicates())
    # Month, digest and mask follow from the columns and are not written.
    checked = _keyed(written(candidates(keyed, spark.table(filter_name(name))).drop("month", "digest", "mask"), "checked"))
    late = written(not_there(checked.where("maybe"), spark.table(name)), "late")
    new = checked.where("NOT maybe").unionByName(late)
    # A month that the filter has keeps its size.
    sizes = new.groupBy("month").agg(F.coalesce(
        F.max("words"), F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / LINES_PER_WORD)).cast("long")).alias("words"))
    _words(new.drop("words"), sizes).write.mode("append").saveAsTable(filter_name(name))
    append_to_base_table(new.select(*[f.name for f in RAW_TRANSACTIONS.fields]), name)
    return new.count()
