"""Column expressions used by several operators. All of them stay inside the JVM."""
from functools import reduce

from pyspark.sql import Column, functions as F

from ..schemas import HIGH_RISK, MEDIUM_RISK


def col(c):
    return F.col(c) if isinstance(c, str) else c


def as_time(value):
    """A moment without zone from a Column, an ISO text or a naive Python datetime.

    A datetime goes through its text: as a literal it would be read in the zone of the
    driver process.
    """
    if isinstance(value, Column):
        return value
    return F.lit(None if value is None else str(value)).cast("timestamp_ntz")


def days(n):
    return F.make_dt_interval(F.lit(n))


def elapsed_days(start, end):
    """Whole 24-hour units from start to end, independent of the session time zone."""
    return F.extract(F.lit("DAY"), col(end) - col(start)).cast("long")


def midnight(ts):
    return F.to_date(ts).cast("timestamp_ntz")


def month_start(ts):
    return F.trunc(F.to_date(ts), "month")


def exact_sum(amount):
    """Sum of amounts as decimals of six digits: exact, so independent of the order."""
    return F.sum(col(amount).try_cast("decimal(28,6)"))


def round_half_up(total, digits=0):
    """SQL rounding of an exact sum: half away from zero."""
    return F.round(total, digits).cast("double")


def round_total_half_even(total, digits=0):
    """An exact sum, half to even."""
    return F.bround(total, digits).cast("double")


def round_half_even(value, digits=0):
    """Any other number, half to even."""
    return F.bround(col(value), digits)


def ratio(a, b):
    """a / b as double; null where b is 0 or null."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def flag(condition):
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0).cast("int")


def risk_level(probability):
    """High / Medium / Low. Spark orders NaN above every number, so NaN is kept out by hand."""
    p = F.nanvl(col(probability), F.lit(0.0))
    return F.when(p >= HIGH_RISK, "High").when(p >= MEDIUM_RISK, "Medium").otherwise("Low")


def probability_band(probability):
    """Lower edge of the 0.1 wide band."""
    return F.floor(col(probability) * 10) / F.lit(10.0)


def position(column, values):
    """1-based position in a list of values; 0 for anything else."""
    found = F.array_position(F.array(*[F.lit(v) for v in values]), col(column))
    return F.coalesce(found, F.lit(0)).cast("long")


def lookup(column, labels):
    """Translate by a dictionary; an unknown key stays as it is."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[col(column)], col(column))


def label_of(flag_column, labels):
    """Text of a 0/1 flag."""
    return F.when(col(flag_column) == 0, labels[0]).when(col(flag_column) == 1, labels[1])


def sum_of(columns):
    return reduce(lambda a, b: a + b, columns)
