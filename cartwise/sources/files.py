"""Reading transaction and feature files, and writing tables."""
from functools import reduce

from pyspark.sql import functions as F, types as T

from ..schemas import COLUMN_NAMES, FEATURES, MISSING_TOKENS, RAW_TRANSACTIONS, SOURCE_FILE
from ..staging import new_folder, run_together, written
from .quoted import read_quoted_csv

CORRUPT = "corrupt_record"
ID_COLUMNS = ("Customer ID",)
#: Files whose first lines are looked up at the same time.
HEADERS_AT_ONCE = 16


def read_csv(spark, paths, schema, timestamp_format=None, missing_tokens=MISSING_TOKENS,
             whole_columns=(), multi_line=False, parse_once=False):
    """CSV with declared types: (good rows, lines that do not fit the schema).

    whole_columns hold numbers that must not have a fraction. multi_line reads records with
    quoted line breaks: True by one task per file, "parallel" by as many tasks as the files have parts.
    parse_once writes the parsed text to the shared folder, from where both results are read.

    Everything is read as text first, so that every spelling of "missing" becomes null
    before the types are applied. A value that fails its cast sends the line to the rejects.
    Times are ISO texts unless a pattern is given.
    """
    columns = [f"`{f.name}` STRING" for f in schema.fields] + [f"{CORRUPT} STRING"]
    if multi_line == "parallel":
        text = read_quoted_csv(spark, paths, [f.name for f in schema.fields], CORRUPT)
    else:
        text = (
            spark.read.schema(", ".join(columns))
            .option("header", True).option("enforceSchema", False).option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", multi_line)
            .csv(paths)
        )

    def present(name):
        value = F.col(f"`{name}`")
        return F.when(~value.isin(*missing_tokens), value)

    def typed(field):
        if timestamp_format and field.dataType.typeName() == "timestamp_ntz":
            parsed = F.try_to_timestamp(present(field.name), F.lit(timestamp_format))
            return parsed.cast("timestamp_ntz")
        return present(field.name).try_cast(field.dataType)

    failed = F.array_compact(F.array(*[
        F.when(present(f.name).isNotNull() & (typed(f).isNull() | (
            ~_integral(typed(f)) if f.name in whole_columns else F.lit(False))), F.lit(f.name))
        for f in schema.fields]))
    checked = text.withColumn("failed_columns", failed)
    if parse_once:
        folder = new_folder(spark, "parsed")
        checked.write.parquet(folder)
        checked = spark.read.schema(checked.schema).parquet(folder)
    bad = F.col(CORRUPT).isNotNull() | (F.size("failed_columns") > 0)
    good = checked.where(~bad).select(*[typed(f).alias(f.name) for f in schema.fields])
    return good, checked.where(bad)


def _header(spark, path):
    """Column names of a file (or of the files of a folder), as its first line has them."""
    return tuple(spark.read.option("header", True).option("escape", '"').csv(path).columns)


def read_parts(spark, paths, schema=SOURCE_FILE, **options):
    """Tables of the files (periods, or sheets of the source workbook), and all rejects.

    Files with the same header are read together, by one plan whatever their number; each
    order of columns is one table, aligned by name.
    """
    like, paths = {}, list(paths)
    headers = run_together(spark, lambda path: _header(spark, path), paths, HEADERS_AT_ONCE) if paths else []
    for path, header in zip(paths, headers):
        like.setdefault(header, []).append(path)
    fields = {f.name: f for f in schema.fields}
    both = []
    for names, own in like.items():
        if sorted(names) != sorted(fields):
            raise ValueError(f"the header of {own[0]} is {names}, expected {tuple(fields)} in any order")
        good, bad = read_csv(spark, own, T.StructType([fields[n] for n in names]), **options)
        both.append((good.select(*fields), bad.select(*fields, CORRUPT, "failed_columns")))
    return [good for good, _ in both], union_parts([bad for _, bad in both])


def union_parts(parts):
    """Rows of all parts, aligned by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merge_parts(parts):
    """Union of the parts without full-row duplicates (null equals null).

    The grouping is combined on the map side, so any number of copies of a row is cheap.
    """
    return union_parts(parts).dropDuplicates()


def merge_parts_counted(parts):
    """(merged rows, one row with rows_before, rows_after, rows_removed).

    Rows and their number of copies are written to the shared folder and both results read from there, so
    a stage that ran twice after a lost executor counts once.
    """
    union = union_parts(parts)
    folder = new_folder(union.sparkSession, "merged")
    union.groupBy(*union.columns).agg(F.count(F.lit(1)).alias("copies")).write.parquet(folder)
    written = union.sparkSession.read.parquet(folder)
    return written.drop("copies"), _rows_removed(written)


def _rows_removed(copies):
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("rows_removed"),
    )


def duplicates_removed(parts):
    """Rows before, rows after and rows removed, from one grouping."""
    union = union_parts(parts)
    return _rows_removed(union.groupBy(*union.columns).agg(F.count(F.lit(1)).alias("copies")))


def _integral(value):
    return value == F.floor(value)


def _as_decimal(df, column):
    """Exact value of an id; null and NaN are both missing."""
    value = F.col(f"`{column}`")
    return F.nullif(value.cast("string"), F.lit("NaN")).cast("decimal(38,6)")


def integral_ids(df, column="customer_id"):
    """Ids read as floats to nullable longs; a fractional id is an error, not a truncation."""
    value = _as_decimal(df, column)
    return df.withColumn(
        column,
        F.when(value.isNull(), F.lit(None).cast("long"))
        .when(_integral(value), value.cast("long"))
        .otherwise(F.raise_error(F.concat(F.lit(f"{column} is not integral: "),
                                          value.cast("string"))).cast("long")),
    )


def fractional_ids(df, column="customer_id"):
    """Rows whose id is not integral, to be set aside before integral_ids."""
    value = _as_decimal(df, column)
    return df.where(value.isNotNull() & ~_integral(value))


def to_raw_transactions(source):
    """Source column names and types to those of the base table."""
    renamed = source.withColumnsRenamed(COLUMN_NAMES)
    return integral_ids(renamed).to(RAW_TRANSACTIONS)


def read_transactions_csv(spark, paths, **options):
    """Base-table rows and rejected lines of source-format CSV files.

    A fractional customer id sends its line to the rejects.
    """
    good, bad = read_csv(spark, paths, SOURCE_FILE, whole_columns=ID_COLUMNS, **options)
    return to_raw_transactions(good), bad


def read_features(spark, path, schema=FEATURES, file_format="parquet"):
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if file_format == "csv" else reader.parquet(path)


def write_files(df, path, file_format="parquet"):
    writer = df.write.mode("overwrite")
    return writer.option("header", True).csv(path) if file_format == "csv" else writer.parquet(path)


def read_jdbc(spark, url, query, single_task=False, **options):
    """Result of a query in an external database (needs its JDBC driver on the classpath).

    Give partitionColumn, lowerBound, upperBound and numPartitions (with dbtable) for a
    parallel read; a read by one task must be asked for.
    """
    if not single_task and "partitionColumn" not in options:
        raise ValueError("give partition options for a parallel read, or single_task=True")
    reader = spark.read.format("jdbc").option("url", url)
    if "dbtable" not in options:
        reader = reader.option("query", query)
    return reader.options(**options).load()


# Lines of one order are next to each other within a file.
CLUSTERING = ("invoice_date", "invoice", "stock_code")
ROWS_PER_FILE = 20_000_000


def _write_lines(df, name, mode):
    """Deal lines out by month in partitions of the advisory size, sorted within a file.

    The rebalancing exchange reads nothing twice, divides a hot month and joins small ones, so
    the number of files follows the amount of data.
    """
    lines = df.to(RAW_TRANSACTIONS)
    month = F.date_format("invoice_date", "yyyyMM")
    (lines.withColumn("month", month).hint("rebalance", "month").drop("month")
     .sortWithinPartitions(*CLUSTERING)
     .write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).saveAsTable(name))


def create_base_table(df, name="raw_transactions"):
    """Create the typed base table, replacing an old one.

    The lines are clustered by date once here. Date filters then skip files and row groups,
    and grouping lines by order is almost finished before any shuffle.
    """
    _write_lines(df, name, "overwrite")


def interleaved(first, second, bits):
    """Bits of two numbers below 2^bits in turn, the highest of the first in front."""
    key = F.lit(0).cast("long")
    for i in range(bits):
        for number, place in ((second, 2 * i), (first, 2 * i + 1)):
            bit = F.shiftright(number.cast("long"), i).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, place))
    return key


def create_two_way_table(df, name="raw_transactions", bits=10):
    """Create the base table in an order that serves filters by date and filters by customer alike.

    Dates and customer ids are cut into 2^bits steps each, whose bits are interleaved; lines are dealt out and
    sorted by that key, so a file, and a row group in it, holds a short range of both. Lines without
    a customer come as if they had the smallest id. The loads by month stay cheaper: this one reads the lines
    twice and an append needs a new load.
    """
    lines = df.to(RAW_TRANSACTIONS)
    seconds = F.unix_seconds(F.col("invoice_date").cast("timestamp"))
    ends = lines.select(seconds.alias("t"), "customer_id").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("t", "customer_id") for n, f in (("min", F.min), ("max", F.max))]).first()

    def steps(value, column):
        low, high = ends[f"min_{column}"], ends[f"max_{column}"]
        if low is None or low == high:
            return F.lit(0)
        place = F.floor((value - low) / ((high - low + 1) / (1 << bits)))
        return F.coalesce(F.least(place, F.lit((1 << bits) - 1)), F.lit(0))

    key = interleaved(steps(seconds, "t"), steps(F.col("customer_id"), "customer_id"), bits)
    (lines.withColumn("z", key).repartitionByRange("z", *CLUSTERING).sortWithinPartitions("z", *CLUSTERING).drop("z")
     .write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).saveAsTable(name))


def files_that_may_hold(table, column, low, high):
    """(files whose values reach into the range, files): what a filter on the column has to open."""
    ends = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(column).alias("low"), F.max(column).alias("high"))
    reached = (F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high))
    return ends.agg(F.count_if(reached).alias("reached"), F.count(F.lit(1)).alias("files"))


def append_to_base_table(df, name="raw_transactions"):
    """Append rows; names and types must fit the declared schema."""
    _write_lines(df, name, "append")


def publish(df, name):
    """Replace a published table, also by rows that are read from it.

    The rows are written under another name first and take the table's place when they are complete; a
    reader finds the old or the new table, or for a moment none.
    """
    spark, complete = df.sparkSession, f"{name}__complete"
    df.write.mode("overwrite").saveAsTable(complete)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {complete} RENAME TO {name}")


def taken(name, spark):
    """The rows of a table, kept in the shared folder, and the table dropped."""
    rows = written(spark.table(name), "taken")
    spark.sql(f"DROP TABLE {name}")
    return rows


def append_rows(df, name):
    df.write.mode("append").saveAsTable(name)


def read_table(spark, name):
    return spark.table(name)


def row_count(df):
    return df.agg(F.count(F.lit(1)).alias("rows"))
