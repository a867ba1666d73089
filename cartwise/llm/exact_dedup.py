"""Exact deduplication with an extendible-hash index on shared files.

Texts are equal when they are identical after each run of ASCII white space became one space. The
index maps the 64-bit hash of the normalised text to its documents:

1. Hashes are counted (partial sums before the shuffle, so a group of copies is one entry per task).
2. The directory: its depth doubles until no bucket holds more than `capacity` entries; a bucket is
   split only if it is overfull itself, so buckets have depths of their own. Counts per prefix of
   MAX_DEPTH bits give all depths at once. It has at most 2**MAX_DEPTH rows and is broadcast.
3. Every document is written to its bucket in the shared folder, a folder per bucket, in order of
   the hash. The normalised text goes along only where a hash occurs more than once. Buckets of any
   size are dealt out in bounded parts.
4. In a bucket, rows of one hash are chained by comparing their texts byte by byte: grouping by
   (hash, text) with partial sums first, then a join that may split a hot chain over tasks.

Null text counts as empty. Of equal texts the smallest id stays, null ids last; of rows repeated with
that id exactly one stays. An empty table gives an empty result.
"""
from functools import reduce

from pyspark.sql import functions as F

from ..staging import checkpointed, new_folder
from .common import apart, id_and_text

CAPACITY = 16_384
MAX_DEPTH = 12


def normalised(text):
    """Each run of ASCII white space becomes one space; single spaces are not touched."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def directory(hashes, capacity=CAPACITY, max_depth=MAX_DEPTH):
    """(prefix, bucket) for every prefix of max_depth bits among the distinct hashes `h`.

    A bucket of depth d and leading bits b is numbered 2**d + b.
    """
    prefix = F.shiftrightunsigned("h", 64 - max_depth).alias("prefix")
    counts = hashes.groupBy(prefix).agg(F.count(F.lit(1)).alias("entries"))
    depths = counts.select(
        "prefix", "entries", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")
    ).withColumn("bucket", F.expr(f"shiftleft(1L, depth) + shiftright(prefix, {max_depth} - depth)"))
    fitting = (depths.groupBy("bucket", "depth").agg(F.sum("entries").alias("held"))
               .where((F.col("held") <= capacity) | (F.col("depth") == max_depth)))
    # Numbers grow with the depth: the smallest is the bucket reached first.
    return (depths.join(fitting.select("bucket"), "bucket")
            .groupBy("prefix").agg(F.min("bucket").alias("bucket")))


def build_index(docs, folder, capacity=CAPACITY, id_col="doc_id", text_col="text"):
    """Write the index of the documents to the folder and return it."""
    spark = docs.sparkSession
    text = normalised(F.col("text"))
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", "text", F.xxhash64(text).alias("h"), F.sha2(text, 256).alias("text_sha256"))
    entries = checkpointed(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")))
    table = F.broadcast(directory(entries, capacity))  # at most 2**MAX_DEPTH rows
    placed = (
        rows.join(entries, "h")
        .select("h", "n", "doc_id", "text_sha256",
                F.when(F.col("n") > 1, text).alias("text"),
                F.shiftrightunsigned("h", 64 - MAX_DEPTH).alias("prefix"))
        .join(table, "prefix").drop("prefix"))
    (placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "h")
     .write.partitionBy("bucket").parquet(folder))
    schema = placed.select("h", "n", "doc_id", "text_sha256", "text", "bucket").schema
    # The place in the index files tells repeated rows apart, and is the same in every read.
    place = F.struct("_metadata.file_name", "_metadata.row_index").alias("row")
    return spark.read.schema(schema).parquet(folder).select("*", place)


def decide(docs, capacity=CAPACITY, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, h (hash of the text)."""
    index = build_index(docs, new_folder(docs.sparkSession, "exact-index"), capacity, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    single = index.where("n = 1").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", "h")
    shared = index.where("n > 1")
    chains = shared.groupBy("bucket", "h", "text").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
    chained = shared.join(apart(chains), ["bucket", "h", "text"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256", "h")
    return reduce(lambda a, b: a.unionByName(b), [single, chained])


def keep_first(docs, id_col="doc_id", text_col="text"):
    """The rows that stay, with all their columns."""
    kept = (decide(docs, id_col=id_col, text_col=text_col).where("kept")
            .select(F.col("doc_id").alias("kept_id"), F.col("h").alias("kept_h")))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"),
                       F.xxhash64(normalised(F.coalesce(text_col, F.lit("")))).alias("h"),
                       F.monotonically_increasing_id().alias("place"))
    same = (F.col("h") == F.col("kept_h")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    # Rows that repeat an id with its text are one document: the first of them by its place in the input.
    return (rows.join(kept, same, "left_semi").groupBy("doc_id", "h")
            .agg(F.min_by("row", "place").alias("row")).select("row.*"))


def op3_exact_dedup(spark, sf_dir):
    """Decision about every document."""
    return decide(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("h")


OP3_SQL = """
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm
  FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""
