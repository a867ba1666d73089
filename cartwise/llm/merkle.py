"""Merkle manifest of a table: every row's proof up to one root, by a butterfly exchange.

A row is a leaf. The leaves of a source, in order of their id, form a tree in which every FANOUT
consecutive nodes have their digest as parent; the roots of the sources, in order of the source, form
the tree above. All of it is DataFrame functions:

1. Leaves are sorted into runs (a range exchange of digests, never of texts), and the place of a leaf
   in its source is its place in the run plus the sizes of the runs before.
2. FANOUT**HEIGHT consecutive leaves, from a multiple of that number on, are a partition: one row that
   holds their subtree.
3. Butterfly: in round r the subtrees of FANOUT**r partitions stand in groups of FANOUT. Partitions with
   the same place in the subtrees of a group swap roots, and each of them hashes the common parent
   itself. After the last round every partition knows its proof and the root; nothing is handed down
   again. Where the last subtree has fewer partitions, its members serve several partners.

A group has at most FANOUT members in every round, however many rows a source has. Each round moves one
narrow row per partition.

Columns count as null or value; null ids come first, the null source is a source of its own and the
first. Rows that repeat an id are leaves in the order of their digest. Empty and very long texts are
values like any other, other columns are not looked at. An empty table has no rows and no root.
"""
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..staging import checkpointed, new_folder
from .common import apart

FANOUT = 3
#: Levels within a partition: 729 leaves.
HEIGHT = 6
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left:string,right:string>"


def field(value):
    """A column as a leaf has it: `-` if null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns):
    return F.sha2(F.concat(*map(field, columns)), 256)


def folded(start, path):
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step.left, node, step.right), 256))


def siblings(path):
    """All siblings of a path, from the leaf up and left to right, as one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step.left, step.right)), "")


def _levels(total):
    """Levels above `total` leaves."""
    powers = F.array(*[F.lit(FANOUT ** d) for d in range(39)])
    return F.size(F.filter(powers, lambda p: p < total))


def _parents(nodes):
    last = ((F.size(nodes) - 1) / FANOUT).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(
        F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), ""), 256))


def placed(leaves, order):
    """The leaves with `place` in their group `grp` (from 0) and `total`, the leaves of the group.

    Equal leaves are dealt out by the salt, so that copies of one row do not end in one run.
    """
    spark, folder = leaves.sparkSession, new_folder(leaves.sparkSession, "merkle-runs")
    keys = ["grp", *order, "leaf", "salt"]
    runs = (leaves.withColumn("salt", F.monotonically_increasing_id())
            .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt")
            # The upper bits are the number of the run, the lower ones the place in it.
            .withColumn("at", F.monotonically_increasing_id()))
    runs.write.parquet(folder)
    rows = spark.read.schema(runs.schema).parquet(folder).withColumn("run", F.shiftright("at", 33))
    spans = rows.groupBy("grp", "run").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    runs_before = Window.partitionBy("grp").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "grp", "run", "first", F.coalesce(F.sum("n").over(runs_before), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("grp")).alias("total"))
    return (rows.join(apart(spans), ["grp", "run"])
            .withColumn("place", F.col("at") - F.col("first") + F.col("before"))
            .drop("at", "run", "first", "before"))


def partitions(leaves, order, height=HEIGHT):
    """Write (grp, block, total, entries, levels), a row per partition, and return the table.

    entries: the other columns of the leaves in order; levels: the digests of the subtree, leaves first.
    """
    spark, folder = leaves.sparkSession, new_folder(leaves.sparkSession, "merkle-partitions")
    carried = [c for c in leaves.columns if c not in ("grp", "leaf")]
    held = F.sort_array(F.collect_list(F.struct("place", "leaf", F.struct(*carried).alias("row"))))
    blocks = (placed(leaves, order)
              .groupBy("grp", F.expr(f"place div {FANOUT ** height}").alias("block"))
              .agg(F.first("total").alias("total"), held.alias("held")))
    up = F.slice(F.sequence(F.lit(1), F.lit(max(height, 1))), 1, F.least(F.lit(height), _levels(F.col("total"))))
    levels = F.aggregate(up, F.array(F.col("held.leaf")), lambda done, _: F.concat(
        done, F.array(_parents(F.element_at(done, -1)))))
    table = blocks.select("grp", "block", "total", F.col("held.row").alias("entries"), levels.alias("levels"))
    table.write.parquet(folder)
    return spark.read.schema(table.schema).parquet(folder)


def swapped(parts, size):
    """One round: subtrees of `size` partitions meet in groups, and their common root replaces them.

    parts: (grp, block, count, root, path). Groups that are one subtree already stay as they are.
    """
    node, low = F.expr(f"block div {size}"), F.col("block") % size
    last = F.expr(f"(count - 1) div {size}")
    members = F.when(node == last, F.col("count") - last * size).otherwise(size)
    places = F.when(F.col("count") > size, F.sequence(low, F.lit(size - 1).cast("long"), members)).otherwise(
        F.array(F.col("block")))
    sent = parts.select("*", F.explode(places).alias("to")).select(
        "grp", F.expr(f"block div {size * FANOUT}").alias("parent"), "to", F.struct(
            (node % FANOUT).alias("digit"), "root", (F.col("to") == F.when(F.col("count") > size, low)
                                                      .otherwise(F.col("block"))).alias("own"),
            "block", "count", "path").alias("member"))
    met = sent.groupBy("grp", "parent", "to").agg(F.collect_list("member").alias("met"))  # at most FANOUT
    both = met.select("grp", F.sort_array("met").alias("met")).select(
        "grp", "met", F.explode(F.filter("met", lambda m: m.own)).alias("me"))

    def roots(wanted):
        return F.array_join(F.transform(F.filter("met", wanted), lambda m: m.root), "")

    rows = both.select("grp", "me.*", roots(lambda m: m.digit < F.col("me.digit")).alias("left"),
                       roots(lambda m: m.digit > F.col("me.digit")).alias("right"))
    goes_up = F.col("count") > size
    return rows.select(
        "grp", "block", "count",
        F.when(goes_up, F.sha2(F.concat("left", "root", "right"), 256)).otherwise(F.col("root")).alias("root"),
        F.when(goes_up, F.concat("path", F.array(F.struct("left", "right")))).otherwise(F.col("path"))
        .alias("path"))


def paths(table, height=HEIGHT):
    """(grp, block, root, path): for every partition the root of its group and the way to it."""
    width = FANOUT ** height
    parts = table.select(
        "grp", "block", F.expr(f"(total + {width - 1}) div {width}").alias("count"),
        F.element_at(F.element_at("levels", -1), 1).alias("root"),
        F.expr(f"cast(array() as array<{_STEP}>)").alias("path"))
    most = parts.agg(F.max("count")).first()[0] or 1
    alone, several, size = parts.where("count = 1"), parts.where("count > 1"), 1
    while size < most:
        several = swapped(several, size)
        size *= FANOUT
    done = alone if size == 1 else alone.unionByName(several)
    return checkpointed(done.drop("count"))


def expanded(table, known, height=HEIGHT):
    """The leaves with what they carry: leaf, root and the whole path."""
    rows = table.join(apart(known), ["grp", "block"]).select(
        "*", F.posexplode("entries").alias("i", "row"))

    def step(level):
        at = F.expr(f"i div {FANOUT ** level}").cast("int")
        first = at - at % FANOUT
        nodes = F.get(F.col("levels"), F.lit(level))
        return F.when(F.size("levels") > level + 1, F.struct(
            F.array_join(F.slice(nodes, first + 1, at - first), "").alias("left"),
            F.array_join(F.slice(nodes, at + 2, first + FANOUT - 1 - at), "").alias("right")))

    inner = F.array_compact(F.array(*map(step, range(height)))) if height else F.array()
    extra = [c for c in known.columns if c not in ("grp", "block", "path")]
    return rows.select(
        "grp", "row.*", F.get(F.get(F.col("levels"), F.lit(0)), F.col("i")).alias("leaf"), *extra,
        F.concat(inner.cast(f"array<{_STEP}>"), "path").alias("path"))


def manifest(leaves, id_col="doc_id", group_col="source", height=HEIGHT):
    """leaves (with a column `leaf`) with subroot, root and path, an array of (left, right) siblings.

    Other columns are carried along.
    """
    # Sources as text that sorts null first and cannot clash with a value.
    key = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    others = [c for c in leaves.columns if c != "leaf"]
    inner = leaves.select(key.alias("grp"), "leaf", F.col(id_col).alias("id"), F.struct(*others).alias("kept"))
    table = partitions(inner, ["id"], height)
    known = paths(table, height)
    tops = known.where("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("id"), F.col("root").alias("leaf"))
    top_table = partitions(tops, ["id"], height)
    above = expanded(top_table, paths(top_table, height), height).select(
        F.col("id").alias("grp"), F.col("leaf").alias("subroot"), F.col("root").alias("top"),
        F.col("path").alias("rest"))
    complete = known.join(apart(above), "grp").select(
        "grp", "block", "subroot", F.col("top").alias("root"), F.concat("path", "rest").alias("path"))
    return expanded(table, complete, height).select("kept.*", "leaf", "subroot", "root", "path")


def op13_merkle(spark, sf_dir):
    """Proof of every document, and what a document that lost its line ends folds to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = [F.col(c) for c in COLUMNS]
    changed = leaf(*columns[:-1], F.translate("text", "\n", ""))
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    leaves = docs.select("doc_id", "source", leaf(*columns).alias("leaf"),
                         F.when(tampered, changed).alias("changed"))
    proved = manifest(leaves)
    result = proved.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings("path"), 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), "path").alias("folded_root"))
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))


_LEAF = " || ".join(
    f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in (*COLUMNS[:-1], "{text}"))

# The polynomial and the mask of CRC-32.
OP13_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(coalesce(doc_id::VARCHAR, ''), ''),
      lambda c: CASE WHEN c = '' THEN []::BIGINT[] ELSE [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] END))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT)
                 ELSE a >> 1 END) & 1 = 1 AS even
  FROM documents
), hashed AS (
  SELECT doc_id, source, sha256({_LEAF.format(text="text")}) AS leaf,
         CASE WHEN even THEN sha256({_LEAF.format(text="replace(text, chr(10), '')")}) END AS changed
  FROM crc
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS total FROM hashed
), nodes AS (
  SELECT source, 0 AS level, place AS idx, leaf AS hash, total AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY source, level, idx // 3, n
), tops AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, hash,
         count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (n + 2) // 3
  FROM tops WHERE n > 1 GROUP BY level, idx // 3, n
), steps AS (
  SELECT a.source, a.level, a.idx, coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '')
         AS lft, coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rgt
  FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level
       AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY ALL
), top_steps AS (
  SELECT a.level, a.idx, coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '')
         AS lft, coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rgt
  FROM tops a JOIN tops b ON a.level = b.level AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY ALL
), sources AS (
  SELECT source, hash AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx
  FROM nodes WHERE n = 1
), path AS (
  SELECT l.source, l.place, s.level, s.lft, s.rgt
  FROM leaves l JOIN steps s ON l.source IS NOT DISTINCT FROM s.source
       AND s.idx = l.place // (3 ** s.level)::BIGINT
  UNION ALL
  SELECT l.source, l.place, 1000 + t.level, t.lft, t.rgt
  FROM leaves l JOIN sources g ON l.source IS NOT DISTINCT FROM g.source
  JOIN top_steps t ON t.idx = g.idx // (3 ** t.level)::BIGINT
), proofs AS (
  SELECT source, place, string_agg(lft || rgt, '' ORDER BY level) AS proof,
         list(lft || '|' || rgt ORDER BY level) AS steps FROM path GROUP BY source, place
), result AS (
  SELECT l.doc_id, l.leaf, g.subroot, (SELECT hash FROM tops WHERE n = 1) AS root,
         sha256(coalesce(p.proof, '')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(l.changed, l.leaf), coalesce(p.steps, [])),
           lambda a, b: sha256(split_part(b, '|', 1) || a || split_part(b, '|', 2))) AS folded_root
  FROM leaves l JOIN sources g ON l.source IS NOT DISTINCT FROM g.source
  LEFT JOIN proofs p ON l.source IS NOT DISTINCT FROM p.source AND l.place = p.place
)
SELECT *, folded_root = root AS verified FROM result
"""
