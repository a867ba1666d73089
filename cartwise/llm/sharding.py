"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a table of prime size in an order of its own,
(offset + j * skip) mod size with offset and skip from its name. Shards take turns, and at its turn
a shard claims the free slot it prefers most. All shards own the same number of slots but for one,
and when a shard leaves, most slots stay where they are. A key is hashed to a slot; the table is
broadcast (its size is a parameter, not the data), so placement is one lookup per row and no shuffle.

The turns are a fold over the table in SQL. It looks at size * size preferences in one task, so
the size is limited to MAX_SIZE; it should be about a hundred times the number of shards.

A null key is placed like the empty string. Repeated keys have the same shard. Any other columns of
the input are left out of the result; an empty table gives an empty result.
"""
from pyspark.sql import functions as F

SHARDS = 32
SIZE = 3203
MAX_SIZE = 20_011


def _hash(salt, value):
    """60 bits of the MD5 of a salted string."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), value).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def is_prime(n):
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(spark, names, size=SIZE):
    """(slot, shard): the shard that owns each of the `size` slots, as an index into names."""
    names = list(names)
    if not names or len(set(names)) < len(names):
        raise ValueError("shards need names, each only once")
    if not is_prime(size) or not len(names) <= size <= MAX_SIZE:
        raise ValueError(f"the size must be a prime from the number of shards up to {MAX_SIZE}")
    steps = (spark.range(1).select(F.posexplode(F.array(*map(F.lit, names))).alias("shard", "name"))
             .select("shard", (_hash("offset:", F.col("name")) % size).cast("int").alias("offset"),
                     (_hash("skip:", F.col("name")) % (size - 1) + 1).cast("int").alias("skip")))
    wanted = steps.groupBy().agg(F.array_sort(F.collect_list(F.struct(
        "shard", F.expr(f"transform(sequence(0, {size - 1}), j -> "
                        f"cast((offset + cast(j as long) * skip) % {size} as int))").alias("slots")
    ))).alias("preferences"))

    def turn(owners, number):
        shard = (number % len(names)).cast("int")
        slots = F.col("preferences")[shard]["slots"]
        free = F.filter(slots, lambda slot: owners[slot] < 0)[0]
        # transform over an array of one binds the slot, so that it is looked for once.
        return F.transform(F.array(free), lambda slot: F.concat(
            F.slice(owners, 1, slot), F.array(shard),
            F.slice(owners, slot + 2, F.lit(size))))[0]

    owners = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)),
                         F.array_repeat(F.lit(-1), size), turn)
    return wanted.select(F.posexplode(owners).alias("slot", "shard"))


def assign(rows, names, key_col="doc_id", size=SIZE):
    """(key column, slot, shard, shard_name) of every row."""
    names = list(names)
    table = lookup_table(rows.sparkSession, names, size)
    table = table.withColumn("shard_name", F.array(*map(F.lit, names))[F.col("shard")])
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    slots = rows.select(F.col(key_col), (_hash("key:", key) % size).cast("int").alias("slot"))
    return slots.join(F.broadcast(table), "slot").select(key_col, "slot", "shard", "shard_name")


def shard_names(count=SHARDS):
    return [f"shard-{i:05d}" for i in range(count)]


def op1_sharding(spark, sf_dir):
    """Shard of every document."""
    return assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), shard_names())


OP1_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT i::INTEGER AS shard, 'shard-' || lpad(i::VARCHAR, 5, '0') AS name FROM range({SHARDS}) r(i)
), steps AS (
  SELECT shard, name,
         ('0x' || substr(md5('offset:' || name), 1, 15))::BIGINT % {SIZE} AS first,
         ('0x' || substr(md5('skip:' || name), 1, 15))::BIGINT % {SIZE - 1} + 1 AS skip
  FROM shards
), preferences AS (
  SELECT shard, list_transform(range({SIZE}), lambda j: (first + j * skip) % {SIZE}) AS slots FROM steps
), turns AS (
  SELECT 0 AS number, list_transform(range({SIZE}), lambda j: -1) AS owners
  UNION ALL
  SELECT number + 1, list_transform(owners, lambda o, i: CASE WHEN i - 1 = pick THEN shard ELSE o END)
  FROM (SELECT number, owners, shard, list_filter(slots, lambda s: owners[s + 1] = -1)[1] AS pick
        FROM turns JOIN preferences ON shard = number % {SHARDS} WHERE number < {SIZE})
), lookup AS (
  SELECT unnest(range({SIZE}))::INTEGER AS slot, unnest(owners)::INTEGER AS shard
  FROM turns WHERE number = {SIZE}
)
SELECT doc_id, slot, shard, name AS shard_name
FROM (SELECT doc_id, (('0x' || substr(md5('key:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT
                      % {SIZE})::INTEGER AS slot FROM documents) d
JOIN lookup USING (slot) JOIN shards USING (shard)
"""
