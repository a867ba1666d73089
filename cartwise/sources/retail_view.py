"""Invoice lines derived from the star-schema test tables (orders, lineitem, part, supplier, nation)."""
from pyspark.sql import functions as F

# The country that plays the home country in this data.
HOME_COUNTRY = "NATION_11"

# Columns of the test tables that are read. A declared schema spares a look into every file.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, "
                "l_extendedprice double, l_returnflag string",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "part": "p_partkey long, p_name string",
    "supplier": "s_suppkey long, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def raw_transactions(spark, sf_dir):
    """The base table: one row per line item, with returns turned into cancellation invoices.

    No join is hinted: Spark broadcasts a dimension only while it is below its size
    threshold and falls back to a shuffled join, with skew handling, above it.
    """
    def table(name):
        return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    lines = (
        table("lineitem")
        .join(table("orders"), F.expr("l_orderkey = o_orderkey"))
        .join(table("part"), F.expr("l_partkey = p_partkey"))
        .join(table("supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(table("nation"), F.expr("s_nationkey = n_nationkey"))
    )
    return lines.selectExpr(
        "concat(if(l_returnflag = 'R', 'C', ''), o_orderkey) AS invoice",
        "CASE l_partkey % 50 WHEN 0 THEN 'POST' WHEN 1 THEN 'M' ELSE string(l_partkey) END AS stock_code",
        "p_name AS description",
        "int(if(l_returnflag = 'R', -l_quantity, l_quantity)) AS quantity",
        "timestampadd(SECOND, o_orderkey * 7919 % 86400, o_orderdate) AS invoice_date",
        "if(l_partkey % 50 = 2, 0.0D, l_extendedprice / l_quantity) AS price",
        "if(o_orderkey % 5 = 0, NULL, o_custkey) AS customer_id",
        "n_name AS country",
    )
