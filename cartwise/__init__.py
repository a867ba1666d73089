"""Customer analytics for retail transactions, written as Spark DataFrame operators."""
