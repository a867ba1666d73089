"""Small document tables with columns whose names clash with what the operators make."""
CLASHING = ("score", "kept", "h", "n", "bucket", "prefix", "fp", "key", "slot", "words", "first", "row",
            "id", "kept_id", "span_id", "spans", "text_number", "place", "grp", "leaf", "failures", "lines",
            "__id", "__h_row", "__text_number")


def documents(spark, rows):
    """Rows (doc_id, text) as a table like documents, with clashing columns beside."""
    full = [(i, t, "en", "src0", len(t or ""), *["x"] * len(CLASHING)) for i, t in rows]
    extra = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(
        full, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


def empty(spark):
    return documents(spark, [])


def words(n, seed=0, size=5000):
    """n words that hardly repeat in order."""
    import random
    own = random.Random(seed)
    return " ".join(f"w{own.randrange(size)}{chr(97 + own.randrange(26))}" for _ in range(n))
