"""Quality rules as a ledger of bits.

Every rule is a condition on measurements of the whole text. A pass over the texts takes the measurements
and evaluates every rule once; the ledger keeps both, the failures as one number with a bit per rule. What
is done with them is a policy: a named version says which rules reject by themselves and how many of some
others a document may fail. Policies are applied to the ledger by its bits, so a new version reads no text,
and an ablation is an aggregation: documents are counted by their failures, and every rule is taken out of
the policy in turn by its bit. There are never more distinct failures than sets of rules, however many
documents share one, and they are counted before they are shuffled.

All of it is SQL functions, a document in one row, nothing is shuffled for the ledger. Windows of words are
compared by 64-bit hashes within their document.

Null text has no words. Texts without words have measurements of zero and fail `few_words`. Null and
repeated ids pass through with their rows; other columns are not looked at. An empty table has an empty
ledger and an ablation without documents.
"""
from dataclasses import dataclass

from pyspark.sql import functions as F

from .common import id_and_text

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACE = "\t\n\x0b\f\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals",
            "n_letters", "n_letter_words")

# Conditions on the measurements. A rule's bit is its place, so new ones go to the end.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "capitals": "10 * n_capitals > 3 * n_letters",
    "few_letter_words": "10 * n_letter_words < 6 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "few_lines_differ": "10 * n_dup_lines > 3 * n_lines",
    "some_symbols": "100 * n_symbols > n_words",
}
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """Documents go that fail a rule of `reject`, or more than `allowed` of `counted`."""

    reject: tuple
    counted: tuple = ()
    allowed: int = 0


POLICIES = {
    "base": Policy(BASE),
    "v1": Policy((*BASE, "symbols", "capitals")),
    "v2": Policy((*BASE, "symbols", "capitals", "few_letter_words", "duplicate_lines"),
                 ("short_words", "long_words", "few_lines_differ", "some_symbols"), 2),
}
DEFAULT = "v2"


def mask(names, rules=RULES):
    """The number that has the bits of the rules named."""
    order = list(rules)
    return sum(1 << order.index(name) for name in set(names))


def _let(value, use):
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(hashes, window=WINDOW):
    """Words in windows whose hash occurs twice or more."""

    def count(starts):
        # Every start covers the words that the one before does not.
        zero = F.struct(F.lit(-window).alias("before"), F.lit(0).alias("n"))
        return F.aggregate(starts, zero, lambda done, at: F.struct(
            at.alias("before"), (done.n + F.least(F.lit(window), at - done.before)).alias("n")),
            lambda done: done.n)

    def repeated(ordered):
        def alike(x, i):
            return F.coalesce(F.get(ordered, i - 1).h == x.h, F.lit(False)) | F.coalesce(
                F.get(ordered, i + 1).h == x.h, F.lit(False))
        return F.sort_array(F.transform(F.filter(ordered, alike), lambda x: x.at))

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    return _let(F.sort_array(placed), lambda ordered: count(repeated(ordered)))


def measured(docs, id_col="doc_id", text_col="text"):
    """doc_id and the measurements of every row."""
    text = F.col("text")
    filled = F.translate(text, SPACE, " " * len(SPACE))
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", "text", F.filter(F.split(filled, " "), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE + " ", "") != "").alias("lines"))
    words, size = F.col("words"), F.size("words")
    hashes = F.when(size >= WINDOW, F.transform(
        F.sequence(F.lit(0), size - WINDOW),
        lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(WINDOW)))))
    rows = rows.select("*", F.coalesce(hashes, F.expr("cast(array() as array<bigint>)")).alias("hashes"))
    # Most texts repeat nothing: their windows are all distinct and need no order.
    repeats = F.when(F.size(F.array_distinct("hashes")) == F.size("hashes"), 0).otherwise(_covered(F.col("hashes")))
    found = {
        "n_words": size,
        "word_chars": F.length(F.translate(text, SPACE + " ", "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeats,
        "n_capitals": F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", "")),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")),
        "n_letter_words": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))),
    }
    return rows.select("doc_id", *(found[m].cast("long").alias(m) for m in MEASURES))


def ledger(docs, rules=RULES, id_col="doc_id", text_col="text"):
    """doc_id, the measurements and `failures`, with the bit of every rule that the text fails."""
    if len(rules) > 62:
        raise ValueError("a ledger has room for 62 rules")
    bits = [F.when(F.expr(rule), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
            for i, rule in enumerate(rules.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(docs, id_col, text_col).withColumn("failures", total)


def passes(failures, policy, rules=RULES):
    """Condition on a column of failures: the policy keeps the document."""
    failures = F.col(failures) if isinstance(failures, str) else failures
    hard = failures.bitwiseAND(F.lit(mask(policy.reject, rules)).cast("long")) == 0
    counted = F.bit_count(failures.bitwiseAND(F.lit(mask(policy.counted, rules)).cast("long")))
    return hard & (counted <= policy.allowed)


def applied(book, policy=DEFAULT, policies=POLICIES, rules=RULES):
    """The ledger with `policy` and `kept`, by the version named."""
    return book.select("*", F.lit(policy).alias("policy"), passes("failures", policies[policy], rules).alias("kept"))


def ablations(book, policies=POLICIES, rules=RULES):
    """Per version and rule of it: documents, failed, kept, kept_without (the rule), kept_alone (by it alone).

    A row with the rule null has the numbers of the whole version.
    """
    patterns = book.groupBy("failures").agg(F.count(F.lit(1)).alias("documents"))  # one row per set of rules
    cases = []
    for version, policy in policies.items():
        for name in (None, *policy.reject, *policy.counted):
            bit = F.lit(mask([name] if name else [], rules)).cast("long")
            rest = Policy(tuple(r for r in policy.reject if r != name),
                          tuple(r for r in policy.counted if r != name), policy.allowed)
            alone = Policy((name,) if name else ())
            cases.append(F.struct(
                F.lit(version).alias("policy"), F.lit(name).cast("string").alias("rule"),
                (F.col("failures").bitwiseAND(bit) != 0).alias("failed"),
                passes("failures", policy, rules).alias("kept"), passes("failures", rest, rules).alias("without"),
                passes("failures", alone, rules).alias("alone")))
    rows = patterns.select("documents", F.explode(F.array(*cases)).alias("c")).select("documents", "c.*")

    def documents(condition):
        return F.sum(F.when(F.col(condition), F.col("documents")).otherwise(0))

    return rows.groupBy("policy", "rule").agg(
        F.sum("documents").alias("documents"), documents("failed").alias("failed"),
        documents("kept").alias("kept"), documents("without").alias("kept_without"),
        documents("alone").alias("kept_alone"))


def op12_quality_rules(spark, sf_dir):
    """Measurements, failures and the verdict of the default policy about every document."""
    book = applied(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("failures", POLICIES["base"])).alias("base_failed"), "kept", "failures")


_BITS = " + ".join(f"(CASE WHEN {rule} THEN {1 << i} ELSE 0 END)" for i, rule in enumerate(RULES.values()))
_POLICY = POLICIES[DEFAULT]
OP12_SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM t
), windows AS (
  SELECT rid, i, words[i:i + 4] AS run FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM parts)
), often AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, run) > 1
), covered AS (
  SELECT rid, count(DISTINCT i + j) AS n FROM often, range(5) r(j) GROUP BY rid
), m AS (
  SELECT p.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         length(regexp_replace(text, '\\P{{Lu}}+', '', 'g')) AS n_capitals,
         length(regexp_replace(text, '\\P{{L}}+', '', 'g')) AS n_letters,
         len(list_filter(words, lambda x: regexp_matches(x, '\\p{{L}}'))) AS n_letter_words
  FROM parts p LEFT JOIN covered c USING (rid)
), f AS (
  SELECT *, ({_BITS})::BIGINT AS failures FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures,
       failures & {mask(BASE)} <> 0 AS base_failed,
       failures & {mask(_POLICY.reject)} = 0
         AND bit_count(failures & {mask(_POLICY.counted)}) <= {_POLICY.allowed} AS kept
FROM f
"""
