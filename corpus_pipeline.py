"""From raw documents to packed training sequences.

Each stage gets what the one before kept, written as Parquet and read again, and works on all of it.
All but the last return the columns of documents.
"""
from pyspark.sql import functions as F

from cartwise.llm import exact_dedup, packing, quality, simhash, substring_dedup
from cartwise.staging import new_folder


def good_documents(spark, docs, sf_dir):
    """Quality classifier: documents that it rejects go."""
    return quality.keep_good(spark, docs, sf_dir)


def distinct_texts(spark, docs, sf_dir):
    """Exact deduplication: of equal texts the smallest id stays."""
    return exact_dedup.keep_first(docs)


def distinct_fingerprints(spark, docs, sf_dir):
    """SimHash near-duplicates: of each group the smallest id stays."""
    return simhash.keep_one(docs)


def without_repeats(spark, docs, sf_dir):
    """Substring deduplication: repeated spans leave the texts, and n_chars follows."""
    return substring_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark, docs, sf_dir):
    """Packing: pieces of documents in sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", distinct_texts),
    ("simhash_near_dedup", distinct_fingerprints),
    ("substring_dedup", without_repeats),
    ("packing", packed),
]

# The classifier, the fingerprints and the tokenizer have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of a folder; the last stage's rows."""
    folder = new_folder(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return result
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
