"""The registered queries of the subpackage, and the SQL of those that SQL can express."""
from . import (bpe, exact_dedup, hard_negatives, licenses, merkle, packing, quality, quality_rules, sharding,
               simhash, substring_dedup, topk, toxicity)

QUERIES = {f.__name__: f for f in (
    sharding.op1_sharding, substring_dedup.op2_substring_dedup, exact_dedup.op3_exact_dedup,
    packing.op4_packing, quality.op5_quality, simhash.op6_simhash, licenses.op7_licenses,
    bpe.op8_bpe, topk.op9_topk, toxicity.op10_toxicity,
    hard_negatives.op11_hard_negatives, quality_rules.op12_quality_rules, merkle.op13_merkle)}

ORACLE = {
    "op1_sharding": sharding.OP1_SQL,
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op7_licenses": licenses.OP7_SQL,
    "op9_topk": topk.OP9_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_quality_rules": quality_rules.OP12_SQL,
    "op13_merkle": merkle.OP13_SQL,
}
