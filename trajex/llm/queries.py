"""The queries of this package by name, and the SQL of those SQL can express.

Without SQL (tested against brute force, round trips or held-out labels):
op1 and op5 (tokenisers), op2, op3, op7 and op9 (trained or fitted verdicts),
op6 (keyed permutations), op8 (shingle hashes, components), op12 (checksums of
word runs) and op13 (recursive splits).
"""

from __future__ import annotations

from trajex.llm import (bpe, exact_dedup, html_extract, mixing, pii, quality, resampling, search, sharding, simhash, token_counts,
                        toxicity, warc)

QUERIES = {
    "op1_token_counts": token_counts.op1,
    "op2_html_extraction": html_extract.op2,
    "op3_pii": pii.op3,
    "op4_exact_dedup": exact_dedup.op4,
    "op5_byte_bpe": bpe.op5,
    "op6_source_mixing": mixing.op6,
    "op7_quality_rules": quality.op7,
    "op8_simhash_near_dedup": simhash.op8,
    "op9_toxicity": toxicity.op9,
    "op10_warc": warc.op10,
    "op11_lexical_search": search.op11,
    "op12_importance_resampling": resampling.op12,
    "op13_sharding": sharding.op13,
}

SQL = {"op4_exact_dedup": exact_dedup.OP4_SQL, "op10_warc": warc.OP10_SQL, "op11_lexical_search": search.OP11_SQL}
