"""The registered queries of this subpackage, and their SQL."""

from millrace.llm import bpe, dedup_exact, knn, near_dup, packing, quality, secrets, suffix_dedup, token_counts, warc

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_packing": packing.op2_packing,
    "op3_top_k": knn.op3_top_k,
    "op4_bpe": bpe.op4_bpe,
    "op5_near_dup": near_dup.op5_near_dup,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_warc": warc.op7_warc,
    "op8_quality": quality.op8_quality,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_exact_dedup": dedup_exact.op10_exact_dedup,
}

#: The others are tokenizers, a compressor and a model, which SQL can't express.
SQL = {
    "op3_top_k": knn.OP3_SQL,
    "op5_near_dup": near_dup.OP5_SQL,
    "op7_warc": warc.OP7_SQL,
    "op9_suffix_dedup": suffix_dedup.OP9_SQL,
    "op10_exact_dedup": dedup_exact.OP10_SQL,
}
