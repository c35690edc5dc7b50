"""Queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import embedding_dedup, exact_dedup, language_id, lexical_search, minhash_dedup, mixing, pii, resampling, secret_scan, sentence_pieces, token_files, toxicity, warc


def queries() -> dict:
    return {
        "op1_secret_scan": secret_scan.op1_secret_scan,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_minhash_dedup": minhash_dedup.op3_minhash_dedup,
        "op4_pii": pii.op4_pii,
        "op5_sentencepiece": sentence_pieces.op5_sentencepiece,
        "op6_embedding_dedup": embedding_dedup.op6_embedding_dedup,
        "op7_warc": warc.op7_warc,
        "op8_token_files": token_files.op8_token_files,
        "op9_language_id": language_id.op9_language_id,
        "op10_mixing": mixing.op10_mixing,
        "op11_resampling": resampling.op11_resampling,
        "op12_lexical_search": lexical_search.op12_lexical_search,
        "op13_toxicity": toxicity.op13_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": exact_dedup.OP2_SQL,
        "op3_minhash_dedup": minhash_dedup.OP3_SQL,
        "op6_embedding_dedup": embedding_dedup.OP6_SQL,
        "op7_warc": warc.OP7_SQL,
        "op12_lexical_search": lexical_search.OP12_SQL,
    }
