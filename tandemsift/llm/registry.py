"""The queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from . import branch_bound, byte_pairs, language_model, merkle, mixing, ngram_join, periodic_runs, pii, pipeline, quality, rp_forest, sentence_pieces, token_counts, warc


def queries() -> dict:
    return {
        "pipeline": pipeline.run,
        "op1_rp_forest": rp_forest.query,
        "op2_quality": quality.query,
        "op3_branch_bound": branch_bound.query,
        "op4_pii": pii.query,
        "op5_sentence_pieces": sentence_pieces.query,
        "op6_language_model": language_model.query,
        "op7_token_counts": token_counts.query,
        "op8_mixing": mixing.query,
        "op9_ngram_join": ngram_join.query,
        "op10_warc": warc.query,
        "op11_periodic_runs": periodic_runs.query,
        "op12_byte_pairs": byte_pairs.query,
        "op13_merkle": merkle.query,
        "pii_base_columns": pii.base_query,
        "language_model_base_columns": language_model.base_query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_branch_bound": branch_bound.ORACLE,
        "op8_mixing": mixing.ORACLE,
        "pii_base_columns": pii.ORACLE_BASE,
        "language_model_base_columns": language_model.ORACLE_BASE,
        "op9_ngram_join": ngram_join.ORACLE,
        "op10_warc": warc.ORACLE,
        "op11_periodic_runs": periodic_runs.ORACLE,
        "op13_merkle": merkle.ORACLE,
    }
