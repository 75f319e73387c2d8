"""Queries of this subpackage, by name."""

from __future__ import annotations

from hushwire.llm import bpe, fingerprints, language, packing, passages, phrases, pii, quality, search, secrets, sharding, simhash, vectors


def queries() -> dict:
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_fingerprints": fingerprints.op1_fingerprints,
        "op2_quality": quality.op2_quality,
        "op3_secrets": secrets.op3_secrets,
        "op4_pii": pii.op4_pii,
        "op5_passages": passages.op5_passages,
        "op6_packing": packing.op6_packing,
        "op7_bpe": bpe.op7_bpe,
        "op8_simhash": simhash.op8_simhash,
        "op9_language": language.op9_language,
        "op10_embeddings": vectors.op10_embeddings,
        "op11_phrases": phrases.op11_phrases,
        "op12_search": search.op12_search,
        "op13_sharding": sharding.op13_sharding,
    }


def oracle_sql() -> dict:
    """Those whose results SQL can give on whole tables; tests compare the others with brute force."""
    return {"op11_phrases": phrases.SQL, "op12_search": search.SQL}
