"""Queries of the llm operators: one for each, and the pipeline."""

from __future__ import annotations

from restock.llm import (ann, bpe, langid, merge_dropout, packing, quality, reshard, secret_scan, simhash, spelling,
                         suffix_dedup, topk, trie)


def _pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_quality_cotraining": quality.query,
        "op2_reshard": reshard.query,
        "op3_language_id": langid.query,
        "op4_simhash_dedup": simhash.query,
        "op5_secret_scan": secret_scan.query,
        "op6_suffix_dedup": suffix_dedup.query,
        "op7_packing": packing.query,
        "op8_ann_forest": ann.query,
        "op9_exact_topk": topk.query,
        "op10_merge_dropout": merge_dropout.query,
        "op11_bpe": bpe.query,
        "op12_spelling_variants": spelling.query,
        "op13_prefix_trie": trie.query,
        "pipeline": _pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_topk": topk.ORACLE, "op12_spelling_variants": spelling.ORACLE,
            "op13_prefix_trie": trie.ORACLE}
