"""Operators of a training-data pipeline; each module holds one operator, ``queries`` registers them."""

import importlib

MODULES = ("chat", "sharding", "quality_rules", "token_files", "byte_bpe", "decontamination", "jaccard_join", "suffix_dedup",
           "maxent_lm", "toxicity", "lexical_search", "packing", "alignment")


def load():
    """Import every operator module and return (queries, oracles)."""
    from nearfield.llm import common

    for name in MODULES:
        importlib.import_module(f"nearfield.llm.{name}")
    if "pipeline" not in common.QUERIES:
        import corpus_pipeline

        common.register("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
    return dict(common.QUERIES), dict(common.ORACLES)
