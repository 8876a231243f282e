"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

import importlib

#: name -> module of this package that defines the function of that name
MODULES = {
    "op1_sharding": "sharding",
    "op2_ngram_join": "ngram_join",
    "op3_pii": "pii",
    "op4_decontamination": "decontaminate",
    "op5_language": "language",
    "op6_suffix_dedup": "suffix_dedup",
    "op7_sentencepiece": "pieces",
    "op8_embedding_dedup": "embedding_dedup",
    "op9_token_counts": "token_counts",
    "op10_toxicity": "toxicity",
    "op11_spelling": "spelling",
    "op12_substring_dedup": "substring_dedup",
    "op13_fill_in_middle": "fill_middle",
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f"{__package__}.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    from . import fill_middle, sharding, spelling, substring_dedup

    return {"op1_sharding": sharding.SQL, "op11_spelling": spelling.SQL, "op12_substring_dedup": substring_dedup.SQL, "op13_fill_in_middle": fill_middle.SQL}
