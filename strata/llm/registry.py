"""Queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import importlib

MODULES = ("url_reputation", "bpe_tree", "importance_filter", "hash_tree_shards", "license_compression", "token_attribution", "template_leaks", "minhash_postings", "relative_factors", "projection_forest",
           "permuterm_variants", "record_files", "centroid_products")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"strata.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
