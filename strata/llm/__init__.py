"""Operators of a training-data pipeline, each built by its own method.

``url_reputation`` (1), ``bpe_tree`` (2), ``importance_filter`` (3),
``projection_forest`` (4), ``minhash_postings`` (5), ``hash_tree_shards`` (6),
``relative_factors`` (7), ``license_compression`` (8), ``token_attribution``
(9), ``template_leaks`` (10), ``permuterm_variants`` (11), ``record_files`` (12)
and ``centroid_products`` (13); ``registry`` names the queries.
"""
