"""Training-data operators: packing, toxicity, byte BPE, near-dedup, top-k search,
chat formatting, sharding, quality rules, personal data and secret scans.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
