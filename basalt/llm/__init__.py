"""Training-data operators: toxicity, packing, near-duplicates, HTML text, token files,
subword encoding, exact top-k, quality, exact dedup and language identification.

Nothing outside this subpackage imports it; its queries are in ``llm.queries``.
"""
