"""Training-data operators: sharding, media columns, near-dedup, mixing, chat
formatting, toxicity, tokenising, language ID, quality rules, licence scans.

Nothing outside this subpackage imports it.
"""
