"""Training-data operators: tokenizers, near-duplicates, decontamination,
personal data, toxicity, quality rules, chat formatting and token files.

Nothing outside this subpackage imports it; ``queries.py`` registers its
queries with the driver entry.
"""
