"""Training-data operators: language-model scoring, secrets, media, toxicity, near-dedup, packing, PII, mixing, WARC, search.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""
