"""Training-data operators: fingerprints, dedup, language, PII, tokens, …

Each module holds one operator with a general interface; ``queries.py`` wraps
them as the registered ``opN_<name>`` queries.  Nothing outside this folder
imports it.
"""
