"""Training-data operators: near-dedup, decontamination, scoring, packing, PII, token files.

Self-contained: nothing else in the library imports this package.  ``queries.py`` registers
one query per operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
