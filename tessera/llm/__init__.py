"""Operators for training-data pipelines (ten dealt operators and their queries).

Nothing else in the library imports this package; ``tessera.llm.catalog`` registers
its queries and ``corpus_pipeline.py`` at the repository top chains five of them.
"""
