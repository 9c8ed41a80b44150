"""Training-data operators: one module each, their queries in :mod:`tidemark.llm.queries`.

Nothing else in the library imports this package.
"""
