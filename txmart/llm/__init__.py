"""Training-data operators: one module per operator, each with its registered query.

Nothing else in the library imports this subpackage. ``txmart.llm.catalog`` lists the
queries and their DuckDB oracle SQL; ``corpus_pipeline.py`` chains five of the operators.
"""
