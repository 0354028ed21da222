"""Operators for training-data pipelines: secrets, duplicates, benchmark
passages, packing, archives, toxicity, personal data and chat turns.

Each module holds one operator with a general interface; ``queries`` applies
them to the given tables and ``statements`` says the same in SQL where SQL can.
Nothing outside this package imports it."""
