"""Training-data operators and the registry of their queries.

Nothing outside this package imports it; ``__spark_entry__`` adds
``QUERIES`` and ``ORACLES`` only if the package can be imported.
"""
