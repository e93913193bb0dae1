"""Registered queries: each pairs a Spark plan over the driver tables with
its DuckDB SQL oracle (or none, for non-SQL operators)."""

from lathe.plans.registry import QUERIES, ORACLES, register  # noqa: F401
