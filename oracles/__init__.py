"""Independent DuckDB SQL for the registered queries."""

from oracles.sql import ORACLES

__all__ = ["ORACLES"]
