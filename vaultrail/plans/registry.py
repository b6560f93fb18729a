"""Registration of queries under their function names."""

from __future__ import annotations


def registrar(queries: dict, oracles: dict):
    def query(sql: str | None = None):
        """Register a query ``(spark, folder) -> DataFrame``, with its SQL if it has one."""

        def register(function):
            queries[function.__name__] = function
            if sql is not None:
                oracles[function.__name__] = sql
            return function

        return register

    return query
