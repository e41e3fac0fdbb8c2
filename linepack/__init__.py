"""Pipeline capacity postings on Spark: read, key, normalise, replace, audit."""

from . import fixed, functions, operators, plans, schemas, sinks, sources, streaming

__all__ = ["fixed", "functions", "operators", "plans", "schemas", "sinks", "sources", "streaming"]
