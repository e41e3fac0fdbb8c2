"""The query catalogue: domain inputs made of the driver tables, queries and their SQL."""
