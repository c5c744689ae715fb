"""The registered queries: inputs derived from the given tables, Spark queries
over them and the same results in plain SQL."""
