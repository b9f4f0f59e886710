"""Log-shaped rows for tests."""

from adlumen.schema import LOG_FIELDS, LOG_SCHEMA

_DEFAULT = {"string": "", "int": 0, "double": 0.0}


def log_rows(spark, rows):
    """Log-shaped DataFrame: every field defaults to ''/0/0.0, overridden by dicts."""
    full = []
    for r in rows:
        full.append(tuple(r.get(n, _DEFAULT[k]) for n, k in LOG_FIELDS))
    return spark.createDataFrame(full, LOG_SCHEMA)
