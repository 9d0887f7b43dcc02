"""Registered queries: each pairs a Spark job with its SQL on the same tables."""


def load() -> None:
    """Import the modules that register queries."""
    from suite import aggregates, calendars, checks, joins, models, scalars, sources, spatial, streams  # noqa: F401
