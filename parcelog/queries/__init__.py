"""Registered queries over the driver tables, each with its SQL for the oracle where SQL can express it."""

from parcelog.queries import ingest, joins_checks, lifecycles, marts, models, scalars, streams_models  # noqa: F401
from parcelog.queries.registry import QUERIES, SQL  # noqa: F401
