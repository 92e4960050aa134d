"""All registered queries."""

from tidemark.plans import (  # noqa: F401
    access,
    catalog,
    documents,
    identity,
    jobs,
    metrics,
    retrieval,
    sinks,
    sources,
    streams,
    sync,
)
from tidemark.plans.registry import ORACLES, QUERIES  # noqa: F401
