"""Registered queries over the test tables, each with its SQL twin where SQL can express it."""

from wardscope.catalog import (  # noqa: F401
    aggregations,
    cleaning,
    evaluation,
    jobs,
    joins,
    learning,
    sampling,
    sources,
    windows,
)
from wardscope.catalog.base import ORACLES, QUERIES  # noqa: F401
