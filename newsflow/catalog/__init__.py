"""All registered queries."""

from newsflow.catalog import landing, scalars, tables, texts  # noqa: F401
from newsflow.catalog.registry import ORACLES, QUERIES  # noqa: F401
