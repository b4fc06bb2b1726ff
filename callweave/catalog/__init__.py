"""The catalogue of registered queries."""

from callweave.catalog import (  # noqa: F401
    dialer, expressions, groups, joins, retention, writes,
)
from callweave.catalog.registry import ORACLE, QUERIES  # noqa: F401
