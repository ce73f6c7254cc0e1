"""All registered queries."""

from checks import feeds, ml, scalars, stats, streams, visits  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401
