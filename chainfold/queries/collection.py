"""All registered queries."""

from chainfold.queries import checks, rules, state, telemetry  # noqa: F401
from chainfold.queries.base import QUERIES, SQL  # noqa: F401
