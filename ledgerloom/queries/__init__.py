"""One query per operator, each with the SQL that must give the same rows."""

from ledgerloom.queries import aggregates, joins, ledger, rows, sources_sinks  # noqa: F401
from ledgerloom.queries.registry import ORACLES, QUERIES  # noqa: F401
