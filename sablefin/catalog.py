"""Every query of the engine by name, with the SQL that states the same result."""

from __future__ import annotations

from sablefin.plans import features, governance, monitoring, screening, screening_given

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "all_alerts_union"

for _part in (monitoring, features, governance, screening, screening_given):
    QUERIES |= _part.QUERIES
    ORACLE_SQL |= _part.ORACLE_SQL
