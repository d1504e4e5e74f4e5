"""All queries of the core and their SQL."""

from __future__ import annotations

from caudalix.plans import facts, licences, problems, report

QUERIES = licences.QUERIES | facts.QUERIES | report.QUERIES | problems.QUERIES
ORACLES: dict[str, str] = licences.ORACLES | facts.ORACLES | report.ORACLES | problems.ORACLES
