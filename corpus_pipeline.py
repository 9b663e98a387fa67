"""The corpus pipeline: five text operators, each working on what its predecessor kept."""

from __future__ import annotations

from tidemart.llm.stages import STAGES, run

# Classifiers and tokenizers are not expressible in SQL; tests hold the stages
# against brute force instead.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]
