"""The corpus pipeline: documents through five stages, each one of the operators in changeflow.llm."""

from __future__ import annotations

from changeflow.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
