"""A corpus pipeline of five stages over ``documents``; each is one operator's decision."""

from __future__ import annotations

from basketlens.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
