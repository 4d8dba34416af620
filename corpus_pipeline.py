"""The corpus pipeline: its stages are in ``tidepanel.llm.pipeline``."""

from tidepanel.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
