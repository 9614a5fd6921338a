"""The corpus pipeline: quality, near duplicates, personal data, mixing, tokens. Its stages are in the subpackage."""

from tandemsift.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
