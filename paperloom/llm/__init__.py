"""Operators of a large training-data pipeline, with their queries; nothing else of the library needs them."""

from paperloom.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
