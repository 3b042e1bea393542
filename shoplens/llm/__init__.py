"""Operators of a training-data pipeline, and their registered queries."""

from shoplens.llm.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
