"""Governed, model-ready data products on PySpark."""

from tidemark.context import RunContext

__all__ = ["RunContext"]
