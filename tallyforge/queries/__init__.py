"""Importing a module here registers its queries."""

from . import evaluation, modelling, publishing, relational  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
