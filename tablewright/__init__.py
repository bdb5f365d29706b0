"""tablewright: reusable table jobs on Spark DataFrames."""

from tablewright.session import build_session

__all__ = ["build_session"]
