"""All example queries."""

from gallery import cleaning, loads, profiling, refresh, reports, runs, star  # noqa: F401
from gallery.base import EXAMPLES

__all__ = ["EXAMPLES"]
