"""panelspark.functions: scalar column functions (built-in Spark expressions only)."""

from .scalar import *  # noqa: F401,F403
