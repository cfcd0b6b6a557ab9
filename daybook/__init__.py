"""daybook: close-of-business banking marts and reports as Spark jobs."""

from daybook.context import Context

__all__ = ["Context"]
