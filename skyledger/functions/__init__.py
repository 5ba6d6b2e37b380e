"""Column-level building blocks."""

from skyledger.functions.flags import share, with_is_delayed, with_penalty, with_total_delay
from skyledger.functions.ranking import ranked, top_k

__all__ = ["ranked", "share", "top_k", "with_is_delayed", "with_penalty", "with_total_delay"]
