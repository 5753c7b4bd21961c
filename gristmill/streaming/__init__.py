"""Which operators a streaming frame may pass through."""

from gristmill.streaming.guards import require_batch

__all__ = ["require_batch"]
