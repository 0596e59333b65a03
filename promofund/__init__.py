"""promofund — supplier promotion-funding settlement on Spark DataFrames.

Layers:
  sources/    table scans, domain views over the input tables, config, sinks
  functions/  column functions (date windows, rule tables, scalar helpers)
  operators/  reusable DataFrame operators (dedupe, nesting, interval joins, quality)
  plans/      end-to-end jobs (clean, curate, settlement v1, settlement v2, health)
  streaming/  look-back refresh as Structured Streaming
"""

from promofund.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
