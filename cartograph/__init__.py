"""cartograph: set-based data discovery and profiling on Spark."""

from .config import KEY_DISCOVERY, Options
from .plans.analysis import Analysis
from .plans.pipeline import get_review_queue, run_history, run_pipeline
from .sources.discovery import Estate, discover, discover_frames

__all__ = ["Analysis", "Estate", "KEY_DISCOVERY", "Options", "discover", "discover_frames",
           "get_review_queue", "run_history", "run_pipeline"]
