"""tallybook: yearly financial statements from raw business records, on Spark."""

from .plans.pipeline import build_legacy_statements, build_statements, run_pipeline
from .session import cluster_conf, ensure_checkpoint_dir, get_session
from .sources.adapter import Ledger, ledger_from_driver
from .sources.loader import load_ledger

__all__ = [
    "Ledger", "build_legacy_statements", "build_statements", "cluster_conf",
    "ensure_checkpoint_dir", "get_session", "ledger_from_driver", "load_ledger", "run_pipeline",
]
