from .live_ledger import compact_live_postings, live_statements, start_live_postings

__all__ = ["compact_live_postings", "live_statements", "start_live_postings"]
