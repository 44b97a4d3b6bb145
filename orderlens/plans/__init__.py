from orderlens.plans.refresh import check_lake, ingest_documents, load_tables, process_lake, run_refresh
from orderlens.plans.registry import REPORTS, Report, register_views, run

__all__ = [
    "REPORTS",
    "Report",
    "check_lake",
    "ingest_documents",
    "load_tables",
    "process_lake",
    "register_views",
    "run",
    "run_refresh",
]
