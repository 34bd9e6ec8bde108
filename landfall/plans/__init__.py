from landfall.plans.endpoints import ENDPOINTS, TABLE_KEYS, Endpoint
from landfall.plans.flow import (
    IngestError,
    Options,
    ingest,
    ingest_fanout,
    init_tables,
    logged_task,
    stage,
)

__all__ = [
    "ENDPOINTS", "TABLE_KEYS", "Endpoint", "IngestError", "Options", "ingest", "ingest_fanout", "init_tables",
    "logged_task", "stage",
]
