from landfall.sources.landing import (
    LANDING_SCHEMA,
    inject_columns,
    member_lists,
    normalize_response,
    read_landing,
    rejected,
    route_all,
    route_large,
    route_records,
    with_endpoints,
)
from landfall.sources.logs import (
    DISCOVERY_SCHEMA,
    RUN_SCHEMA,
    append_discovery,
    append_run_events,
    read_discovery,
    read_run_events,
    run_event_stream,
)

__all__ = [
    "DISCOVERY_SCHEMA",
    "LANDING_SCHEMA",
    "RUN_SCHEMA",
    "append_discovery",
    "append_run_events",
    "inject_columns",
    "member_lists",
    "normalize_response",
    "read_discovery",
    "read_landing",
    "read_run_events",
    "rejected",
    "route_all",
    "route_large",
    "route_records",
    "run_event_stream",
    "with_endpoints",
]
