from landfall.streaming.runlog import run_log_stream
from landfall.streaming.stream import ingest_stream

__all__ = ["ingest_stream", "run_log_stream"]
