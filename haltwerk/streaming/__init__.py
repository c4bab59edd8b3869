from .late import late_safe_stream, mark_late
from .stream import ingest_state, ingest_stream, scd2_stream

__all__ = ["ingest_state", "ingest_stream", "late_safe_stream", "mark_late", "scd2_stream"]
