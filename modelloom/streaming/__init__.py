from modelloom.streaming.eventtime import EventTime, session_stream, split_late, window_stream
from modelloom.streaming.incremental import append_stream, stream_files

__all__ = ["EventTime", "append_stream", "session_stream", "split_late", "stream_files", "window_stream"]
