from oeeflow.streaming.oee_stream import oee_stream, write_stream

__all__ = ["oee_stream", "write_stream"]
