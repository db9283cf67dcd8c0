from cordon.streaming.ingest import stream_ingest

__all__ = ["stream_ingest"]
