from tierlake.streaming.archives import ingest_archives_stream
from tierlake.streaming.incremental import header_schema, ingest_stream

__all__ = ["header_schema", "ingest_archives_stream", "ingest_stream"]
