from silverloom.streaming.ingest import ingest_absent, ingest_table, stream_bronze

__all__ = ["ingest_absent", "ingest_table", "stream_bronze"]
