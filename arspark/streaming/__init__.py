from arspark.streaming.ingest import (  # noqa: F401
    RAW_ENVELOPE_SCHEMA, dedupe_stream, read_raw_stream, run_upsert_stream, write_raw_stream,
)
