from dimledger.streaming.ingest import ingest_files  # noqa: F401
