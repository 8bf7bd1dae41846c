"""The reference's three daily reports, composed from ``dimledger.operators``."""
