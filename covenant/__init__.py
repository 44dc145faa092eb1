"""Governed data exchange on Spark: entitlement joins, integrity checks, chunked file transfer and landing."""
