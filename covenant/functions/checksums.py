"""Payload digests and their verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covenant.functions.text import is_blank

# Algorithm name, verdicts and mismatch actions.
ALGORITHM = "SHA-256"
PASS, FAIL, ABSENT = "PASS", "FAIL", "ABSENT"
SKIP, ABORT, LOG_ONLY = "SKIP", "ABORT", "LOG_ONLY"
MATCH_PASS = "PASS"
MATCH_EXCEPTION = "FAIL -- exception"
MATCH_MISMATCH = "FAIL -- digest mismatch"
MATCH_ABSENT = "ABSENT -- no checksum (tolerated)"
MATCH_SKIPPED = "SKIPPED"


def payload_checksum(value: Column) -> Column:
    """Lower-case hex SHA-256; null for null."""
    return F.sha2(value, 256)


def checksum_status(expected: Column, actual: Column) -> Column:
    """ABSENT when nothing was promised (tolerated), else PASS or FAIL; hex case does not matter."""
    return (
        F.when(is_blank(expected), ABSENT)
        .when(F.coalesce(F.lower(expected) == F.lower(actual), F.lit(False)), PASS)
        .otherwise(FAIL)
    )


def mismatch_action(configured: str | None) -> str:
    """The configured action; anything unknown behaves as SKIP."""
    name = (configured or SKIP).upper().strip()
    return name if name in (SKIP, ABORT, LOG_ONLY) else SKIP


def match_label(expected: Column, actual: Column, error: Column) -> Column:
    """Verdict text of an integrity report row."""
    status = checksum_status(expected, actual)
    return (
        F.when(error.isNotNull(), MATCH_EXCEPTION)
        .when(status == ABSENT, MATCH_ABSENT)
        .when(status == PASS, MATCH_PASS)
        .otherwise(MATCH_MISMATCH)
    )
