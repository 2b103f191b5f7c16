"""Row fingerprints."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.params import HASH_SEPARATOR, NULL_MARKER


def tracking_hash(tracked: Iterable[str]) -> Column:
    """SHA-256 over the tracked attributes in their given order; null is not the empty text."""
    texts = (F.coalesce(F.col(name).cast("string"), F.lit(NULL_MARKER)) for name in tracked)
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), 256)


def record_hash(source_columns: Iterable[str]) -> Column:
    """SHA-256 of the record as JSON.

    Only what the source sent is hashed, so the same record has the same hash in every load.
    """
    return F.sha2(F.to_json(F.struct(*source_columns)), 256)
