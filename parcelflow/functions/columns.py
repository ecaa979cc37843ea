"""Column builders shared by the operators. All run inside the JVM."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefixed_hash(prefix: str, *keys: Column) -> Column:
    """A row id that is the same in every query over the same rows.

    Every key goes in with its length, so that no two lists of keys look alike. A
    null key counts as an empty text, so that its neighbours keep their place.
    """
    texts = [F.coalesce(k.cast("string"), F.lit("")) for k in keys]
    parts = [x for t in texts for x in (F.length(t).cast("string"), F.lit(":"), t)]
    # sha2 counts as nullable. Without the coalesce a join on the id would hash
    # every row a second time, to test it for null.
    digest = F.coalesce(F.sha2(F.concat(*parts), 256), F.lit(""))
    return F.concat(F.lit(prefix), digest)


def packed_id(text: Column) -> Column:
    """A row id as bytes, for shuffles and state: one that ends in a SHA-256 digest takes half the room, any other
    text stays as it is. Equal texts give equal bytes and others do not; a null stays null."""
    end = F.right(text, F.lit(64))
    digest = F.coalesce(F.unhex(end), F.lit(b""))
    is_id = (F.length(text) >= 64) & (F.length(digest) == 32) & (end == F.lower(end))
    prefix = F.substr(text, F.lit(1), F.length(text) - 64).cast("binary")
    return F.when(is_id, F.concat(F.lit(b"\x01"), digest, prefix)).otherwise(
        F.concat(F.lit(b"\x00"), text.cast("binary"))
    )


def unpacked_id(packed: Column) -> Column:
    """The text of a ``packed_id``."""
    rest = F.expr("2147483647")
    digest = F.lower(F.hex(F.substr(packed, F.lit(2), F.lit(32))))
    return F.when(
        F.substr(packed, F.lit(1), F.lit(1)) == F.lit(b"\x01"),
        F.concat(F.substr(packed, F.lit(34), rest).cast("string"), digest),
    ).otherwise(F.substr(packed, F.lit(2), rest).cast("string"))


def prefixed_uuid(prefix: str) -> Column:
    """A random row id. Two queries over one plan draw different ids: write the
    rows once and read them back before joining on it."""
    return F.concat(F.lit(prefix), F.expr("uuid()"))


def now(at: datetime | Column | None = None) -> Column:
    """The processing time; ``at`` fixes it for replays and tests."""
    if at is None:
        return F.current_timestamp()
    return at if isinstance(at, Column) else F.lit(at).cast("timestamp")


def row_payload(*fields: Column) -> Column:
    """JSON text of the given fields; null fields are left out."""
    return F.to_json(F.struct(*fields))


def time_slot(ts: Column, width: timedelta) -> Column:
    """Number of the fixed-width slot that holds ``ts`` (microsecond exact)."""
    micros = int(width / timedelta(microseconds=1))
    stamp = F.unix_micros(ts)
    # The numerator is a multiple of the width, so the division is exact.
    return ((stamp - F.pmod(stamp, F.lit(micros))) / F.lit(micros)).cast("bigint")
