from parcelflow.functions.columns import (
    now,
    packed_id,
    prefixed_hash,
    prefixed_uuid,
    row_payload,
    time_slot,
    unpacked_id,
)
from parcelflow.functions.rows import hashed_if_large, is_large, numbered

__all__ = ["hashed_if_large", "is_large", "now", "numbered", "packed_id", "prefixed_hash", "prefixed_uuid", "row_payload", "time_slot", "unpacked_id"]
