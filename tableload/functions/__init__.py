from tableload.functions.lineage import child_id, key_id
from tableload.functions.naming import check_collisions, normalize_name
from tableload.functions.partition import bucket, day, hour, identity, month, year
from tableload.functions.types import logical_type

__all__ = [
    "bucket", "check_collisions", "child_id", "day", "hour", "identity", "key_id",
    "logical_type", "month", "normalize_name", "year",
]
