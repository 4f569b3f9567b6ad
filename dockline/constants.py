"""Values that loads, routing and admission must agree on with existing setups."""

from __future__ import annotations

from datetime import timedelta

# Source formats and the codecs a caller may name.
FORMATS = ("parquet", "orc", "avro", "json", "delimited")
CODECS = ("none", "gzip", "bzip2", "snappy")

# Partition granularities and how each names a partition.
GRANULARITY_FORMATS = {
    "HOUR": "yyyyMMddHH",
    "DAY": "yyyyMMdd",
    "MONTH": "yyyyMM",
    "YEAR": "yyyy",
}
PARTITION_COLUMN_TYPES = ("date", "timestamp")

# Trigger modes of the rule registry.
MODES = ("file", "folder", "marker")

# Stand-ins inside the content hash.
HASH_SEPARATOR = "::"
UNKNOWN_MARKER = "_UNKNOWN_MARKER"
UNKNOWN_FILE = "_UNKNOWN_FILE"
NO_HASH = "_NO_HASH"

# Admission outcomes, in the order they are tested.
DUPLICATE = "duplicate_event"
DOUBLE_TAP = "double_tap"
PENDING = "pending"
COOLDOWN = "cooldown"
ACCEPTED = "accepted"
# Ours: an event older than the last accepted one of its key (streams only).
LATE = "late"
UNDATED = "undated"

# Admission windows used when a rule names none.
DEFAULT_DOUBLE_TAP = timedelta(seconds=5)
DEFAULT_COOLDOWN = timedelta(minutes=30)
DEFAULT_TTL = timedelta(hours=12)
DEFAULT_DELAY = timedelta(minutes=5)

# Ledger clean-up.
LEDGER_MAX_AGE = timedelta(days=2)
LEDGER_CLEANUP_BATCH = 500

# Event sources.
SOURCE_MANUAL = "manual"
SOURCE_EVENT = "eventarc"

# The argument that carries the run id.
RUN_ARGUMENT = "--run_uuid="

# Physical partition column of every table written here.
PART_ID = "part_id"
