"""Ids and content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import HASH_SEPARATOR, NO_HASH, UNKNOWN_FILE, UNKNOWN_MARKER


def first_non_empty(*values: Column) -> Column:
    """The first value that is neither NULL nor an empty string."""
    return F.coalesce(*(F.nullif(value, F.lit("")) for value in values))


def name_uuid(text: Column) -> Column:
    """The UUID text spelled by the md5 of a string."""
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def content_hash(
    mode: Column,
    bucket: Column,
    prefix: Column,
    file_name: Column,
    generation: Column,
    md5_hash: Column,
    crc32c: Column,
    manual_hint: Column,
) -> Column:
    """Fingerprint of what a trigger refers to; its parts depend on the mode."""
    base = F.concat_ws(HASH_SEPARATOR, F.coalesce(bucket, F.lit("")), F.coalesce(prefix, F.lit("")))
    # concat_ws drops NULL parts, which is what an absent hint needs.
    hint = first_non_empty(manual_hint)
    marker = F.concat_ws(
        HASH_SEPARATOR,
        base,
        F.coalesce(first_non_empty(file_name), F.lit(UNKNOWN_MARKER)),
        F.coalesce(generation, F.lit("")),
        hint,
    )
    fingerprint = first_non_empty(md5_hash, crc32c, generation, manual_hint, F.lit(NO_HASH))
    single_file = F.concat_ws(
        HASH_SEPARATOR,
        base,
        F.coalesce(first_non_empty(file_name), F.lit(UNKNOWN_FILE)),
        fingerprint,
    )
    folder = F.concat_ws(HASH_SEPARATOR, base, hint)
    text = (
        F.when(mode == "marker", marker)
        .when(mode == "file", single_file)
        .when(mode == "folder", folder)
        .otherwise(F.raise_error(F.concat(F.lit("unknown mode: "), F.coalesce(mode, F.lit("NULL")))).cast("string"))
    )
    return F.sha2(text, 256)


def content_changed(
    last_uid: Column, last_hash: Column, event_uid: Column, new_hash: Column
) -> Column:
    """Whether a given uid or a given hash differs from the last record's."""
    uid = first_non_empty(event_uid)
    digest = first_non_empty(new_hash)
    return (uid.isNotNull() & ~uid.eqNullSafe(last_uid)) | (digest.isNotNull() & ~digest.eqNullSafe(last_hash))
