"""Which folder holds the rows of a table.

A table starts in its own folder. A full overwrite writes a version folder below it
and then makes it current by creating one empty file that bears its name; readers and
later loads go to the version with the highest number. That file is the only thing a
reader can notice: before it the table is the old one, after it the new one, whole
and with its schema. What the table held before is removed afterwards; if a run ends
before that, the next overwrite does it.

Loads of one table should not run at the same time, as before. Of two full overwrites
that do, one wins whole.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

from ..constants import PART_ID
from .storage import Folder

# Hidden from whoever reads the table's own folder.
MARKERS, VERSIONS = "_current", "_versions"
_VERSION = "version-"


def _number(version: str) -> int:
    return int(version.removeprefix(_VERSION).split("-")[0])


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of the current version folder; None while the table is in its own folder."""
    published = Folder(spark, f"{path}/{MARKERS}").files()
    return max((v for v in published if v.startswith(_VERSION)), key=lambda v: (_number(v), v), default=None)


def data_folder(spark: SparkSession, path: str) -> str:
    version = current_version(spark, path)
    return path if version is None else version_folder(path, version)


def version_folder(path: str, version: str) -> str:
    return f"{path}/{VERSIONS}/{version}"


def new_version(spark: SparkSession, path: str) -> str:
    """A name that no run has used, numbered behind the current version."""
    version = current_version(spark, path)
    number = 1 if version is None else _number(version) + 1
    return f"{_VERSION}{number:08d}-{uuid4().hex[:12]}"


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make a finished version the table."""
    if not Folder(spark, version_folder(path, version)).exists():
        raise OSError(f"version {version} of {path} is gone: another load has replaced the table")
    Folder(spark, f"{path}/{MARKERS}").create(version)


def sweep(spark: SparkSession, path: str) -> None:
    """Remove what the table held before its current version, and versions never finished."""
    version = current_version(spark, path)
    if version is None:
        return
    older = lambda name: name.startswith(_VERSION) and name != version and _number(name) <= _number(version)
    table, markers, versions = (Folder(spark, f) for f in (path, f"{path}/{MARKERS}", f"{path}/{VERSIONS}"))
    # Markers first: none may name a folder that is gone.
    for marker in filter(older, markers.files()):
        markers.remove(marker)
    for folder in filter(older, versions.children()):
        versions.remove(folder)
    for child in table.children():
        if child.startswith(f"{PART_ID}="):
            table.remove(child)
