"""Publications that appear at once: version folders, a manifest, and one commit that makes a version visible.

A run writes all its tables into a folder of its own. Only when every table is there does it write its manifest and then
its commit, one small file with the next number. Readers go by the commits, so a run that ends half-way is never seen, and
older versions stay readable by time or number. One writer at a time publishes to a root.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

COMMITS, VERSIONS = "_commits", "versions"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace(":", "://", 1))


def _write(path: str, content: dict) -> None:
    """A small file that appears whole: written under another name and moved."""
    store, place = _store(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    attempt = f"{place}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(attempt) as stream:
        stream.write(json.dumps(content, sort_keys=True).encode())
    store.move(attempt, place)


def _read(path: str) -> dict:
    store, place = _store(path)
    with store.open_input_stream(place) as stream:
        return json.loads(stream.read())


def _names(path: str, kind: fs.FileType) -> list[str]:
    store, place = _store(path)
    found = store.get_file_info(fs.FileSelector(place, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == kind)


def commits(root: str) -> list[dict]:
    """All commits in order: ``number``, ``version``, ``run_ts`` and the names of its ``tables``."""
    root = root.rstrip("/")
    return [_read(f"{root}/{COMMITS}/{name}") for name in _names(f"{root}/{COMMITS}", fs.FileType.File) if name.endswith(".json")]


def publish(root: str, run_ts: str, write: Callable[[str], object]) -> dict:
    """Call ``write`` with a new version folder, then commit what it wrote there; returns the commit.

    Every folder that ``write`` leaves is a table of the version. If it raises, nothing becomes visible.
    """
    root = root.rstrip("/")
    version = uuid.uuid4().hex
    folder = f"{root}/{VERSIONS}/{version}"
    write(folder)
    manifest = {"version": version, "run_ts": run_ts, "tables": _names(folder, fs.FileType.Directory)}
    _write(f"{folder}/_manifest.json", manifest)
    number = max((c["number"] for c in commits(root)), default=0) + 1
    commit = {"number": number, **manifest}
    _write(f"{root}/{COMMITS}/{number:012d}.json", commit)
    return commit


def version_folder(root: str, as_of: str | None = None, number: int | None = None) -> str:
    """Folder of the newest version, of the newest one with ``run_ts`` up to ``as_of``, or of commit ``number``."""
    root = root.rstrip("/")
    known = [c for c in commits(root) if (as_of is None or c["run_ts"] <= as_of) and (number is None or c["number"] == number)]
    if not known:
        raise ValueError(f"no version of {root} fits as_of={as_of}, number={number}")
    return f"{root}/{VERSIONS}/{known[-1]['version']}"


def read_version(spark: SparkSession, root: str, table: str, as_of: str | None = None, number: int | None = None) -> DataFrame:
    """A table of a version, see ``version_folder``; all tables read with the same arguments belong together."""
    return spark.read.parquet(f"{version_folder(root, as_of, number)}/{table}")
