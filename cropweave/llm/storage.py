"""Files of our own formats in a folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import SparkSession

from cropweave.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder of the session."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or absolute path; any store that Arrow knows."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace(":", "://", 1))


@contextmanager
def committed(path: str) -> Iterator:
    """A stream to a new file that appears under ``path`` only when it is complete.

    Attempts of one task write the same content under names of their own, so a repeated or speculative task is safe.
    """
    store, place = located(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    attempt = f"{place}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(attempt) as stream:
        yield stream
    store.move(attempt, place)
