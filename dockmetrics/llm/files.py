"""Binary files in a shared folder, written and read from tasks.

Paths may be local or URIs of any store that pyarrow can open. A file's name holds the
partition and the attempt; only names in a task's returned rows count, so a repeated or
speculative task leaves at most a file that nothing refers to.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyarrow import fs
from pyspark import TaskContext


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        path = f"file://{path}"
    return fs.FileSystem.from_uri(path)


def attempt_name(prefix: str, suffix: str) -> str:
    return f"{prefix}-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}{suffix}"


def write_file(folder: str, name: str, chunks: Iterable[bytes]) -> int:
    """Writes the chunks as one file and returns its size."""
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    size = 0
    with store.open_output_stream(f"{base}/{name}", compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    return size
