"""Files that tasks write to and read from the shared folder, in any store that Arrow opens."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    system, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))
    return system, inner
