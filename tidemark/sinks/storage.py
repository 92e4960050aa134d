"""File systems as tasks see them."""

from __future__ import annotations

import pyarrow.fs as pafs


def storage(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it. Hadoop's ``s3a`` is what Arrow names ``s3``."""
    for theirs, ours in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if folder.startswith(theirs):
            folder = ours + folder[len(theirs) :]
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(folder)
