"""Binary files in a folder that all executors share."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def store_of(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or URI."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def put(store: pafs.FileSystem, path: str, parts: list[bytes]) -> None:
    """Write under another name first: a file with its own name is always whole."""
    draft = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    store.move(draft, path)
