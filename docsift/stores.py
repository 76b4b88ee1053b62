"""Access to storage from within tasks."""

from __future__ import annotations

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI in the spelling of Spark (``s3a://``, ``file:/``) or a plain local path."""
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri[len(scheme) :]
    if uri.startswith("file:/"):
        # Spark's spelling escapes nothing: a percent sign is one of the name, which ``from_uri`` would take for an escape.
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].strip("/")
    return fs.FileSystem.from_uri(uri)
