"""File systems behind paths, as Spark users write them."""

import os
from urllib.parse import urlparse

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path on it, without a slash at the end.

    A path without a scheme is local, and may be relative; ``s3a`` and ``s3n`` are ``s3``.
    """
    url = urlparse(path)
    if url.scheme in ("", "file"):
        return fs.LocalFileSystem(), os.path.abspath(url.path if url.scheme else path)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(url.scheme, url.scheme)
    filesystem, local = fs.FileSystem.from_uri(f"{scheme}{path[len(url.scheme):]}")
    return filesystem, local.rstrip("/")


def absolute(path: str) -> str:
    """A local path as seen from here, before another process with another folder reads it."""
    return path if urlparse(path).scheme else os.path.abspath(path)
