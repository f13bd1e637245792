"""pyarrow file systems for the paths that Spark lists."""

from __future__ import annotations


def file_system(uri: str):
    """(pyarrow file system, path in it) of a Hadoop-style path, whose characters are taken as they are: a partition
    folder may hold a percent sign, which a URI parser would decode."""
    from pyarrow import fs

    scheme, sep, rest = uri.partition("://")
    if not sep:
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    if scheme == "file":
        return fs.LocalFileSystem(), rest[rest.index("/"):]
    host, _, path = rest.partition("/")
    store, root = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}://{host}/")
    return store, f"{root.rstrip('/')}/{path}"
