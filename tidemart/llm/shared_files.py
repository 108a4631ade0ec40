"""Files that tasks write for other tasks, in the run's folder on the cluster's shared storage."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder or file named by URI or by absolute path."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def fresh(folder: str, stem: str, ending: str = ""):
    """Open a new file under a name of its own; gives its URI and the stream to write to.

    An attempt that is repeated writes another file; readers use the name that the finished
    attempt reported, so that half-written files are never read.
    """
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}{ending}"
    return f"{folder.rstrip('/')}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)


def put(folder: str, stem: str, data: bytes) -> str:
    uri, out = fresh(folder, stem)
    with out:
        out.write(data)
    return uri


def get(uri: str) -> bytes:
    system, path = opened(uri)
    with system.open_input_file(path) as source:
        return source.read()
