"""Binary files in the shared folder, written from tasks."""

from __future__ import annotations

import uuid

#: Hadoop scheme -> the scheme pyarrow knows for the same store.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def filesystem(uri: str):
    """(pyarrow filesystem, path in it) of a path or Hadoop URI."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + ":" + rest)


def write_file(folder: str, name: str, content) -> str:
    """Write ``folder/name`` (bytes, or parts as they come) in one step: a file under a name of its own, then
    a rename, so a repeated or speculative task leaves one whole file (tasks
    are deterministic: every attempt writes the same content).  Readers
    skip names that start with an underscore."""
    from pyarrow import fs

    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    temporary = f"{root}/_{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        for part in [content] if isinstance(content, (bytes, bytearray)) else content:
            out.write(part)
    target = f"{root}/{name}"
    if store.get_file_info(target).type == fs.FileType.NotFound:
        store.move(temporary, target)
    else:  # an earlier attempt of the same task wrote the same content
        store.delete_file(temporary)
    return f"{folder}/{name}"
