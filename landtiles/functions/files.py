"""Files opened by tasks, through the file system that a path names."""

import fnmatch
import os
import posixpath
import re
from collections.abc import Iterator
from urllib.parse import quote

from pyarrow import fs

# names that pyarrow gives to stores that Hadoop knows by other ones
STORES = {"s3a": "s3", "s3n": "s3"}
LISTED_AT_ONCE = 4096


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and the folder's path in it."""
    match = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(.*)$", root)
    if not match or match[1] == "file":
        return fs.LocalFileSystem(), os.path.abspath(match[3] if match else root)
    scheme, host, path = match.groups()
    try:
        return fs.FileSystem.from_uri(f"{STORES.get(scheme, scheme)}://{host or ''}{quote(path)}")
    except (ValueError, NotImplementedError):  # a store that only Hadoop's own classes know
        return fs.HadoopFileSystem(f"{scheme}://{host or ''}"), path


def shown(name: str) -> bool:
    return not name.startswith(("_", "."))


def folder_names(root: str, pattern: str = "*") -> list[str]:
    """The folders right below a folder."""
    system, base = opened(root)
    found = system.get_file_info(fs.FileSelector(base))
    names = [i.base_name for i in found if i.type == fs.FileType.Directory]
    return sorted(n for n in names if shown(n) and fnmatch.fnmatchcase(n, pattern))


def file_names(root: str, folder: str, pattern: str = "*") -> Iterator[list[str]]:
    """Names of the files right in a folder below the root, with the folder in front, some at a time."""
    system, base = opened(root)
    place = posixpath.join(base, folder) if folder else base
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(place) as entries:
            yield from _some(folder, (e.name for e in entries if e.is_file()), pattern)
    else:
        found = system.get_file_info(fs.FileSelector(place))
        yield from _some(folder, (i.base_name for i in found if i.type == fs.FileType.File), pattern)


def _some(folder: str, names: Iterator[str], pattern: str) -> Iterator[list[str]]:
    held = []
    for name in names:
        if shown(name) and fnmatch.fnmatchcase(name, pattern):
            held.append(f"{folder}/{name}" if folder else name)
            if len(held) == LISTED_AT_ONCE:
                yield held
                held = []
    if held:
        yield held
