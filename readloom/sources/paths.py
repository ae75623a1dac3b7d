"""Files at plain paths or URIs, opened where they are read or written: on executors as on the driver."""

from __future__ import annotations

import io
import os
from typing import BinaryIO

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it: file, hdfs, s3, gs and others that Arrow knows; a path without a scheme is local."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def listed(path: str) -> list[str]:
    """The files that a path stands for: itself, those in a folder, or those that match a pattern with * in its last part; sorted."""
    system, at = located(path)
    folder, last = at.rsplit("/", 1)
    if "*" in last:
        import fnmatch

        names = [i.path for i in system.get_file_info(fs.FileSelector(folder)) if i.is_file and fnmatch.fnmatch(i.base_name, last)]
    elif system.get_file_info(at).type == fs.FileType.Directory:
        names = [i.path for i in system.get_file_info(fs.FileSelector(at)) if i.is_file and not i.base_name.startswith(("_", "."))]
    else:
        return [path]
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    return sorted(scheme + n for n in names)


def open_input(path: str, plain: bool = False) -> BinaryIO:
    """The file's bytes, inflated if its name ends in .gz, .bz2 or .zst, unless plain."""
    system, at = located(path)
    kind = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}.get(os.path.splitext(at)[1])
    return system.open_input_stream(at, compression=None if plain else kind, buffer_size=1 << 20)


def size_of(path: str) -> int:
    system, at = located(path)
    return system.get_file_info(at).size


def open_seekable(path: str) -> BinaryIO:
    """The file's bytes as they are, to be read from any place; small reads are served from a buffer."""
    system, at = located(path)
    return io.BufferedReader(system.open_input_file(at), 1 << 18)


def open_output(path: str) -> BinaryIO:
    system, at = located(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(at, compression=None, buffer_size=1 << 20)
