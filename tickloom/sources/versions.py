"""Replacing a table that others read: a new version is written beside the old one, then a pointer is swapped.

A root with a pointer holds versions in folders of their own; readers follow the pointer once, when they are made, and so see
one version whatever is written meanwhile. A write that fails leaves the pointer, and a folder that the next write deletes.
The newest `keep` versions stay for readers that began before. Roots without a pointer are plain tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow.fs as pafs

from . import files

POINTER, VERSIONS = "_current.json", "_versions"


def current(root: str) -> str:
    """The folder that holds the table: that of its current version, or root itself."""
    told = files.read_json(f"{root}/{POINTER}")
    return f"{root}/{VERSIONS}/{told['version']}" if isinstance(told, dict) and "version" in told else root


def _swapped(root: str, version: str) -> None:
    fs, inner = files.located(f"{root}/{POINTER}")
    part = f"{inner}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as f:
        f.write(files.json_text({"version": version}).encode())
    try:
        fs.move(part, inner)  # replaces the old pointer at once
    except OSError:  # file systems that don't replace
        fs.delete_file(inner)
        fs.move(part, inner)


def replaced[T](root: str, write: Callable[[str], T], keep: int = 2) -> T:
    """Has write() make the next version in the folder that it is given, makes this the current one, and deletes versions beyond the newest `keep`.

    Data that lay in root before its first version stay until then, too. Writers of one root must not run at once."""
    if keep < 1:
        raise ValueError("keep must be positive")
    now = current(root)
    last = int(now.rpartition("/")[2].partition("-")[0]) if now != root else 0
    version = f"{last + 1:08d}-{uuid.uuid4().hex}"
    out = write(f"{root}/{VERSIONS}/{version}")
    _swapped(root, version)
    fs, inner = files.located(root)
    for x in fs.get_file_info(pafs.FileSelector(f"{inner}/{VERSIONS}")):
        number = int(x.base_name.partition("-")[0])
        if number <= last + 1 - keep or (number == last + 1 and x.base_name != version):
            fs.delete_dir(x.path)
    if last + 1 >= keep:
        for x in fs.get_file_info(pafs.FileSelector(inner)):
            if x.base_name not in (POINTER, VERSIONS):
                (fs.delete_dir if x.type == pafs.FileType.Directory else fs.delete_file)(x.path)
    return out
