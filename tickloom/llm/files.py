"""Files that Python tasks read and write themselves: any file system that pyarrow knows, local paths included."""

from __future__ import annotations

import io

import pyarrow.fs as pafs


def located(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        fs, inner = pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
        return fs, inner
    return pafs.LocalFileSystem(), path


def joined(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def reader(path: str, buffer: int = 1 << 20) -> io.BufferedReader:
    fs, inner = located(path)
    return io.BufferedReader(fs.open_input_file(inner), buffer)


def made(folder: str) -> None:
    fs, inner = located(folder)
    fs.create_dir(inner, recursive=True)
