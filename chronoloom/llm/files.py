"""Files in the shared folder, opened by the tasks themselves through Arrow's file systems."""

from __future__ import annotations

import os

from pyarrow import NativeFile, fs


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path.removeprefix('file:'))}")


def open_out(path: str) -> NativeFile:
    """A new file to be written in order; its folder is made if need be."""
    system, place = _place(path)
    system.create_dir(os.path.dirname(place), recursive=True)
    return system.open_output_stream(place)


def open_in(path: str) -> NativeFile:
    """A file of which any range can be read."""
    system, place = _place(path)
    return system.open_input_file(place)
