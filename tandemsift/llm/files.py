"""Arrays and byte files in the shared folder, written once by whichever task ends first."""

from __future__ import annotations

import io
import os
import uuid

import numpy as np
from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri if not uri.startswith("file:/") or uri.startswith("file://") else "file://" + uri[5:])
    return system, path


def save_bytes(folder: str, name: str, data: bytes | memoryview) -> None:
    """Writes a file under a name of this attempt's own, then renames it: a repeated task does no harm."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    own = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(own, compression=None) as out:
        out.write(data)
    system.move(own, f"{path}/{name}")


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    held = io.BytesIO()
    np.save(held, np.ascontiguousarray(array))
    save_bytes(folder, f"{name}.npy", held.getbuffer())


def map_array(folder: str, name: str) -> np.ndarray:
    """The array, memory-mapped where the shared folder is mounted, else read."""
    system, path = opened(folder)
    path = f"{path}/{name}.npy"
    if isinstance(system, fs.LocalFileSystem) and os.path.exists(path):
        return np.load(path, mmap_mode="r")
    with system.open_input_file(path) as f:
        return np.load(io.BytesIO(f.read()))
