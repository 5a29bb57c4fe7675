"""Sorted arrays in the shared folder, looked up through memory maps."""

from __future__ import annotations

import os
import uuid
from functools import lru_cache

import numpy as np
from pyarrow import fs


def distinct_runs(*sorted_arrays: np.ndarray) -> np.ndarray:
    """Where a new value (of any of the arrays) begins."""
    n = len(sorted_arrays[0])
    if not n:
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for x in sorted_arrays:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


class Store:
    """Arrays in the shared folder: written under a name of their own, then moved into place, so
    that a repeated or lost task leaves either the whole array or none."""

    def __init__(self, folder: str):
        self.folder = folder

    def _open(self) -> tuple[fs.FileSystem, str]:
        if self.folder.startswith("file:") or "://" not in self.folder:
            return fs.LocalFileSystem(), "/" + self.folder.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(self.folder)

    def write(self, name: str, array: np.ndarray) -> None:
        system, root = self._open()
        system.create_dir(root, recursive=True)
        temporary = f"{root}/.{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(temporary) as out:
            out.write(memoryview(np.ascontiguousarray(array)).cast("B") if len(array) else b"")
        system.move(temporary, f"{root}/{name}")

    def map(self, name: str, dtype: np.dtype) -> np.ndarray:
        """The array, memory-mapped; from a remote store it is read into memory."""
        system, root = self._open()
        path = f"{root}/{name}"
        if isinstance(system, fs.LocalFileSystem):
            return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
        with system.open_input_file(path) as f:
            return np.frombuffer(f.read(), dtype)


@lru_cache(maxsize=4096)
def opened(folder: str, name: str, part: int, dtype) -> np.ndarray:
    return Store(folder).map(f"{name}-{part}", np.dtype(dtype))


def look_up(folder: str, parts: np.ndarray, keys: np.ndarray, index: str, values: dict, have: list[int]) -> dict[str, np.ndarray]:
    """For each key the entries beside it in the arrays ``values`` (name to dtype) of its part;
    zeros where the part has no such key.  Keys are looked up in order, part by part."""
    out = {name: np.zeros(len(keys), dtype) for name, dtype in values.items()}
    order = np.lexsort((keys, parts))
    dealt = parts[order]
    for part, a, b in zip(have, np.searchsorted(dealt, have, "left"), np.searchsorted(dealt, have, "right")):
        there = opened(folder, index, part, "<u8") if a < b else ()
        if len(there):
            at = order[a:b]
            place = np.minimum(np.searchsorted(there, keys[at]), len(there) - 1)
            hit = there[place] == keys[at]
            for name, dtype in values.items():
                out[name][at[hit]] = opened(folder, name, part, dtype)[place[hit]]
    return out
