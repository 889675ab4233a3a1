"""Parts of files in any store, for formats that are read by following their headers."""

from __future__ import annotations

import struct

from pyarrow import fs

_BLOCK = 1 << 16


class Unsupported(ValueError):
    """What a file has and its reader doesn't know, or a file that ends early."""


class RangedFile:
    """Reads at any place: ``raw`` as asked, calls by blocks that are kept, for headers."""

    def __init__(self, path: str):
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[5:]  # as Spark lists local files
        store, at = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(at)
        self.size = self.file.size()
        self.blocks: dict[int, bytes] = {}

    def raw(self, at: int, n: int) -> bytes:
        data = self.file.read_at(n, at)
        if len(data) < n:
            raise Unsupported("file ends early")
        return data

    def __call__(self, at: int, n: int) -> bytes:
        if at < 0 or at + n > self.size:
            raise Unsupported("file ends early")
        out = []
        for b in range(at // _BLOCK, (at + n - 1) // _BLOCK + 1):
            if b not in self.blocks:
                self.blocks[b] = self.file.read_at(_BLOCK, b * _BLOCK)
            out.append(self.blocks[b])
        start = at % _BLOCK
        return b"".join(out)[start : start + n]

    def ints(self, at: int, form: str) -> tuple:
        return struct.unpack("<" + form, self(at, struct.calcsize("<" + form)))
