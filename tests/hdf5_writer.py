"""A small writer of HDF5 files (superblock 0, symbol tables, version 1 headers) for the tests of the reader."""

import struct
import zlib

import numpy as np

NONE = (1 << 64) - 1
TYPES = {"f": 1, "i": 0, "u": 0}


class Writer:
    def __init__(self):
        self.out = bytearray(96)
        self.heap_at = None

    def put(self, data: bytes) -> int:
        self.out += b"\0" * (-len(self.out) % 8)
        at = len(self.out)
        self.out += data
        return at

    def header(self, messages) -> int:
        body = b""
        for kind, data in messages:
            data += b"\0" * (-len(data) % 8)
            body += struct.pack("<HHB3x", kind, len(data), 0) + data
        # The last message goes to a block of its own, to be found by a continuation.
        cut = len(messages) > 2
        if cut:
            last = struct.pack("<HHB3x", messages[-1][0], len(messages[-1][1]) + -len(messages[-1][1]) % 8, 0) + messages[-1][1]
            last += b"\0" * (-len(messages[-1][1]) % 8)
            at = self.put(last)
            body = body[: len(body) - len(last)] + struct.pack("<HHB3xQQ", 0x10, 16, 0, at, len(last))
        return self.put(struct.pack("<BxHII4x", 1, len(messages) + cut, 1, len(body)) + body)

    @staticmethod
    def dtype(a) -> bytes:
        if a.dtype == object:
            return struct.pack("<B3BI", 0x19, 1, 0, 0, 16) + struct.pack("<B3BI", 0x13, 0, 0, 0, 1)
        if a.dtype.kind == "S":
            return struct.pack("<B3BI", 0x13, 0, 0, 0, a.dtype.itemsize)
        if a.dtype == bool:
            return struct.pack("<B3BI", 0x18, 2, 0, 0, 1) + struct.pack("<B3BIHH", 0x10, 8, 0, 0, 1, 0, 8)
        kind = TYPES[a.dtype.kind]
        big = a.dtype.byteorder == ">"
        bits = int(big) | (8 if a.dtype.kind == "i" else 0)
        more = struct.pack("<HH", 0, 8 * a.dtype.itemsize) if kind == 0 else struct.pack("<HHBBBBI", 0, 8 * a.dtype.itemsize, 52, 11, 0, 52, 1023)
        return struct.pack("<B3BI", 0x10 | kind, bits, 0, 0, a.dtype.itemsize) + more

    @staticmethod
    def space(shape) -> bytes:
        return struct.pack("<BBB5x", 1, len(shape), 0) + struct.pack(f"<{len(shape)}Q", *shape)

    def data(self, a) -> bytes:
        if a.dtype != object:
            return np.ascontiguousarray(a).view(np.uint8).tobytes() if a.dtype == bool else np.ascontiguousarray(a).tobytes()
        objects, refs = b"", []
        for k, text in enumerate(a.ravel().tolist(), 1):
            raw = text.encode()
            objects += struct.pack("<HHIQ", k, 1, 0, len(raw)) + raw + b"\0" * (-len(raw) % 8)
            refs.append((len(raw), k))
        at = self.put(b"GCOL\1\0\0\0" + struct.pack("<Q", 16 + len(objects) + 16) + objects + bytes(16))
        return b"".join(struct.pack("<IQI", n, at, k) for n, k in refs)

    def attribute(self, name: str, a) -> tuple[int, bytes]:
        a = np.asarray(a)
        n, t, s = name.encode() + b"\0", self.dtype(a), self.space(a.shape)
        pad = lambda x: x + b"\0" * (-len(x) % 8)
        return 12, struct.pack("<BxHHH", 1, len(n), len(t), len(s)) + pad(n) + pad(t) + pad(s) + self.data(a)

    def dataset(self, a, chunk=None, filters=(), attributes=None) -> int:
        a = np.asarray(a)
        messages = [(1, self.space(a.shape)), (3, self.dtype(a))]
        if chunk is None:
            raw = self.data(a)
            messages.append((8, struct.pack("<BBQQ", 3, 1, self.put(raw), len(raw))))
        else:
            size = a.dtype.itemsize
            keys = b""
            starts = np.array(np.meshgrid(*[range(0, n, c) for n, c in zip(a.shape, chunk)], indexing="ij")).reshape(a.ndim, -1).T
            for start in starts.tolist():
                block = np.zeros(chunk, a.dtype)
                part = a[tuple(slice(s, s + c) for s, c in zip(start, chunk))]
                block[tuple(slice(0, n) for n in part.shape)] = part
                raw = block.tobytes()
                for f in filters:
                    raw = np.frombuffer(raw, np.uint8).reshape(-1, size).T.tobytes() if f == 2 else zlib.compress(raw) if f == 1 else raw + b"sums"
                keys += struct.pack(f"<II{a.ndim + 1}Q", len(raw), 0, *start, 0) + struct.pack("<Q", self.put(raw))
            keys += struct.pack(f"<II{a.ndim + 1}Q", 0, 0, *a.shape, 0)
            tree = self.put(b"TREE" + struct.pack("<BBHQQ", 1, 0, len(starts), NONE, NONE) + keys)
            # An index of two levels.
            top = struct.pack(f"<II{a.ndim + 1}Q", 0, 0, *[0] * (a.ndim + 1)) + struct.pack("<Q", tree) + struct.pack(f"<II{a.ndim + 1}Q", 0, 0, *a.shape, 0)
            tree = self.put(b"TREE" + struct.pack("<BBHQQ", 1, 1, 1, NONE, NONE) + top)
            if filters:
                body = struct.pack("<BB6x", 1, len(filters))
                for f in filters:
                    args = [size] if f == 2 else [4] if f == 1 else []
                    body += struct.pack("<HHHH", f, 8, 0, len(args)) + b"filter\0\0" + struct.pack(f"<{len(args)}I", *args) + (b"\0" * 4 if len(args) % 2 else b"")
                messages.append((11, body))
            messages.append((8, struct.pack(f"<BBBQ{a.ndim + 1}I", 3, 2, a.ndim + 1, tree, *chunk, size)))
        return self.header([*messages, *[self.attribute(k, v) for k, v in (attributes or {}).items()]])

    def group(self, children: dict, attributes=None) -> int:
        names, offsets = b"\0" * 8, {}
        for name in children:
            offsets[name] = len(names)
            raw = name.encode() + b"\0"
            names += raw + b"\0" * (-len(raw) % 8)
        at = self.put(names)
        heap = self.put(b"HEAP" + struct.pack("<B3xQQQ", 0, len(names), 1, at))
        leaves = [sorted(children)[k : k + 4] for k in range(0, len(children), 4)]
        keys = b""
        for leaf in leaves:
            entries = b"".join(struct.pack("<QQII16x", offsets[n], children[n], 0, 0) for n in leaf)
            keys += struct.pack("<QQ", 0, self.put(b"SNOD" + struct.pack("<BxH", 1, len(leaf)) + entries))
        tree = self.put(b"TREE" + struct.pack("<BBHQQ", 0, 0, len(leaves), NONE, NONE) + keys + struct.pack("<Q", 0))
        return self.header([(0x11, struct.pack("<QQ", tree, heap)), *[self.attribute(k, v) for k, v in (attributes or {}).items()]])

    def tree(self, nested: dict, attributes=None) -> int:
        """nested: names to arrays, to (array, options of ``dataset``) or to further names."""
        made = {}
        for name, v in nested.items():
            made[name] = self.tree(v) if isinstance(v, dict) else self.dataset(v[0], **v[1]) if isinstance(v, tuple) else self.dataset(v)
        return self.group(made, attributes)

    def save(self, path, root: int) -> None:
        head = b"\x89HDF\r\n\x1a\n" + struct.pack("<8BHHI", 0, 0, 0, 0, 0, 8, 8, 0, 4, 16, 0) + struct.pack("<4Q", 0, NONE, len(self.out), NONE) + struct.pack("<QQII16x", 0, root, 0, 0)
        self.out[: len(head)] = head
        path.write_bytes(bytes(self.out))


def write(path, nested: dict, attributes=None) -> None:
    w = Writer()
    w.save(path, w.tree(nested, attributes))
