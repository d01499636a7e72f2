"""Records of frames: checked framing, and Example messages whose features are tensors with their shapes."""

from __future__ import annotations

import math
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa

#: Keys of a frame: kind, NumPy type of the values, and the last dimension of tables. Fixed values.
KEYS = {
    "rgb": ("image", "uint8", 3), "rgb_R": ("image", "uint8", 3), "depth": ("image", "float32", 1), "depth_R": ("image", "float32", 1),
    "depth_gt": ("image", "float32", 1), "depth_gt_R": ("image", "float32", 1), "mask": ("image", "int32", 1),
    "cam_matrix": ("table", "float32", 3), "cam_location": ("list", "float32", 0), "cam_rotation": ("list", "float32", 0), "stereo_baseline": ("scalar", "float32", 0),
    "obj_classes": ("list", "str", 0), "obj_ids": ("list", "int32", 0), "obj_pos": ("table", "float32", 3), "obj_rot": ("table", "float32", 4),
    "obj_bbox_visib": ("table", "int32", 4), "obj_visib_fract": ("list", "float32", 0), "obj_px_count_visib": ("list", "int32", 0),
    "obj_px_count_valid": ("list", "int32", 0), "obj_px_count_all": ("list", "int32", 0), "obj_bbox_obj": ("table", "int32", 4),
}

#: Numbers of the value types in a serialised tensor. Fixed values.
TYPE_NUMBERS = {"float32": 1, "int32": 3, "uint8": 4, "str": 7}
_TYPE_NAMES = {n: name for name, n in TYPE_NUMBERS.items()}
#: Where a tensor keeps its values if they aren't one run of bytes: field number and how an element is read.
_LISTED = {1: (5, "<f4"), 3: (7, None), 4: (7, None)}

_SPARK = {"float32": "float", "int32": "int", "str": "string"}
IMAGE = "struct<height:int,width:int,channels:int,dtype:string,data:binary>"


def spark_type(key: str) -> str:
    kind, value, _ = KEYS[key]
    if kind == "image":
        return IMAGE
    one = _SPARK[value]
    return {"scalar": one, "list": f"array<{one}>", "table": f"array<array<{one}>>"}[kind]


# --- CRC-32C ------------------------------------------------------------------------------------------------------


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0x82F63B78), c >> np.uint32(1))
    return c


_TABLE = _crc_table()
_TABLE_LIST = _TABLE.tolist()


@cache
def _after_zeros(n: int) -> list[list[int]]:
    """What n zero bytes make of a register, by each of its four bytes."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    for _ in range(n):
        state = _TABLE[state & np.uint32(255)] ^ (state >> np.uint32(8))
    return state.reshape(4, 256).tolist()


def crc32c(data: bytes | memoryview) -> int:
    """Long data is cut into blocks whose registers run side by side; a register's way through a block is linear."""
    c, n = 0xFFFFFFFF, len(data)
    if n >= 1024:
        size = 64 if n < 65_536 else 1024
        blocks = n // size
        columns = np.frombuffer(data, np.uint8, blocks * size).reshape(blocks, size).T
        state = np.zeros(blocks, np.uint32)
        for column in np.ascontiguousarray(columns):
            state = _TABLE[(state ^ column) & np.uint32(255)] ^ (state >> np.uint32(8))
        a, b, d, e = _after_zeros(size)
        for s in state.tolist():
            c = a[c & 255] ^ b[c >> 8 & 255] ^ d[c >> 16 & 255] ^ e[c >> 24] ^ s
        data = data[blocks * size :]
    for x in bytes(data):
        c = _TABLE_LIST[(c ^ x) & 255] ^ c >> 8
    return c ^ 0xFFFFFFFF


def masked_crc(data: bytes | memoryview) -> int:
    c = crc32c(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


_BLOCK, _LONG = 64, 1 << 16


def masked_crcs(parts: list[bytes]) -> list[int]:
    """masked_crc() of each part. The blocks of all short parts run side by side."""
    out = [masked_crc(d) if not 4 <= len(d) < _LONG else 0 for d in parts]
    short = [i for i, d in enumerate(parts) if 4 <= len(d) < _LONG]
    if not short:
        return out
    sizes = np.array([len(parts[i]) for i in short])
    blocks = -(-sizes // _BLOCK)
    end = np.cumsum(blocks)
    padded = np.frombuffer(bytearray().join(x for i in short for x in (bytes(-len(parts[i]) % _BLOCK), parts[i])), np.uint8).copy()
    start = end * _BLOCK - sizes  # zeros before a part leave a register of zero as it is; its first value, all ones, is put into the part
    for k in range(4):
        padded[start + k] ^= 255
    state = np.zeros(len(padded) // _BLOCK, np.uint32)
    for column in np.ascontiguousarray(padded.reshape(-1, _BLOCK).T):
        state = _TABLE[(state ^ column) & np.uint32(255)] ^ (state >> np.uint32(8))
    a, b, d, e = (np.array(t, np.uint32) for t in _after_zeros(_BLOCK))
    c, first = np.zeros(len(short), np.uint32), end - blocks
    for k in range(int(blocks.max())):
        on = np.nonzero(blocks > k)[0]
        x = c[on]
        c[on] = a[x & 255] ^ b[x >> 8 & 255] ^ d[x >> 16 & 255] ^ e[x >> 24] ^ state[first[on] + k]
    c = (c ^ np.uint32(0xFFFFFFFF)).astype(np.uint64)
    for i, x in zip(short, (((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF).tolist()):
        out[i] = x
    return out


# --- framing ------------------------------------------------------------------------------------------------------


def frame_record(data: bytes) -> bytes:
    size = struct.pack("<Q", len(data))
    return size + struct.pack("<I", masked_crc(size)) + data + struct.pack("<I", masked_crc(data))


def frame_records(parts: list[bytes]) -> list[bytes]:
    """frame_record() of each part."""
    return [size + _crc_of_length(size) + d + struct.pack("<I", c) for d, c in zip(parts, masked_crcs(parts)) for size in (struct.pack("<Q", len(d)),)]


@lru_cache(4096)
def _crc_of_length(size: bytes) -> bytes:
    return struct.pack("<I", masked_crc(size))


def records(pieces: Iterable[bytes], name: str) -> Iterator[bytes]:
    """Records of a compressed shard, given piece by piece; a shard that is cut off or damaged is an error."""
    unzip, held, at = zlib.decompressobj(), bytearray(), 0
    for piece in pieces:
        held += unzip.decompress(piece)
        whole: list[bytes] = []
        checks: list[int] = []
        while len(held) - at >= 12:
            size = struct.unpack_from("<Q", held, at)[0]
            if held[at + 8 : at + 12] != _crc_of_length(bytes(held[at : at + 8])):
                raise ValueError(f"{name}: a record's length is damaged")
            if len(held) - at < 16 + size:
                break
            whole.append(bytes(held[at + 12 : at + 12 + size]))
            checks.append(struct.unpack_from("<I", held, at + 12 + size)[0])
            at += 16 + size
        for data, wanted, found in zip(whole, checks, masked_crcs(whole)):
            if wanted != found:
                raise ValueError(f"{name}: a record is damaged")
            yield data
        if at > 1 << 20:
            del held[:at]
            at = 0
    if len(held) > at or not unzip.eof:
        raise ValueError(f"{name}: the shard is cut off")


# --- messages -----------------------------------------------------------------------------------------------------


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _fields(data: memoryview) -> Iterator[tuple[int, memoryview | int]]:
    """(number, value) of a wire message; values of fixed width come as their bytes."""
    at, end = 0, len(data)
    while at < end:
        tag, at = _read_varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _read_varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _read_varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def _read_varint(data: memoryview, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            return n, at


def encode_tensor(values: np.ndarray | list[str]) -> bytes:
    """A tensor with its shape; strings make a list."""
    text = isinstance(values, list)
    sizes = [len(values)] if text else values.shape
    shape = b"".join(_field(2, b"\x08" + _varint(n) if n else b"") for n in sizes)
    kind = TYPE_NUMBERS["str" if text else values.dtype.name]
    content = b"".join(_field(8, v.encode()) for v in values) if text else _field(4, np.ascontiguousarray(values).tobytes())
    return b"\x08" + _varint(kind) + _field(2, shape) + content


def decode_tensor(data: memoryview) -> np.ndarray | list[str]:
    kind, sizes, content, listed, texts = 0, [], None, [], []
    for number, value in _fields(data):
        if number == 1:
            kind = value
        elif number == 2:
            sizes = [next((x for k, x in _fields(d) if k == 1), 0) for n, d in _fields(value) if n == 2]
        elif number == 4:
            content = value
        elif number == 8:
            texts.append(bytes(value).decode())
        elif kind in _LISTED and number == _LISTED[kind][0]:
            listed.append(value)
    if kind == TYPE_NUMBERS["str"]:
        return texts
    if kind not in _TYPE_NAMES:
        raise ValueError(f"a tensor of type {kind} is not read")
    name = _TYPE_NAMES[kind]
    if content is None or not len(content) and listed:
        content = _listed(kind, listed, int(np.prod(sizes)), name)
    return np.frombuffer(content, np.dtype(name).newbyteorder("<")).astype(name, copy=False).reshape(sizes)


def _listed(kind: int, parts: list, n: int, name: str) -> bytes:
    """Values that are given one by one or packed; the last one stands for all that are missing."""
    found: list = []
    for part in parts:
        if isinstance(part, int):
            found.append(part)
        elif _LISTED[kind][1]:
            found += np.frombuffer(part, _LISTED[kind][1]).tolist()
        else:
            at = 0
            while at < len(part):
                value, at = _read_varint(part, at)
                found.append(value)
    found = [x - (1 << 64) if isinstance(x, int) and x >> 63 else x for x in found]
    return np.array(found + [found[-1] if found else 0] * (n - len(found)), name).tobytes()


def to_tensor(key: str, value) -> np.ndarray | list[str]:
    """A Spark value of a key as a tensor; tables may also come as one list. Nulls inside become empty texts, NaN, or 0."""
    kind, name, width = KEYS[key]
    if kind == "image":
        image = np.frombuffer(value["data"], value["dtype"])
        shape = (value["height"], value["width"], value["channels"])
        return image.reshape(shape if width > 1 else shape[:2]).astype(name, copy=False)
    if name == "str":
        return ["" if v is None else v for v in value]
    if kind == "table":
        value = [[None] * width if v is None and value and isinstance(next((x for x in value if x is not None), None), list) else v for v in value]
    made = np.asarray(value, "float64" if name == "float32" else object)
    if made.dtype == object:
        made = np.where(made == None, 0, made)  # noqa: E711
    made = made.astype(name)
    return made.reshape(-1, width) if kind == "table" else made


def from_tensor(key: str, tensor: np.ndarray | list[str]):
    """The Spark value of a tensor, whose values must be of the key's type (masks may be bytes)."""
    kind, name, width = KEYS[key]
    if isinstance(tensor, list) != (name == "str") or (name != "str" and tensor.dtype.name != name and not (key == "mask" and tensor.dtype.name == "uint8")):
        raise ValueError(f"{key} holds values of another type than {name}")
    if kind == "image":
        height, across, channels = (*tensor.shape, 1)[:3]
        return {"height": height, "width": across, "channels": channels, "dtype": tensor.dtype.name, "data": np.ascontiguousarray(tensor).tobytes()}
    if name == "str":
        return tensor
    if kind == "table":
        return tensor.reshape(-1, width).tolist()
    return tensor.ravel()[0].item() if kind == "scalar" else tensor.ravel().tolist()


def encode_example(row: dict) -> bytes:
    """An Example of the keys that are not null."""
    features = b""
    for key in KEYS:
        if row.get(key) is not None:
            value = _field(1, _field(1, encode_tensor(to_tensor(key, row[key]))))
            features += _field(1, _field(1, key.encode()) + _field(2, value))
    return _field(1, features)


def _features(data: bytes) -> Iterator[tuple[str, memoryview]]:
    for _, features in _fields(memoryview(data)):
        for _, entry in _fields(features):
            parts = dict(_fields(entry))
            yield bytes(parts[1]).decode(), parts.get(2, memoryview(b""))


def keys_of(data: bytes) -> list[str]:
    return [key for key, _ in _features(data) if key in KEYS]


def decode_example(data: bytes, keys: Iterable[str]) -> dict:
    """Spark values of the keys that the Example holds; other features are passed over undecoded."""
    out = {}
    for key, feature in _features(data):
        if key in keys:
            values = next((v for n, v in _fields(feature) if n == 1), memoryview(b""))
            tensor = next((v for n, v in _fields(values) if n == 1), None)
            if tensor is not None:
                out[key] = from_tensor(key, decode_tensor(tensor))
    return out


# --- many messages at once ----------------------------------------------------------------------------------------


def arrow_type(key: str) -> pa.DataType:
    one = {"float": pa.float32(), "int": pa.int32(), "string": pa.string()}
    image = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("dtype", pa.string()), ("data", pa.binary())])

    def kind(name: str) -> pa.DataType:
        return image if name.startswith("struct") else pa.list_(kind(name[6:-1])) if name.startswith("array") else one[name]

    return kind(spark_type(key))


def _places(data: bytes, at: int, end: int) -> list[tuple[int, int, int, int]]:
    """(number, value, start, end) of each field of a wire message; only varints have a value, the others have their bytes' place."""
    out = []
    while at < end:
        tag, at = _read_varint(data, at)
        if tag & 7 == 0:
            value, at = _read_varint(data, at)
            out.append((tag >> 3, value, at, at))
            continue
        size = {1: 8, 5: 4}.get(tag & 7)
        if size is None:
            size, at = _read_varint(data, at)
        out.append((tag >> 3, 0, at, at + size))
        at += size
    return out


def layout(data: bytes, keys: Iterable[str]) -> dict[str, list[tuple[int, int]]] | None:
    """Where an Example holds the values of each feature: one place of numbers, or one for each text. None if it is to be read one by one.

    Features without a key of `keys` have one place, all of their value. Images, and whatever encode_example() wouldn't write so, are read one by one.
    """
    try:
        ((_, _, at, end),) = _places(data, 0, len(data))
        out: dict[str, list[tuple[int, int]]] = {}
        for _, _, a, b in _places(data, at, end):
            (one, _, ka, kb), (two, _, va, vb) = _places(data, a, b)
            key = data[ka:kb].decode()
            if (one, two) != (1, 2) or key in out:
                return None
            if key not in keys:
                out[key] = [(va, vb)]
                continue
            kind, name, width = KEYS[key]
            if kind == "image":
                return None
            ((n, _, a, b),) = _places(data, va, vb)
            ((m, _, a, b),) = _places(data, a, b)
            (t, number, _, _), (h, _, sa, sb), *content = _places(data, a, b)
            if (n, m, t, h, number) != (1, 1, 1, 2, TYPE_NUMBERS[name]) or any(c[0] != (8 if name == "str" else 4) for c in content):
                return None
            places = [(ca, cb) for _, _, ca, cb in content]
            if name != "str":
                sizes = [next((v for k, v, _, _ in _places(data, da, db) if k == 1), 0) for d, _, da, db in _places(data, sa, sb) if d == 2]
                ((ca, cb),) = places
                if cb - ca != 4 * math.prod(sizes) or kind == "table" and (cb - ca) % (4 * width) or kind == "scalar" and ca == cb:
                    return None
            out[key] = places
        return out
    except (ValueError, IndexError):
        return None


def _lists(values: pa.Array, size: int) -> pa.Array:
    """The values cut into lists of one size."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) // size + 1, dtype=np.int32) * size), values)


def _column(key: str, rows: np.ndarray, places: list[tuple[int, int]]) -> pa.Array:
    """Arrow values of a key in messages of one layout, a row of bytes each."""
    kind, name, width = KEYS[key]
    m = len(rows)
    if name == "str":
        data = np.concatenate([rows[:, a:b] for a, b in places], axis=1) if places else np.zeros((m, 0), np.uint8)
        ends = np.cumsum(np.tile([b - a for a, b in places], m)) if places else np.zeros(0, int)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        texts = pa.StringArray.from_buffers(m * len(places), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
        texts.validate(full=True)
        return _lists(texts, len(places)) if places else pa.array([[]] * m, pa.list_(pa.string()))
    ((a, b),) = places
    numbers = np.ascontiguousarray(rows[:, a:b]).view(np.dtype(name).newbyteorder("<")).astype(name, copy=False)
    if kind == "scalar":
        return pa.array(numbers[:, 0])
    n = numbers.shape[1] // (width or 1)
    if n == 0:
        return pa.array([[]] * m, arrow_type(key))
    flat = pa.array(numbers.ravel())
    return _lists(_lists(flat, width), n) if kind == "table" else _lists(flat, n)


#: So many bytes of messages of one length are taken apart at a time.
_TOGETHER = 8 << 20


def decode_examples(data: list[bytes], keys: list[str]) -> list[pa.Array]:
    """The keys of decode_example() as Arrow columns, for many Examples.

    Of those of one length the first one tells where values lie; all that are like it outside of these places are read with it.
    """
    by_size, order, parts = defaultdict(list), [], {k: [] for k in keys}
    for i, d in enumerate(data):
        by_size[len(d)].append(i)
    single: list[int] = []
    for size, all_of_size in by_size.items():
        step = max(1, _TOGETHER // max(1, size))
        for at in range(0, len(all_of_size), step):
            left = np.array(all_of_size[at : at + step])
            while len(left):
                places = layout(data[left[0]], keys)
                if places is None:
                    single.append(int(left[0]))
                    left = left[1:]
                    continue
                rows = np.frombuffer(b"".join([data[i] for i in left]), np.uint8).reshape(len(left), size)
                fixed = np.ones(size, bool)
                for of_key in places.values():
                    for a, b in of_key:
                        fixed[a:b] = False
                like = (rows[:, fixed] == rows[0, fixed]).all(axis=1)
                order += left[like].tolist()
                for k in keys:
                    parts[k].append(_column(k, rows[like], places[k]) if k in places else pa.nulls(int(like.sum()), arrow_type(k)))
                left = left[~like]
    if single:
        made = [decode_example(data[i], keys) for i in single]
        order += single
        for k in keys:
            parts[k].append(pa.array([x.get(k) for x in made], arrow_type(k)))
    back = pa.array(np.argsort(np.array(order, np.int64), kind="stable"))
    return [pa.concat_arrays(parts[k]).take(back) if data else pa.array([], arrow_type(k)) for k in keys]


def _flat(key: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array] | None:
    """Which rows are null, the starts and ends of the others' values, and all values; None for what is written one by one."""
    kind, name, width = KEYS[key]
    null = np.asarray(column.is_null())
    if kind == "scalar" or kind == "image" or not pa.types.is_list(column.type):
        return None
    offsets, values = np.asarray(column.offsets), column.values
    if kind == "table":
        if not pa.types.is_list(values.type) or values.null_count or (len(values) and (np.diff(np.asarray(values.offsets)) != width).any()):
            return None
        inner = np.asarray(values.offsets)
        offsets, values = inner[offsets], values.values
    good = {"float32": (pa.float32(), pa.float64()), "int32": (pa.int32(),), "str": (pa.string(),)}[name]
    if values.type not in good or values.null_count:
        return None
    return null, offsets[:-1], offsets[1:], values


def encode_examples(columns: dict[str, pa.Array]) -> list[bytes]:
    """encode_example() of each row of the columns. Rows whose lists have the same sizes are written together, like the first of them."""
    columns = {k: columns[k] for k in KEYS if k in columns}
    m = len(next(iter(columns.values()))) if columns else 0
    flat = {k: _flat(k, c) for k, c in columns.items()}
    one_by_one = [k for k, f in flat.items() if f is None and columns[k].null_count < m]
    row = lambda i: {k: c[i].as_py() for k, c in columns.items()}
    if one_by_one or not columns:
        return [encode_example(row(i)) for i in range(m)]
    flat = {k: f for k, f in flat.items() if f is not None}
    marks, texts = [], {}
    for k, (null, starts, ends, values) in flat.items():
        marks.append(np.where(null, -1, ends - starts))
        if KEYS[k][1] == "str":
            at = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int32)
            texts[k] = at, np.frombuffer(values.buffers()[2] or b"", np.uint8)
    alike = defaultdict(list)
    signs = np.stack(marks, axis=1) if marks else np.zeros((m, 0), int)
    lengths = [(np.diff(at), flat[k][1].tolist(), flat[k][2].tolist()) for k, (at, _) in texts.items()]
    for i in range(m):
        alike[(signs[i].tobytes(), *(of[a[i] : b[i]].tobytes() for of, a, b in lengths))].append(i)
    out: list[bytes] = [b""] * m
    for same in alike.values():
        first = encode_example(row(same[0]))
        out[same[0]] = first
        if len(same) == 1:
            continue
        places, rows = layout(first, KEYS), np.array(same)
        if places is None:
            for i in same[1:]:
                out[i] = encode_example(row(i))
            continue
        made = np.tile(np.frombuffer(first, np.uint8), (len(rows), 1))
        for k, of_key in places.items():
            _, starts, _, values = flat[k]
            if k in texts:
                at, data = texts[k]
                for slot, (a, b) in enumerate(of_key):
                    made[:, a:b] = data[at[starts[rows] + slot][:, None] + np.arange(b - a)]
                continue
            ((a, b),) = of_key
            numbers = np.asarray(values)[starts[rows][:, None] + np.arange((b - a) // 4)]
            made[:, a:b] = np.ascontiguousarray(numbers.astype(np.dtype(KEYS[k][1]).newbyteorder("<"))).view(np.uint8).reshape(len(rows), -1)
        whole, size = made.tobytes(), len(first)
        for j, i in enumerate(same):
            out[i] = whole[j * size : (j + 1) * size]
    return out
