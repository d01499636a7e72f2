"""Line dedup: fuzzy lines by MinHash, exact Jaccard verification, and one line kept for each component.

A line is normalised (trimmed, white space collapsed, A-Z lowered) and ended by SHINGLE - 1 blank marks, so that a
line of n characters has n shingles of SHINGLE characters. Each distinct line gets one-permutation MinHash
minima, empty bins filled from full ones (optimal densification; Shrivastava, 2017), cut into BANDS bands of ROWS (recall
0.995 at a Jaccard similarity of 0.8, 0.99998 at 0.85; short shingles make unrelated lines more alike, so a band has
eight rows). Equal lines count once. Lines with a band in common are a bucket. First each line is compared with
the smallest hash of each of its buckets, and union-find joins what is linked. Then, where the other lines of a bucket are
not yet one component, all pairs of different components among them are compared; of buckets with the same lines (by 128
bits of their hashes) one stands for all. Compared are signatures first: the parities of SIGNS classes of a line's shingles
differ in no more places than the shingle sets do, so this loses no link, and texts are shuffled only of pairs that may
be similar. Those are verified many at a time. Where a run of rows has more of them than FEW a line, its lines
are dealt out by text, as pairs of tiles of TILE lines or TILE_CHARS characters at most, those of more than SMALL lines by rows of bits over
the shingles met there, and a task gives a spanning forest of its links. So no link between lines of a bucket is lost, and pairs are never tried beyond a bucket. Links need an exact
Jaccard similarity of THRESHOLD over the shingle sets. The first line of each component by doc_id and line number stays.

Defined results: null and empty texts have one blank line; blank lines are never duplicates and stay; rows with
the same doc_id share their places, so equal lines at the same place of such rows all stay or all go; lines of rows
with a null doc_id come after all others; an empty table gives an empty result; texts and
lines of any length are read whole; further columns are ignored (line_report) or kept (dedup_lines). Lines are equal if
their 64-bit hashes are: with 1e9 distinct lines the chance that any two collide is 0.03.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bits import bit_table, holds
from .common import shared, slices, table, texts_of, written
from .components import connected_components, spanning_stars

SHINGLE = 4  # a power of two; longer ones make one replaced word fatal for lines of 10 to 19 words
BANDS, ROWS = 29, 8
THRESHOLD = 0.8
_BINS = BANDS * ROWS
TILE, TILE_CHARS = 256, 4_000_000
SMALL = 12  # lines of a bucket whose pairs are verified one by one, with those of other buckets
_PAIR_CHARS = 1_000_000
KEY_BITS = 43  # of a band key: 11 for its part, 32 packed beside the 64 of the line's hash
PACKED, RUN = 1 << 20, 2048  # band keys that are sorted and packed together, and the most of them in one row
_RUNS = "part int, key long, h long, keys binary, hashes binary"
SIGNS, FEW = 512, 4
_SIGNS = [f"s{i}" for i in range(SIGNS // 64)]
_FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]


_SPACES = bytes.maketrans(b"\t\r\x0b\x0c", b"    ")


def normals(text: str) -> list[bytes]:
    """The lines of a text, normalised."""
    lines = [x.strip(b" ") for x in text.encode().lower().translate(_SPACES).split(b"\n")]
    return [b" ".join(x.split()) if b"  " in x else x for x in lines]


def normal(line: str) -> bytes:
    return b" ".join(line.encode().lower().split())


def line_hash(line: bytes) -> int:
    return xxhash.xxh64_intdigest(line, 5) - (1 << 63)


def _donors(hop: int) -> np.ndarray:
    """For each bin the one that is looked at in a hop, if it is empty; before the first hop it is the bin itself."""
    bin_ = np.arange(_BINS)
    if not hop:
        return bin_
    return (bin_ * 7919 + hop * hop * 104729 + hop * bin_ * 1299709) % 1000003 % _BINS


_DONORS = np.stack([_donors(hop) for hop in range(4 * _BINS)])


def _code_points(lines: list[bytes], after: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points (uint32) of lines with SHINGLE - 1 marks between them and so many after them, and their numbers of characters."""
    text = (b"\0" * (SHINGLE - 1)).join(lines) + b"\0" * after
    if text.isascii():
        return np.frombuffer(text, np.uint8).astype(np.uint32), np.fromiter(map(len, lines), np.int64, len(lines))
    return np.frombuffer(text.decode().encode("utf-32-le"), np.uint32), np.array([len(x.decode()) for x in lines])


def band_keys(lines: list[bytes]) -> np.ndarray:
    """Band keys (len(lines) x BANDS, int64) of normalised lines."""
    if not lines:
        return np.zeros((0, BANDS), np.int64)
    c, sizes = _code_points(lines, 2 * SHINGLE)
    h, step, factor = c * np.uint32(0x9E3779B1), 1, 0x01000193
    while step < SHINGLE:
        h = h[:-step] + h[step:] * np.uint32(factor)
        factor = factor * factor & 0xFFFFFFFF
        step *= 2
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    line = np.repeat(np.arange(len(lines)), sizes)
    h = h[np.arange(len(line)) + (SHINGLE - 1) * line]  # without those that begin in marks
    bins = (h.astype(np.uint64) * np.uint64(_BINS) >> np.uint64(32)).view(np.int64) * len(lines) + line
    first = np.full(len(lines) * _BINS, 0xFFFFFFFF, np.uint32)
    np.minimum.at(first, bins, h * np.uint32(0xC2B2AE35) >> np.uint32(1))
    first = first.reshape(_BINS, -1)
    full = first != 0xFFFFFFFF
    empty, hops, hop = ~full, np.zeros(full.shape, np.uint8), 1
    # An empty bin takes that of a full one, each looking in an order of its own: all bins at a time, then the few that are left.
    while hop < 256 and np.count_nonzero(empty) * 25 > empty.size:
        met = empty & full[_DONORS[hop]]
        hops |= met.view(np.uint8) * np.uint8(hop)
        empty ^= met
        hop += 1
    donor = _DONORS[hops, np.arange(_BINS)[:, None]] * len(lines) + np.arange(len(lines))
    least = first.reshape(-1)[donor] + (hops.astype(np.uint64) << np.uint64(33))
    bin_, i = np.nonzero(empty)
    for hop in range(hop, 4 * _BINS):
        if not len(i):
            break
        donor = _DONORS[hop][bin_]
        met = full[donor, i]
        least[bin_[met], i[met]] = first[donor[met], i[met]] + np.uint64(hop << 33)
        i, bin_ = i[~met], bin_[~met]
    keys = np.zeros((BANDS, len(lines)), np.uint64)
    for r in range(ROWS):
        keys = (keys ^ least[r * BANDS : (r + 1) * BANDS]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(31)
    return (keys + np.arange(BANDS, dtype=np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93)).view(np.int64).T


def _keys_in_parts(lines: list[bytes], most: int = 500_000) -> np.ndarray:
    """band_keys of so many bytes of lines at a time."""
    parts, start, size = [band_keys([])], 0, 0
    for i, line in enumerate(lines):
        size += len(line)
        if size >= most or i + 1 == len(lines):
            parts.append(band_keys(lines[start : i + 1]))
            start, size = i + 1, 0
    return np.concatenate(parts)


def shingles(line: bytes) -> set[str]:
    s = line.decode() + "\0" * (SHINGLE - 1)
    return {s[i : i + SHINGLE] for i in range(len(s) - SHINGLE + 1)}


def jaccard(a: bytes, b: bytes) -> float:
    x, y = shingles(a), shingles(b)
    both = len(x & y)
    return both / max(1, len(x) + len(y) - both)


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, h for each line that isn't blank."""

    def work(batches):
        for batch in batches:
            for start, _, texts in slices(batch):
                ids, numbers, hashes = [], [], []
                for i, text in enumerate(texts):
                    doc_id = batch.column("doc_id")[start + i].as_py()
                    for n, line in enumerate(normals(text)):
                        if line:
                            ids.append(doc_id)
                            numbers.append(n)
                            hashes.append(line_hash(line))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(hashes, pa.int64())], names=["doc_id", "line_no", "h"])

    return texts_of(docs).mapInArrow(work, "doc_id long, line_no int, h long")


def _ordered(k: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """k, h sorted by k, then h."""
    if len(k) <= 1 << (64 - KEY_BITS):  # a key and a place are one number
        order = k << np.uint64(64 - KEY_BITS) | np.arange(len(k), dtype=np.uint64)
        order.sort()
        k, h = order >> np.uint64(64 - KEY_BITS), h[(order & np.uint64((1 << (64 - KEY_BITS)) - 1)).view(np.int64)]
    else:
        order = np.argsort(k)
        k, h = k[order], h[order]
    same = k[1:] == k[:-1]
    tied = np.zeros(len(k), bool)
    tied[1:] |= same
    tied[:-1] |= same
    at = np.flatnonzero(tied)
    h[at] = h[at][np.lexsort((h[at], k[at]))]
    return k, h


def _runs(pieces):
    """Sorted runs of the rows of (key, h) arrays, as batches of their part, first row and packed rows; of RUN rows at most."""

    def packed(k, h):
        k, h = _ordered(np.concatenate(k).view(np.uint64) & np.uint64((1 << KEY_BITS) - 1), np.concatenate(h))
        part, i = (k >> np.uint64(32)).astype(np.int32), np.arange(len(k))
        begins = np.maximum.accumulate(np.where(np.append(True, part[1:] != part[:-1]), i, 0))
        at = np.flatnonzero((i - begins) % RUN == 0)
        ends = np.append(at, len(k)).astype(np.int32)
        low = k.astype(np.uint32)
        binary = lambda x: pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends * np.int32(x.itemsize)), pa.py_buffer(x)])
        return pa.RecordBatch.from_arrays([pa.array(part[at]), pa.array(low[at].astype(np.int64)), pa.array(h[at]), binary(low), binary(h)], names=["part", "key", "h", "keys", "hashes"])

    k, h, size = [], [], 0
    for more_k, more_h in pieces:
        k.append(more_k)
        h.append(more_h)
        size += len(more_k)
        if size >= PACKED:
            yield packed(k, h)
            k, h, size = [], [], 0
    if size:
        yield packed(k, h)


def _merged(batches):
    """Arrays of key, h in order, of runs sorted by part and first row: what comes before the first row of the last run is whole."""
    k, h = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        part, first = batch.column("part").to_numpy().astype(np.uint64), batch.column("key").to_numpy().astype(np.uint64)
        low = batch.column("keys").to_pylist()
        sizes = np.fromiter(map(len, low), np.int64, len(low)) // 4
        new = np.repeat(part << np.uint64(32), sizes) | np.frombuffer(b"".join(low), np.uint32)
        k, h = _ordered(np.concatenate([k, new]), np.concatenate([h, np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.int64)]))
        last = part[-1] << np.uint64(32) | first[-1]
        done, end = np.searchsorted(k, last), np.searchsorted(k, last, "right")
        done += np.searchsorted(h[done:end], batch.column("h")[-1].as_py())
        yield k[:done], h[:done]
        k, h = k[done:], h[done:]
    yield k, h


def _bands(docs: DataFrame) -> DataFrame:
    """Runs of the key, h of each band of each line that a task meets for the first time. Too many to be written: they go straight to their buckets."""

    def rows(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, _, texts in slices(batch):
                hashes, new = [], []
                for text in texts:
                    for line in normals(text):
                        if line and (h := line_hash(line)) not in seen:
                            seen.add(h)
                            hashes.append(h)
                            new.append(line)
                if len(seen) > 500_000:
                    seen.clear()
                yield _keys_in_parts(new).reshape(-1), np.repeat(np.array(hashes, np.int64), BANDS)

    return texts_of(docs).mapInArrow(lambda batches: _runs(rows(batches)), _RUNS)


def _bucket_members(banded: DataFrame, more: bool = False) -> DataFrame:
    """key, h of buckets with more than one line, of rows key, h or runs of them; with more also the smallest h of the bucket (low)
    and whether the bucket has a third line (open). Keys keep KEY_BITS bits, so a few lines more meet by chance. Runs are merged in
    the order of key and h, so four rows are held of a bucket of any size, and what runs have in common."""
    names = ["key", "h", "low", "open"] if more else ["key", "h"]

    def work(batches):
        k, h, low, given = np.zeros(0, np.int64), np.zeros(0, np.int64), None, 0  # the last rows, the smallest h of the first one's key, how many of them are given out
        for end, (new_k, new_h) in chain(((2, x) for x in _merged(batches)), [(0, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))]):
            k, h = np.append(k, new_k.view(np.int64) << (64 - KEY_BITS) >> (64 - KEY_BITS)), np.append(h, new_h)
            if not len(k):
                continue
            new = np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1]))
            k, h = k[new], h[new]
            one, two = k[1:] == k[:-1], k[2:] == k[:-2]
            before, after = np.append(False, one), np.append(one, False)
            third = before & after | np.append([False, False], two)[: len(k)] | np.append(two, [False, False])[: len(k)]
            lows = h[np.maximum.accumulate(np.where(before, 0, np.arange(len(k))))]
            if low is not None:
                lows[k == k[0]] = low
            upto = max(given, len(k) - end)
            i = np.flatnonzero((before | after)[given:upto]) + given
            yield pa.RecordBatch.from_arrays([pa.array(x[i]) for x in (k, h, lows, third)][: len(names)], names=names)
            start = max(0, upto - 2)
            k, h, low, given = k[start:], h[start:], lows[start], upto - start

    n = int(banded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if "keys" not in banded.columns:
        banded = banded.mapInArrow(lambda batches: _runs((x.column("key").to_numpy(), x.column("h").to_numpy()) for x in batches), _RUNS)
    dealt = banded.repartition(n, "part").sortWithinPartitions("part", "key", "h")
    return dealt.mapInArrow(work, "key long, h long, low long, open boolean" if more else "key long, h long")


def signatures(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct shingles each line has, and SIGNS bits in longs: a bit is 1 if an odd number of them fall to it.

    Two lines have at least as many shingles that only one of them has as bits that differ. Shingles are told apart by 48 bits.
    """
    c, sizes = _code_points([x.encode() for x in lines], SHINGLE - 1)
    c = c.astype(np.uint64)
    g = sum(c[k : len(c) - SHINGLE + 1 + k] * np.uint64(f) for k, f in enumerate(_FACTORS))
    line = np.repeat(np.arange(len(lines)), sizes)
    g = g[np.arange(len(line)) + (SHINGLE - 1) * line]
    g = (g ^ g >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    key = g >> np.uint64(16) | line.astype(np.uint64) << np.uint64(48)
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])[: len(key)]]
    line = (key >> np.uint64(48)).view(np.int64)
    odd = np.bincount(line * SIGNS + (key >> np.uint64(39) & np.uint64(SIGNS - 1)).view(np.int64), minlength=len(lines) * SIGNS) & 1
    return np.bincount(line, minlength=len(lines)), np.packbits(odd.astype(bool).reshape(len(lines), SIGNS), axis=1).view(np.int64)


def _unlike(threshold: float) -> float:
    """Lines are no pair if more bits of their signatures differ than this share of their shingles and one more."""
    return (1 - threshold) / (1 + threshold) + 1e-9


def _signed(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """h, size, signature and text of the lines wanted (h) and of some others; a line may come from several tasks."""
    found = bit_table(wanted, "h")

    def work(batches):
        for lines, hashes in _held(batches, found):
            parts, start, size = [], 0, 0
            for i, line in enumerate(lines):
                size += len(line)
                if size >= 250_000 or i + 1 == len(lines) or i - start > 30_000:
                    parts.append(signatures(lines[start : i + 1]))
                    start, size = i + 1, 0
            if parts:
                sizes, bits = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(sizes), *(pa.array(x) for x in bits.T.copy()), pa.array(lines, pa.string())], names=["h", "size", *_SIGNS, "line"])

    return texts_of(docs).mapInArrow(work, "h long, size long, " + ", ".join(f"{x} long" for x in _SIGNS) + ", line string")


def _held(batches, found: np.ndarray):
    """Lines that a bit table holds and their hashes, those of a slice of texts at a time; few of them twice."""
    seen: set[int] = set()
    for batch in batches:
        for _, _, texts in slices(batch):
            lines = [x for text in texts for x in normals(text) if x]
            hashes = list(map(line_hash, lines))
            out_h, out_l = [], []
            for i in np.flatnonzero(holds(found, np.array(hashes, np.int64))).tolist() if hashes else []:
                if hashes[i] not in seen:
                    seen.add(hashes[i])
                    out_h.append(hashes[i])
                    out_l.append(lines[i].decode())
            if len(seen) > 500_000:
                seen.clear()
            yield out_l, out_h


def _texts(signs: DataFrame, wanted: DataFrame) -> DataFrame:
    """h, line of the lines wanted (h); the bit table drops most others before the shuffle."""
    found = bit_table(wanted, "h")

    def work(batches):
        for batch in batches:
            yield batch.filter(pa.array(holds(found, batch.column("h").to_numpy())))

    lines = signs.select("h", "line").mapInArrow(work, "h long, line string").join(wanted.select("h").distinct(), "h", "left_semi")
    return lines.groupBy("h").agg(F.min("line").alias("line"))


def _packed(line: str) -> np.ndarray | list[str]:
    """The distinct shingles of a line: those of Latin-1 characters are numbers, others stay strings."""
    s = line + "\0" * (SHINGLE - 1)
    if line.isascii() or max(line) < "\u0100":
        raw = np.frombuffer(s.encode("latin-1"), np.uint8)
        return np.unique(np.lib.stride_tricks.sliding_window_view(raw, SHINGLE).copy().view(f"<u{SHINGLE}"))
    return list({s[i : i + SHINGLE] for i in range(len(line))})


def similar_pairs(lines: list[str], threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Indices of the pairs with an exact Jaccard similarity of threshold, by rows of bits over all shingles met."""
    if len(lines) == 2:
        return [(0, 1)] if jaccard(lines[0].encode(), lines[1].encode()) >= threshold else []
    sets = [_packed(x) for x in lines]
    if all(isinstance(x, np.ndarray) for x in sets):
        every = np.unique(np.concatenate(sets), return_inverse=True)[1]
    else:
        number: dict = {}
        every = np.array([number.setdefault(int.to_bytes(int(g), SHINGLE, "little").decode("latin-1") if not isinstance(g, str) else g, len(number)) for x in sets for g in x])
    sizes = np.array([len(x) for x in sets])
    rows = np.repeat(np.arange(len(sets)), sizes)
    both = np.zeros((len(sets), len(sets)), np.int64)
    step = 1 << 16  # a bounded table of bits for long lines
    for low in range(0, int(every.max()) + 1, step):
        here = (every >= low) & (every < low + step)
        bits = np.zeros((len(sets), min(step, int(every.max()) + 1 - low)), bool)
        bits[rows[here], every[here] - low] = True
        packed = np.packbits(bits, axis=1)
        packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)
        for i in range(len(sets) - 1):
            both[i, i + 1 :] += np.bitwise_count(packed[i] & packed[i + 1 :]).sum(axis=1, dtype=np.int64)
    i, j = np.nonzero(both >= np.maximum(1, threshold * (sizes[:, None] + sizes[None, :] - both)))
    return list(zip(i.tolist(), j.tolist()))


def _shingle_keys(lines: list[str], code: np.ndarray, base: int) -> np.ndarray:
    """Distinct (number of the line, its shingle) of lines, sorted, as numbers to the base of the alphabet's size."""
    marks = "\0" * (SHINGLE - 1)
    c = code[np.frombuffer((marks.join(lines) + marks).encode("utf-32-le"), np.uint32)]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    line = np.repeat(np.arange(len(lines)), sizes)
    at = np.arange(len(line)) + (SHINGLE - 1) * line  # the places that are no marks
    key = line
    for k in range(SHINGLE):
        key = key * base + c[at + k]
    key.sort()
    return key[np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]]


def similar(left: list[str], right: list[str], threshold: float = THRESHOLD) -> np.ndarray:
    """For each pair of lines whether its exact Jaccard similarity reaches threshold."""
    used = np.zeros(0x110000, bool)
    for side in (left, right):
        used[np.frombuffer("".join(side).encode("utf-32-le"), np.uint32)] = True
    used[0] = True
    base = int(used.sum())
    if len(left) * base**SHINGLE >= 1 << 63:  # too many different characters for one number
        if len(left) == 1:
            return np.array([jaccard(left[0].encode(), right[0].encode()) >= threshold])
        half = len(left) // 2
        return np.concatenate([similar(left[:half], right[:half], threshold), similar(left[half:], right[half:], threshold)])
    code = np.cumsum(used) - 1
    x, y = _shingle_keys(left, code, base), _shingle_keys(right, code, base)
    ends = np.arange(len(left) + 1) * base**SHINGLE
    count = lambda keys: np.diff(np.searchsorted(keys, ends))
    every = np.concatenate([x, y])
    every.sort()
    both = count(every[1:][every[1:] == every[:-1]])
    return both >= np.maximum(1, threshold * (count(x) + count(y) - both))


class _Pairs:
    """Pairs of lines with their names, verified when there are enough of them."""

    def __init__(self, threshold: float):
        self.threshold, self.rows, self.size = threshold, [], 0

    def add(self, a: int, b: int, left: str, right: str) -> tuple[list[int], list[int]]:
        self.rows.append((a, b, left, right))
        self.size += len(left) + len(right)
        return self.verified() if self.size >= _PAIR_CHARS else ([], [])

    def verified(self) -> tuple[list[int], list[int]]:
        if not self.rows:
            return [], []
        a, b, left, right = zip(*self.rows)
        self.rows, self.size = [], 0
        keep = np.flatnonzero(similar(left, right, self.threshold)).tolist()
        return [a[i] for i in keep], [b[i] for i in keep]


def _links(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _verify_star(threshold: float):
    """Of rows a, b, left, right those whose lines are similar."""

    def work(batches):
        pairs = _Pairs(threshold)
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "left", "right"))):
                a, b = pairs.add(*row)
                if a:
                    yield _links(a, b)
        yield _links(*pairs.verified())

    return work


def _verify_buckets(threshold: float):
    """Links a, b between the components of each run of rows with the same (key, pa, pb); of large runs a spanning forest."""
    keys = ["key", "pa", "pb"]

    def links(pairs: _Pairs, comps: list[int], lines: list[str]) -> tuple[list[int], list[int]]:
        a, b = [], []
        if len(set(comps)) < 2:
            return a, b
        if len(lines) <= SMALL:
            for i in range(len(lines)):
                for j in range(i):
                    if comps[i] != comps[j]:
                        x, y = pairs.add(comps[i], comps[j], lines[i], lines[j])
                        a += x
                        b += y
            return a, b
        found = [(comps[i], comps[j]) for i, j in similar_pairs(lines, threshold) if comps[i] != comps[j]]
        return spanning_stars([x for x, _ in found], [y for _, y in found])

    def work(batches):
        pairs, key, comps, lines = _Pairs(threshold), None, [], []
        for batch in batches:
            a, b = [], []
            for *own, c, line in zip(*(batch.column(n).to_pylist() for n in [*keys, "c", "line"])):
                if own != key:
                    x, y = links(pairs, comps, lines)
                    a += x
                    b += y
                    key, comps, lines = own, [], []
                comps.append(c)
                lines.append(line)
            yield _links(a, b)
        yield _links(*links(pairs, comps, lines))
        yield _links(*pairs.verified())

    return work


def _compare(threshold: float):
    """Of each run of rows with the same (key, pa, pb) the pairs a, b of lines of different components (ca, cb) that their signatures don't
    tell apart; where they are more than FEW a line, the lines that have such a partner, with null as b."""
    least, column = _unlike(threshold), ["key", "pa", "pb", "c", "h", "size", *_SIGNS]

    def pairs(rows):
        n = len(rows[0])
        same = (rows[:3, 1:] == rows[:3, :-1]).all(axis=0)
        run = np.cumsum(np.append(False, ~same))
        bits, low, high = rows[6:].T.copy().view(np.uint64), [], []
        i = np.arange(n)
        for d in range(1, n):
            i = i[: np.searchsorted(i, n - d)]
            i = i[run[i] == run[i + d]]
            if not len(i):
                break
            at = i[rows[3, i] != rows[3, i + d]]
            near = np.bitwise_count(bits[at] ^ bits[at + d]).sum(axis=1, dtype=np.int64) <= least * (rows[5, at] + rows[5, at + d]) + 1
            low.append(at[near])
            high.append(at[near] + d)
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (low, high))
        many = np.bincount(run[a], minlength=run[-1] + 1) > FEW * np.bincount(run)
        dense = many[run[a]]
        own = np.unique(np.concatenate([a[dense], b[dense]]))
        a, b = a[~dense], b[~dense]
        none = pa.nulls(len(own), pa.int64())
        columns = [pa.array(np.append(rows[0, a], rows[0, own]))]
        for k in (4, 3):
            columns += [pa.array(np.append(rows[k, a], rows[k, own])), pa.concat_arrays([pa.array(rows[k, b]), none])]
        return pa.RecordBatch.from_arrays(columns, names=["key", "a", "b", "ca", "cb"])

    def work(batches):
        held = np.zeros((len(column), 0), np.int64)
        for batch in batches:
            rows = np.concatenate([held, np.stack([batch.column(x).to_numpy().astype(np.int64) for x in column])], axis=1)
            if not rows.shape[1]:
                continue
            whole = rows.shape[1] - np.argmin(np.append((rows[:3] == rows[:3, -1:]).all(axis=0)[::-1], False))  # the last run may go on
            if whole:
                yield pairs(rows[:, :whole])
            held = rows[:, whole:]
        if held.shape[1]:
            yield pairs(held)

    return work


def _tiled(rows: DataFrame, tiles: DataFrame) -> DataFrame:
    """rows with key and h, once for each pair of tiles (pa, pb) that they are in; tiles has key and the number of tiles."""
    split = rows.join(tiles, "key").withColumn("tile", F.pmod(F.xxhash64("h"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return split.withColumn("pa", F.least("tile", "other")).withColumn("pb", F.greatest("tile", "other")).drop("tiles", "tile", "other")


def line_components(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """h, component of distinct lines that have a near duplicate."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = lambda rows: rows.repartition(n, "key", "pa", "pb").sortWithinPartitions("key", "pa", "pb")
    members = written(_bucket_members(_bands(docs), more=True))
    signs = written(_signed(docs, members.select("h")))
    side = lambda name: signs.select(F.col("h").alias(name), *(F.col(x).alias(f"{name}_{x}") for x in ("size", *_SIGNS)))
    others = members.where("h <> low")
    differ = sum((F.bit_count(F.col(f"a_{x}").bitwiseXOR(F.col(f"b_{x}"))) for x in _SIGNS), F.lit(0))
    star = others.select(F.col("h").alias("a"), F.col("low").alias("b")).distinct().join(side("a"), "a").join(side("b"), "b")
    star = shared(star.where(differ <= _unlike(threshold) * (F.col("a_size") + F.col("b_size")) + 1).select("a", "b").distinct())
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("h"))
    texts = shared(_texts(signs, ends(star)))
    named = lambda texts, k, name: texts.select(F.col("h").alias(k), F.col("line").alias(name))
    verified = lambda pairs, texts: pairs.join(named(texts, "a", "left"), "a").join(named(texts, "b", "right"), "b")
    first = verified(star, texts).mapInArrow(_verify_star(threshold), "a long, b long")
    found = shared(connected_components(shared(first)))
    placed = others.where("open").join(found, F.col("h") == F.col("node"), "left").select("key", "h", F.coalesce("component", "h").alias("c"))
    placed = shared(placed)
    # Buckets whose lines but the smallest are several components: only there can a link be missing.
    marks = [F.bit_xor(F.xxhash64("h", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    tiles = F.ceil(F.count("*") / TILE).cast("int").alias("tiles")
    open_ = placed.groupBy("key").agg(F.min("c").alias("least"), F.max("c").alias("most"), tiles, *marks).where("least <> most")
    open_ = open_.groupBy("mark0", "mark1").agg(F.min("key").alias("key"), F.max("tiles").alias("tiles")).select("key", "tiles")
    near = runs(_tiled(placed, open_).join(signs.drop("line").dropDuplicates(["h"]), "h"))
    near = shared(near.mapInArrow(_compare(threshold), "key long, a long, b long, ca long, cb long"))
    # Few pairs are verified one by one, the lines of other runs in tiles that have bounded texts.
    texts = shared(_texts(signs, ends(near).where("h is not null")))
    pairs = near.where("b is not null").groupBy("a", "b").agg(F.min("ca").alias("ca"), F.min("cb").alias("cb"))
    pairs = verified(pairs, texts).select(F.col("ca").alias("a"), F.col("cb").alias("b"), "left", "right").mapInArrow(_verify_star(threshold), "a long, b long")
    dense = near.where("b is null").select("key", F.col("a").alias("h"), F.col("ca").alias("c")).distinct().join(texts, "h")
    dense = shared(dense)
    tiles = dense.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum(F.length("line")) / TILE_CHARS)).cast("int").alias("tiles"))
    dense = runs(_tiled(dense.select("key", "h", "c"), tiles).join(texts, "h").select("key", "pa", "pb", "c", "line"))
    links = shared(pairs.unionByName(dense.mapInArrow(_verify_buckets(threshold), "a long, b long")))
    merged = connected_components(links)  # of components
    whole = found.join(merged.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left").select(F.col("node").alias("h"), F.coalesce("top", "component").alias("component"))
    # Lines that were alone until they met in a bucket.
    alone = merged.join(found.select("node"), "node", "left_anti").select(F.col("node").alias("h"), "component")
    return whole.unionByName(alone)


def dropped_lines(docs: DataFrame, lines: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, line_no of each line but the first of its component."""
    place = F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).cast("decimal(20,0)") * F.lit(10**9).cast("decimal(10,0)") + F.col("line_no")
    own = lines.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    near = shared(line_components(docs, threshold))
    whole = own.join(near, "h").select("h", "first", "component")
    firsts = whole.select("h", "component").join(whole.groupBy("component").agg(F.min("first").alias("first")), "component").select("h", "first")
    firsts = firsts.unionByName(own.where("n > 1").join(near, "h", "left_anti").select("h", "first"))
    return lines.select("doc_id", "line_no", "h").join(firsts, "h").where(place != F.col("first")).select("doc_id", "line_no")


def line_report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_lines (that aren't blank), n_dropped, dropped (their numbers from 0, comma-joined) of each doc_id."""
    lines = shared(_lines(docs))
    counts = lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"))
    gone = dropped_lines(docs, lines, threshold).groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("d"))
    every = docs.select(docs["doc_id"].cast("long").alias("doc_id"))
    out = every.join(counts.alias("c"), every["doc_id"].eqNullSafe(F.col("c.doc_id")), "left").drop(F.col("c.doc_id"))
    out = out.join(gone.alias("g"), out["doc_id"].eqNullSafe(F.col("g.doc_id")), "left").drop(F.col("g.doc_id"))
    return out.select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce(F.size("d"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce(F.array_join("d", ","), F.lit("")).alias("dropped"))


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with the dropped lines taken out of text and n_chars counted anew; null texts and other columns stay as they are."""
    free = "_" * (1 + max(map(len, docs.columns)))  # a name that no column has
    gone = dropped_lines(docs, shared(_lines(docs)), threshold).groupBy("doc_id").agg(F.collect_set("line_no").alias(free))
    whole = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["doc_id"]), "left")
    names, at = docs.columns, {f.name: i for i, f in enumerate(docs.schema.fields)}

    def work(batches):
        for batch in batches:
            columns = [batch.column(i) for i in range(len(at))]
            texts = columns[at["text"]].to_pylist()
            for i, drop in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if drop and texts[i] is not None:
                    drop = set(drop)
                    texts[i] = "\n".join(x for n, x in enumerate(texts[i].split("\n")) if n not in drop)
            columns[at["text"]] = pa.array(texts, columns[at["text"]].type)
            if "n_chars" in at:
                kind = columns[at["n_chars"]].type
                columns[at["n_chars"]] = pa.array([o if t is None else len(t) for t, o in zip(texts, columns[at["n_chars"]].to_pylist())], kind)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return whole.select(*[docs[c] for c in docs.columns], gone[free]).mapInArrow(work, docs.schema)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))
