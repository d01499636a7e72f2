"""Removal of repeated passages by suffix sorting in two stages.

Every string of LENGTH bytes that also starts earlier goes. Equal strings hold the same ANCHOR-byte piece of least hash at
the same place, so only strings around pieces that occur at least twice need be compared. They are dealt out by that
piece's hash, each with the bytes that its strings cover.

A task concatenates the bytes of many pieces and sorts their suffixes in two stages. A suffix smaller than its successor is sorted
directly, by its first LENGTH bytes. All others are induced: buckets of equal first bytes are scanned in order, and the
suffix before each scanned one, if it is larger than its successor, is next in its own bucket. Common prefixes of neighbours then
tell equal strings, of which all but the earliest are marked.

A piece that occurs more than TILE_ROWS times is dealt out in tiles. Each tile marks all but its own earliest strings; what
is left of the tiles is one row for each different string, and the least of these is found by Spark's aggregation.

Defined results: null texts are empty; texts shorter than LENGTH are kept; rows with the same doc_id and text are the same document and
get the same result; rows with the same doc_id and other texts are other documents, in the order of their texts' hashes; a null doc_id is less than all others; texts of any length
are taken whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table, texts_of, written

LENGTH = 100
#: Bytes of a piece, a power of two; a string holds LENGTH - ANCHOR + 1 of them.
ANCHOR = 32
#: Occurrences of a piece that are compared in one tile.
TILE_ROWS = 4096
#: Bytes that are sorted at once, but for a tile that is longer.
SORTED_BYTES = 2_000_000
#: Positions whose pieces are hashed at once.
STEP = 1 << 20
_PLACE_BITS = 21  # a position within a step and a string's length after it
SEPARATOR = 0xFF  # no byte of UTF-8


# --- pieces -------------------------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def piece_hashes(data: np.ndarray, anchor: int = ANCHOR) -> np.ndarray:
    """A hash of the anchor bytes from each position on."""
    h, step, factor = _BYTE[data], 1, 0x9E6C63D0876A9A47
    while step < anchor:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        step *= 2
    return _mixed(h)


def least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every width neighbours."""
    least, have = keys, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[: len(keys) - width + 1], least[width - have : width - have + len(keys) - width + 1])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, first start, number of starts) of each run of strings of a document that share their least piece.

    data: the documents one after another; offsets: where each begins, and the end of the last.
    """
    found = []
    for low in range(0, max(len(data) - length + 1, 0), STEP):
        part = data[low : low + STEP + length - 1]
        hashes = piece_hashes(part, anchor)
        keys = hashes & ~np.uint64((1 << _PLACE_BITS) - 1) | np.arange(len(hashes), dtype=np.uint64)
        place = (least_in_windows(keys, length - anchor + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        starts = np.arange(low, low + len(place))
        document = np.searchsorted(offsets, starts, side="right") - 1
        inside = starts + length <= offsets[document + 1]
        starts, document, place = starts[inside], document[inside], place[inside]
        if len(starts):
            first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (document[1:] != document[:-1])]))
            found.append((hashes[place[first]].view(np.int64), document[first], starts[first] - offsets[document[first]], np.diff(np.append(first, len(starts)))))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings without nulls, one after another, and where each begins."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(column) else data[:0], offsets - offsets[0]


# --- sorting ------------------------------------------------------------------------------------------------------


def _gather(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(data, length)[starts]


def is_smaller(data: np.ndarray) -> np.ndarray:
    """Whether the suffix at each position is smaller than its successor; the last one is not."""
    differs = np.flatnonzero(data[1:] != data[:-1])
    smaller = np.zeros(len(data), bool)
    at = np.searchsorted(differs, np.arange(len(data)))
    known = at < len(differs)
    where = differs[at[known]]
    smaller[known] = data[where] < data[where + 1]
    return smaller


def sort_suffixes(data: np.ndarray, wanted: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The wanted positions (a mask) in the order of the length bytes from each on, which must all be in data.

    Others of the same bytes are in any order.
    """
    smaller = is_smaller(data)
    # A suffix is induced from its successor, so that must be sorted as well, up to the first that is sorted directly.
    n = len(data)
    last_wanted = np.maximum.accumulate(np.where(wanted, np.arange(n), -1))
    last_direct = np.maximum.accumulate(np.where(smaller, np.arange(n), -1))
    before = np.concatenate([[-1], last_direct[:-1]])
    needed = wanted | ((last_wanted >= 0) & (before < last_wanted))
    direct = np.flatnonzero(needed & smaller)
    padded = np.concatenate([data, np.full(length, SEPARATOR, np.uint8)])
    direct = direct[np.argsort(_gather(padded, direct, length).view(f"S{length}").ravel(), kind="stable")]
    induced = needed & ~smaller
    by_bucket = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and induced[n - 1]:
        waiting[data[n - 1]].append(np.array([n - 1]))  # the empty suffix comes first of all
    out = []

    def before_each(scanned: np.ndarray) -> np.ndarray:
        found = scanned[scanned > 0] - 1
        return found[induced[found]]

    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            found = before_each(wave)
            wave = found[data[found] == c]
        bucket.append(direct[by_bucket[c] : by_bucket[c + 1]])
        scanned = np.concatenate(bucket)
        if not len(scanned):
            continue
        out.append(scanned)
        found = before_each(scanned)
        first = data[found]
        found, first = found[first > c], first[first > c]
        if len(found):
            order = np.argsort(first, kind="stable")
            found, first = found[order], first[order]
            for part in np.split(found, np.flatnonzero(first[1:] != first[:-1]) + 1):
                waiting[data[part[0]]].append(part)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(data: np.ndarray, order: np.ndarray, length: int = LENGTH, at_once: int = 100_000) -> np.ndarray:
    """Equal bytes, length at most, of each position's string and the one before it in order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), at_once):
        strings = _gather(data, order[a - 1 : a + at_once], length)
        differs = strings[1:] != strings[:-1]
        out[a : a + at_once] = np.where(differs.any(1), differs.argmax(1), length)
    return out


def mark_repeats(parts: list[bytes], counts: np.ndarray, ranks: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which strings are no first ones. parts: bytes that hold counts strings from their first byte on; ranks, starts: where they are.

    Returns, for all strings in the order of parts: part, start, whether an equal string starts earlier, whether it is the first
    of its class here.
    """
    data = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])[:-1]
    part = np.repeat(np.arange(len(parts)), counts)
    offset = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = begins[part] + offset
    wanted = np.zeros(len(data), bool)
    wanted[place] = True
    string_at = np.zeros(len(data), np.int64)
    string_at[place] = np.arange(len(place))
    order = sort_suffixes(data, wanted, length)
    new = common_prefixes(data, order, length) < length
    key = (ranks[part] << 40) + starts[part] + offset
    in_order = key[string_at[order]]
    least = np.minimum.reduceat(in_order, np.flatnonzero(new))[np.cumsum(new) - 1]
    later, first = np.zeros(len(part), bool), np.zeros(len(part), bool)
    later[string_at[order]] = in_order > least
    first[string_at[order]] = in_order == least
    return part, starts[part] + offset, later, first


# --- Spark --------------------------------------------------------------------------------------------------------

_DOC = "doc_id long, tag int"
NO_ID = -(1 << 63)


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id (NO_ID for null), tag (which tells texts of the same doc_id apart) and text."""
    return texts_of(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.hash("text").alias("tag"), "text")


def find_anchors(documents: DataFrame) -> DataFrame:
    """h, doc_id, tag, start, n: runs of strings by their least piece."""

    def work(batches):
        for batch in batches:
            data, offsets = _buffer(batch.column("text"))
            h, document, start, n = anchors(data, offsets)
            document = pa.array(document)
            yield pa.RecordBatch.from_arrays([pa.array(h), batch.column("doc_id").take(document), batch.column("tag").take(document), pa.array(start, pa.int64()), pa.array(n, pa.int32())], names=["h", "doc_id", "tag", "start", "n"])

    return documents.mapInArrow(work, f"h long, {_DOC}, start long, n int")


def repeated_anchors(documents: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """For each document its runs around pieces that occur again: h, tile (0 where all occurrences are one tile), start, n."""
    found = find_anchors(documents)
    again = written(found.groupBy("h").agg(F.count("*").alias("times")).where("times > 1"))  # written, so that the join below can be split by skew
    tiles = F.ceil(F.col("times") / tile_rows)
    tile = F.when(tiles > 1, 1 + F.pmod(F.xxhash64("doc_id", "tag", "start"), tiles)).otherwise(0).cast("int")
    kept = found.join(again, "h").select("doc_id", "tag", F.struct("h", tile.alias("tile"), "start", "n").alias("run"))
    return kept.groupBy("doc_id", "tag").agg(F.collect_list("run").alias("runs"))  # of one document


def _with_bytes(joined: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every run with the bytes that its strings cover."""

    def work(batches):
        for batch in batches:
            data, offsets = _buffer(batch.column("text"))
            runs = batch.column("runs")
            flat, owner = runs.flatten(), np.repeat(np.arange(batch.num_rows), runs.value_lengths().to_numpy())
            start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy().astype(np.int64)
            low, size = offsets[owner] + start, n + length - 1
            for a in range(0, len(owner), 20_000):
                s = slice(a, a + 20_000)
                to = np.cumsum(size[s])
                places = np.arange(to[-1]) + np.repeat(low[s] - to + size[s], size[s])
                part = pa.Array.from_buffers(pa.binary(), len(to), [None, pa.py_buffer(np.concatenate([[0], to]).astype(np.int32)), pa.py_buffer(data[places])])
                take = pa.array(owner[s])
                runs_here = flat.slice(a, len(to))
                yield pa.RecordBatch.from_arrays([runs_here.field("h"), runs_here.field("tile"), batch.column("doc_id").take(take), batch.column("tag").take(take), runs_here.field("start"), runs_here.field("n"), part], names=["h", "tile", "doc_id", "tag", "start", "n", "part"])

    return joined.select("doc_id", "tag", "text", "runs").mapInArrow(work, f"h long, tile int, {_DOC}, start long, n int, part binary")


_MARK = f"{_DOC}, low long, high long, string binary"


def _mark_sorted(length: int = LENGTH, sorted_bytes: int = SORTED_BYTES):
    """Runs sorted by (h, tile): marked runs of starts, low to high, and the first strings of tiles (with their digests)."""

    def marks(rows: list[tuple]):
        doc_id, tag = np.array([r[2] for r in rows], np.int64), np.array([r[3] for r in rows], np.int64)
        tiled = np.array([r[1] > 0 for r in rows])
        starts, counts = np.array([r[4] for r in rows], np.int64), np.array([r[5] for r in rows], np.int64)
        by = np.lexsort((tag, doc_id))
        rank = np.empty(len(rows), np.int64)
        rank[by] = np.cumsum(np.concatenate([[0], (doc_id[by][1:] != doc_id[by][:-1]) | (tag[by][1:] != tag[by][:-1])]))
        parts = [r[6] for r in rows]
        part, start, later, first = mark_repeats(parts, counts, rank, starts, length)
        at = np.flatnonzero(later)
        if len(at):
            new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (part[at[1:]] != part[at[:-1]])]))
            low, high = at[new], at[np.append(new[1:], len(at)) - 1]
            p = part[low]
            yield pa.RecordBatch.from_pydict({"doc_id": doc_id[p], "tag": pa.array(tag[p], pa.int32()), "low": start[low], "high": start[high], "string": pa.nulls(len(p), pa.binary())})
        at = np.flatnonzero(first & tiled[part])
        if len(at):
            p, offset = part[at], start[at] - starts[part[at]]
            digests = [hashlib.blake2b(parts[i][o : o + length], digest_size=16).digest() for i, o in zip(p.tolist(), offset.tolist())]
            yield pa.RecordBatch.from_pydict({"doc_id": doc_id[p], "tag": pa.array(tag[p], pa.int32()), "low": start[at], "high": start[at], "string": pa.array(digests, pa.binary())})

    def work(batches):
        rows, size = [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("h", "tile", "doc_id", "tag", "start", "n", "part")]
            for row in zip(*columns):
                if size >= sorted_bytes and row[:2] != rows[-1][:2]:
                    yield from marks(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[6])
        if rows:
            yield from marks(rows)

    return work


def repeated_spans(documents: DataFrame, tile_rows: int = TILE_ROWS, sorted_bytes: int = SORTED_BYTES) -> DataFrame:
    """doc_id, tag, low, high: strings from low to high start earlier too."""
    runs = written(repeated_anchors(documents, tile_rows))
    parts = _with_bytes(documents.join(runs, ["doc_id", "tag"]))
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = written(parts.repartition(n, "h", "tile").sortWithinPartitions("h", "tile").mapInArrow(_mark_sorted(LENGTH, sorted_bytes), _MARK))
    first = found.where("string IS NOT NULL")
    place: Column = F.struct("doc_id", "tag", "low")
    least = first.groupBy("string").agg(F.min(place).alias("least"), F.count("*").alias("times")).where("times > 1")
    later = first.join(least, "string").where(place > F.col("least"))
    columns = ["doc_id", "tag", "low", "high"]
    return found.where("string IS NULL").select(*columns).union(later.select(*columns))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def remove_repeats(docs: DataFrame, tile_rows: int = TILE_ROWS, sorted_bytes: int = SORTED_BYTES) -> DataFrame:
    """doc_id, bytes before, bytes and spans removed, digest of what is left, and what is left (bytes that are no UTF-8 any more are replaced)."""
    documents = _documents(docs)
    spans = repeated_spans(documents, tile_rows, sorted_bytes).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("low", "high")).alias("spans"))  # of one document
    joined = documents.join(spans, ["doc_id", "tag"], "left").select("doc_id", "text", "spans")

    def work(batches):
        for batch in batches:
            out = []
            data, offsets = _buffer(batch.column("text"))
            for i, spans in enumerate(batch.column("spans")):
                own = data[offsets[i] : offsets[i + 1]]
                edges = np.zeros(len(own) + 1, np.int64)
                if spans.is_valid:
                    low, high = (spans.values.field(c).to_numpy() for c in ("low", "high"))
                    np.add.at(edges, low, 1)
                    np.add.at(edges, high + LENGTH, -1)
                gone = np.cumsum(edges)[:-1] > 0
                kept = own[~gone].tobytes()
                runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(own), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            columns = [pa.array(x, kind) for x, kind in zip(zip(*out), [pa.int64()] * 3 + [pa.string()] * 2)] if out else []
            if columns:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(work, RESULT).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
