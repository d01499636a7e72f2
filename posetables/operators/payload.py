"""Annotation records from image payloads: one binary row for each image, and no pixel is shuffled on its own.

All rows of a frame meet in one exchange, sorted so that its depth comes first, then its objects, then their full masks in
order. A task takes them as a stream. Frames with small images of one size, which lie whole in a batch, are computed together; of others it holds one depth
image, one painted mask and one full mask at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..queries import query
from .aggregates import ANNOTATE, annotate_columns

_DEPTH, _OBJECT, _FULL = 0, 1, 2


def counts_and_boxes(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pixels and inclusive boxes (x1, y1, x2, y2; zeros without pixels) of the ids 1 to n of an image."""
    counts = np.bincount(ids.ravel(), minlength=n + 1)[1 : n + 1]
    y, x = np.nonzero((ids > 0) & (ids <= n))
    k = ids[y, x] - 1
    boxes = np.zeros((n, 4), np.int64)
    boxes[counts > 0] = [ids.shape[1], ids.shape[0], -1, -1]
    for column, at, value in ((0, np.minimum, x), (1, np.minimum, y), (2, np.maximum, x), (3, np.maximum, y)):
        at.at(boxes[:, column], k, value)
    return counts, boxes


class _Frame:
    """What the rows of a frame have told so far."""

    def __init__(self, frame_id):
        self.frame_id, self.depth, self.painted = frame_id, None, None
        self.objects: list[tuple[int, str, bool]] = []
        self.full: dict[int, tuple[int, np.ndarray]] = {}

    def take(self, kind: int, instance: int | None, cls, semantic, height, width, data) -> None:
        if kind == _OBJECT:
            self.objects.append((instance, cls, semantic))
            return
        if data is None:
            return
        if kind == _DEPTH:
            self.depth = np.frombuffer(data, "<u2").reshape(height, width)
            return
        mask = np.frombuffer(data, np.uint8).reshape(height, width) > 0
        counts, boxes = counts_and_boxes(mask.astype(np.int64), 1)
        self.full[instance] = int(counts[0]), boxes[0]
        if self.painted is None:
            self.painted = np.zeros((height, width), np.int64)
        self.painted[mask] = instance + 1  # a later instance covers the ones before

    def rows(self) -> list[tuple]:
        n = 1 + max([x[0] for x in self.objects] + list(self.full), default=-1)
        if self.painted is None:
            self.painted = np.zeros((1, 1), np.int64)
        counts, boxes = counts_and_boxes(self.painted, n)
        valid = np.zeros(n, np.int64)
        if self.depth is not None and self.depth.shape == self.painted.shape:
            valid = np.bincount(self.painted[self.depth > 0], minlength=n + 1)[1 : n + 1]
        none = (0, np.zeros(4, np.int64))
        out = []
        for instance, cls, semantic in self.objects:
            px_all, box = self.full.get(instance, none) if semantic else none
            out.append((self.frame_id, instance, cls, *boxes[instance].tolist(), *box.tolist(), int(counts[instance]), int(valid[instance]) if semantic else 0, px_all))
        return out


#: Images of so many pixels are computed together with those of other frames, and so many counts are kept at a time.
_SMALL, _COUNTS = 4096, 4_000_000


def _images(data: pa.Array, kind: str, pixels: int) -> np.ndarray:
    at = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
    return np.frombuffer(data.buffers()[2], kind, count=len(data) * pixels, offset=int(at[0])).reshape(len(data), pixels)


def _together(rows: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch | None:
    """What _Frame.rows() gives for whole frames; None if they are to be taken one by one."""
    kind, frame_id = rows.column("kind").to_numpy(), rows.column("frame_id").to_numpy(zero_copy_only=False)
    frame = np.concatenate([[0], np.cumsum(frame_id[1:] != frame_id[:-1])])
    filled = np.asarray(rows.column("data").is_valid())
    images, objects = filled & (kind != _OBJECT), np.nonzero(kind == _OBJECT)[0]
    sizes = {(h, w) for h, w in zip(*(rows.column(c).filter(pa.array(images)).to_pylist() for c in ("height", "width")))}
    instance_column = rows.column("instance_index").filter(pa.array(kind != _DEPTH))
    if len(sizes) != 1 or not len(objects) or rows.column("frame_id").null_count or instance_column.null_count or not pa.types.is_binary(rows.column("data").type):
        return None
    ((h, w),) = sizes
    instance = np.zeros(len(kind), np.int64)
    instance[kind != _DEPTH] = instance_column.to_numpy()
    n, frames = int(instance.max()) + 2, int(frame[-1]) + 1
    full, deep = np.nonzero(filled & (kind == _FULL))[0], np.nonzero(filled & (kind == _DEPTH))[0]
    key = frame[full] * n + instance[full] + 1
    lengths = np.asarray(pc.binary_length(rows.column("data")).fill_null(0))
    if not h * w or h * w > _SMALL or n * frames > _COUNTS or instance.min() < 0 or len(set(key.tolist())) < len(key) or len(set(frame[deep].tolist())) < len(deep) or (lengths[full] != h * w).any() or (lengths[deep] != 2 * h * w).any():
        return None
    painted, depth = np.zeros((frames, h * w), np.int64), np.zeros((frames, h * w), bool)
    if len(deep):
        depth[frame[deep]] = _images(rows.column("data").take(pa.array(deep)), "<u2", h * w) > 0
    px_all, boxes = np.zeros(frames * n, np.int64), np.zeros((frames * n, 4), np.int64)
    if len(full):
        masks = _images(rows.column("data").take(pa.array(full)), "u1", h * w) > 0
        starts = np.nonzero(np.concatenate([[True], frame[full][1:] != frame[full][:-1]]))[0]
        painted[frame[full][starts]] = np.maximum.reduceat(masks * (instance[full] + 1)[:, None], starts, axis=0)  # a later instance covers the ones before
        px_all[key] = masks.sum(axis=1)
        across, down = masks.reshape(-1, h, w).any(axis=1), masks.reshape(-1, h, w).any(axis=2)
        edges = [across.argmax(axis=1), down.argmax(axis=1), w - 1 - across[:, ::-1].argmax(axis=1), h - 1 - down[:, ::-1].argmax(axis=1)]
        boxes[key] = np.where((px_all[key] > 0)[:, None], np.stack(edges, axis=1), 0)
    f, at = np.nonzero(painted)
    shown = f * n + painted[f, at]
    px_visib, px_valid = np.bincount(shown, minlength=frames * n), np.bincount(shown[depth[f, at]], minlength=frames * n)
    seen = np.zeros((frames * n, 4), np.int64)
    seen[px_visib > 0] = [w, h, -1, -1]
    for column, of, value in ((0, np.minimum, at % w), (1, np.minimum, at // w), (2, np.maximum, at % w), (3, np.maximum, at // w)):
        of.at(seen[:, column], shown, value)
    own, semantic = frame[objects] * n + instance[objects] + 1, np.asarray(rows.column("has_semantics").take(pa.array(objects)).fill_null(False))
    numbers = [*seen[own].T, *(boxes[own] * semantic[:, None]).T, px_visib[own], px_valid[own] * semantic, px_all[own] * semantic]
    made = [pa.array(frame_id[objects]), pa.array(instance[objects]), rows.column("cls").take(pa.array(objects)), *map(pa.array, numbers)]
    return pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(made, schema)], schema=schema)


_RAW = "frame_id long, instance_index int, cls string, vx1 int, vy1 int, vx2 int, vy2 int, x1 int, y1 int, x2 int, y2 int, px_visib long, px_valid long, px_all long"


def annotate_payload(depths: DataFrame, masks: DataFrame, annotations: DataFrame) -> DataFrame:
    """The annotation record of each object, as annotate() has it from pixels.

    depths: frame_id, height, width, data (16-bit little-endian); masks: frame_id, instance_index, height, width, data (bytes, not zero
    inside); annotations: frame_id, instance_index, cls, has_semantics. Missing and null images count as empty.
    """
    none = lambda kind: F.lit(None).cast(kind)
    rows = (
        depths.select("frame_id", F.lit(_DEPTH).alias("kind"), none("int").alias("instance_index"), none("string").alias("cls"), none("boolean").alias("has_semantics"), "height", "width", "data")
        .unionByName(annotations.select("frame_id", F.lit(_OBJECT).alias("kind"), "instance_index", "cls", "has_semantics", none("int").alias("height"), none("int").alias("width"), none("binary").alias("data")))
        .unionByName(masks.select("frame_id", F.lit(_FULL).alias("kind"), "instance_index", none("string").alias("cls"), none("boolean").alias("has_semantics"), "height", "width", "data"))
    )
    names = [c.split()[0] for c in _RAW.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _RAW.split(", ")])

    def listed(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, schema.field(n).type) for n, x in zip(names, zip(*out))], schema=schema)

    def work(batches):
        frame = None

        def one_by_one(batch):
            nonlocal frame
            out, data = [], batch.column("data")
            columns = [batch.column(c) for c in ("frame_id", "kind", "instance_index", "cls", "has_semantics", "height", "width")]
            for i, (frame_id, *row) in enumerate(zip(*(c.to_pylist() for c in columns))):
                if frame is None or frame_id != frame.frame_id:
                    out += frame.rows() if frame else []
                    frame = _Frame(frame_id)
                    if len(out) >= 5000:
                        yield listed(out)
                        out = []
                frame.take(*row, data[i].as_buffer() if data[i].is_valid else None)
            if out:
                yield listed(out)

        for batch in batches:
            ids = batch.column("frame_id")
            edges = [] if ids.null_count else (np.nonzero(np.diff(ids.to_numpy()))[0] + 1).tolist()
            made = _together(batch.slice(edges[0], edges[-1] - edges[0]), schema) if len(edges) > 1 else None
            if made is None:
                yield from one_by_one(batch)
                continue
            yield from one_by_one(batch.slice(0, edges[0]))
            if last := frame.rows():
                yield listed(last)
            yield made
            frame = None
            yield from one_by_one(batch.slice(edges[-1]))  # this frame may go on in the next batch
        if frame and (last := frame.rows()):
            yield listed(last)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt out by a hash of its own: where all three inputs are dealt out by frame_id already, Spark 4.1 drops an exchange by frame_id above
    # their union, and then coalesces the partitions of each input in another way.
    made = rows.repartition(n, F.xxhash64("frame_id")).sortWithinPartitions("frame_id", "kind", "instance_index").mapInArrow(work, _RAW)
    return made.select(*names, annotate_columns("px_visib", "px_all"))


def _depth_image(pixels: DataFrame, n: int) -> DataFrame:
    """frame_id, data: the depths of n places k of each frame, two bytes each, little-endian; a pixel that isn't there has no depth."""
    swapped = F.shiftleft(F.col("depth_raw").bitwiseAND(F.lit(255)), 8).bitwiseOR(F.shiftright("depth_raw", 8).bitwiseAND(F.lit(255))).cast("long")
    four = [F.bit_or(F.when(F.floor(F.col("k") / 4) == j, F.expr("shiftleft(v, int(48 - 16 * (k % 4)))"))).alias(f"w{j}") for j in range(-(-n // 4))]  # four places in a number
    words = pixels.select("frame_id", "k", swapped.alias("v")).groupBy("frame_id").agg(*four)
    digits = F.concat(*[F.lpad(F.hex(F.coalesce(f"w{j}", F.lit(0).cast("long"))), 16, "0") for j in range(len(four))])
    return words.select("frame_id", F.unhex(F.substring(digits, 1, 4 * n)).alias("data"))


@query("agg_annotate_payload", ANNOTATE, "fx_pixels", "fx_masks", "fx_annotations")
def agg_annotate_payload(pixels, masks, annotations):
    """The images of 5 x 5 pixels are made of the pixel tables first; agg_annotate has the same rows from these."""
    size = [F.lit(5).alias("height"), F.lit(5).alias("width")]
    k = (F.col("y") * 5 + F.col("x")).alias("k")
    depths = _depth_image(pixels.select("frame_id", k, "depth_raw"), 25).select("frame_id", *size, "data")
    inside = masks.select("frame_id", "instance_index", k).where("k BETWEEN 0 AND 24").groupBy("frame_id", "instance_index").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("bits"))
    byte = lambda i: F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0, F.lit("\x01")).otherwise(F.lit("\x00"))
    full = inside.select("frame_id", "instance_index", *size, F.concat(*map(byte, range(25))).cast("binary").alias("data"))
    return annotate_payload(depths, full, annotations)
