"""Sharded record files: a Python data source, whose tasks read one shard or several.

A shard is a ZLIB stream of length-framed Example records; it can't be split. A task reads small shards one after another. Below a root, all datasets are read: of
version 2 the shards `data/*.tfrecord`, of version 1 four file families (rgb, depth, mask, gt), whose records belong together by
position. Option keys picks features, so that others are passed over undecoded and families without a wanted key aren't
opened. Options subsets and shards leave shards out before any is opened. They are options rather than pushed filters because Spark 4.1
keeps what a Python source was once filtered by, and applies it to later queries of the same DataFrame.

Written shards are named by the ranges of a plan. A task writes under a name of its own, and the commit renames: a shard that
is written again replaces itself, and what failed tasks leave behind is swept away.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

from ..operators.windows import placed_in_shards
from .tensors import KEYS, arrow_type, decode_example, decode_examples, encode_examples, frame_records, keys_of, records, spark_type

#: Families of version 1 with their keys. Fixed values.
FAMILIES = {
    "rgb": ["rgb", "rgb_R"],
    "depth": ["depth", "depth_R"],
    "mask": ["mask"],
    "gt": [k for k in KEYS if k.startswith(("cam_", "obj_", "stereo_"))],
}
#: A batch of rows ends at so many rows, or bytes of records.
BATCH_ROWS, BATCH_BYTES = 16_384, 32 << 20
#: A task reads shards of so many bytes in all, or one that is larger. Opening a shard counts as some bytes.
TASK_BYTES, OPEN_BYTES = 16 << 20, 64 << 10
PATTERN = "**/*.tfrecord"


def pieces_of(path: str, size: int = 1 << 20) -> Iterator[bytes]:
    with open(path, "rb") as f:
        while piece := f.read(size):
            yield piece


def layout_version(root: str | Path) -> float:
    """Version of a dataset folder; 2 without metadata, an error from 3 on."""
    meta = Path(root) / "metadata.json"
    version = float(json.loads(meta.read_text()).get("version", 2.0)) if meta.exists() else 2.0
    if version >= 3:
        raise ValueError(f"{root}: version {version} is not read")
    return version


@dataclass(frozen=True)
class Shard(InputPartition):
    """subset: the dataset's folder below the root; paths: a file for each family ("data" in version 2)."""

    subset: str
    shard: str
    paths: tuple[tuple[str, str], ...]

    def wanted(self, keys: list[str]) -> list[list[str]]:
        """Which keys each file is read for."""
        return [[k for k in keys if family == "data" or k in FAMILIES[family]] for family, _ in self.paths]

    def messages(self) -> Iterator[tuple[bytes, ...]]:
        """The records of each position, one for each file; of several families, as many as the shortest has."""
        return zip(*[records(pieces_of(path), path) for _, path in self.paths])


@dataclass(frozen=True)
class Shards(InputPartition):
    """What one task reads."""

    of: tuple[Shard, ...]


def dealt_out(shards: list[Shard]) -> list[Shards]:
    """Neighbouring shards together, up to TASK_BYTES."""
    out: list[list[Shard]] = []
    left = 0
    for shard in shards:
        size = sum(os.stat(path).st_size + OPEN_BYTES for _, path in shard.paths)
        if not out or size > left:
            out.append([])
            left = TASK_BYTES
        out[-1].append(shard)
        left -= size
    return [Shards(tuple(x)) for x in out]


def find_shards(root: str, pattern: str, keys: list[str]) -> list[Shard]:
    """All shards below a root, of both versions. The families of a dataset must have the same shards."""
    base = Path(root)
    layout_version(base)
    families: dict[Path, dict[str, dict[str, str]]] = defaultdict(lambda: defaultdict(dict))
    found = []
    versions: dict[Path, float] = {}
    for path in sorted(base.glob(pattern)):
        folder = path.parent.parent if path.parent.name in ("data", *FAMILIES) else path.parent
        if folder not in versions:
            versions[folder] = layout_version(folder if (folder / "metadata.json").exists() else base)
        version = versions[folder]
        subset = "" if folder == base else folder.relative_to(base).as_posix()
        if version >= 2:
            found.append(Shard(subset, path.stem, (("data", str(path)),)))
        elif path.parent.name in FAMILIES and set(FAMILIES[path.parent.name]) & set(keys):
            families[folder][path.parent.name][path.stem] = str(path)
    for folder, of_family in families.items():
        stems = {frozenset(files) for files in of_family.values()}
        if len(stems) > 1:
            raise ValueError(f"{folder}: the families {', '.join(sorted(of_family))} have different shards")
        subset = "" if folder == base else folder.relative_to(base).as_posix()
        found += [Shard(subset, stem, tuple((f, of_family[f][stem]) for f in FAMILIES if f in of_family)) for stem in sorted(next(iter(stems)))]
    return found


def arrow_schema(keys: list[str]) -> pa.Schema:
    return pa.schema([("subset", pa.string()), ("shard", pa.string()), ("position", pa.int32()), *((k, arrow_type(k)) for k in keys)])


def _batch(heads: list[tuple[str, str, int]], columns: list[pa.Array], keys: list[str]) -> pa.RecordBatch:
    schema = arrow_schema(keys)
    return pa.RecordBatch.from_arrays([*(pa.array(x, schema.field(i).type) for i, x in enumerate(zip(*heads))), *columns], schema=schema)


def _batches(shards: Iterable[Shard], keys: list[str], safe: bool) -> Iterator[pa.RecordBatch]:
    """Rows of the shards. Those of several with the same files are decoded together."""
    heads: list[tuple[str, str, int]] = []
    held: list[tuple[bytes, ...]] = []
    wanted: list[list[str]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        found = {k: c for data, of_file in zip(zip(*held), wanted) for k, c in zip(of_file, decode_examples(list(data), of_file))}
        columns = [found[k] if k in found else pa.nulls(len(held), arrow_type(k)) for k in keys]
        if not safe and any(c.null_count for c in columns):
            at = min(c.is_null().index(True).as_py() for c in columns if c.null_count)
            raise ValueError(f"{heads[at][0]} {heads[at][1]}: record {heads[at][2]} has no {', '.join(k for k, c in zip(keys, columns) if not c[at].is_valid)}")
        return _batch(heads, columns, keys)

    for shard in shards:
        of_shard = shard.wanted(keys)
        if held and of_shard != wanted:
            yield flush()
            heads, held, size = [], [], 0
        wanted = of_shard
        for position, together in enumerate(shard.messages()):
            heads.append((shard.subset, shard.shard, position))
            held.append(together)
            size += sum(map(len, together))
            if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield flush()
                heads, held, size = [], [], 0
    if held:
        yield flush()


class PoseRecords(DataSource):
    """format("pose_records") of a local or mounted path.

    Options: path, keys (comma-joined, all by default), pattern (below path), subsets and shards (comma-joined patterns of names), safe. With safe, keys that the first record of no dataset
    has are left out of the schema, as are unknown ones; without it, all keys must be known and each record must hold each.
    """

    @classmethod
    def name(cls) -> str:
        return "pose_records"

    @property
    def safe(self) -> bool:
        return self.options.get("safe", "true").lower() != "false"

    def keys(self) -> list[str]:
        wanted = [k.strip() for k in self.options.get("keys", "").split(",") if k.strip()] or list(KEYS)
        if unknown := [k for k in wanted if k not in KEYS]:
            if not self.safe:
                raise ValueError(f"unknown keys: {', '.join(unknown)}")
            wanted = [k for k in wanted if k in KEYS]
        return wanted

    def shards(self) -> list[Shard]:
        found = find_shards(self.options["path"], self.options.get("pattern", PATTERN), self.keys())
        subsets, shards = (self.options.get(k, "*").split(",") for k in ("subsets", "shards"))
        return [s for s in found if any(fnmatchcase(s.subset, x) for x in subsets) and any(fnmatchcase(s.shard, x) for x in shards)]

    def schema(self) -> str:
        keys = self.keys()
        if self.safe and (shards := self.shards()):
            present: set[str] = set()
            seen: set[str] = set()
            for shard in shards:
                if shard.subset not in seen:
                    heads = [next(records(pieces_of(path), path), None) for _, path in shard.paths]
                    if None not in heads:  # a shard without records tells nothing
                        seen.add(shard.subset)
                        present.update(k for head in heads for k in keys_of(head))
            keys = [k for k in keys if k in present]
        return ", ".join(["subset string", "shard string", "position int", *(f"{k} {spark_type(k)}" for k in keys)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return RecordReader(self.shards, [f.name for f in schema if f.name in KEYS], self.safe)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return RecordStreamReader(self.options["path"], self.options.get("pattern", PATTERN), [f.name for f in schema if f.name in KEYS], self.safe)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return RecordWriter(self.options["path"], overwrite)


class RecordReader(DataSourceReader):
    """find: gives the shards. They are not kept here, because each task gets a copy of the reader."""

    def __init__(self, find: Callable[[], list[Shard]], keys: list[str], safe: bool):
        self.find, self.keys, self.safe = find, keys, safe

    def partitions(self):
        return dealt_out(self.find())

    def read(self, partition):
        if partition is not None:  # what is read if there are no shards
            yield from _batches(partition.of, self.keys, self.safe)


class RecordStreamReader(DataSourceStreamReader):
    """Shards by the time at which they were committed. An offset is the last one's time and path."""

    def __init__(self, root: str, pattern: str, keys: list[str], safe: bool):
        self.root, self.pattern, self.keys, self.safe = root, pattern, keys, safe

    def _landed(self) -> list[tuple[int, str, Shard]]:
        shards = find_shards(self.root, self.pattern, self.keys)
        return sorted(((max(os.stat(p).st_mtime_ns for _, p in s.paths), s.paths[0][1], s) for s in shards), key=lambda x: x[:2])

    def initialOffset(self) -> dict:
        return {"time": 0, "path": ""}

    def latestOffset(self) -> dict:
        landed = self._landed()
        return {"time": landed[-1][0], "path": landed[-1][1]} if landed else self.initialOffset()

    def partitions(self, start: dict, end: dict):
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        return dealt_out([s for time, path, s in self._landed() if low < (time, path) <= high])

    def read(self, partition):
        yield from _batches(partition.of, self.keys, self.safe)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    shards: tuple[tuple[str, str], ...]  # temporary and final paths


def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, cut up so that images of about BATCH_BYTES are held at a time."""
    for batch in batches:
        step = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


class RecordWriter(DataSourceArrowWriter):
    """A shard for each range shard_start, shard_end of the rows, which come sorted by it; without these columns, one for each task."""

    def __init__(self, root: str, overwrite: bool):
        self.root, self.overwrite, self.job = root, overwrite, uuid.uuid4().hex

    def write(self, iterator):
        os.makedirs(f"{self.root}/data", exist_ok=True)
        done: list[tuple[str, str]] = []
        out = packer = planned = low = high = None

        def close():
            out.write(packer.flush())
            out.close()
            start, end = planned if planned else (low, high)
            done[-1] = (done[-1][0], f"{self.root}/data/{start:06}_{end:06}.tfrecord")

        try:
            for batch in sliced(iterator):
                index = batch.column("frame_index").to_pylist()
                ranges = list(zip(batch.column("shard_start").to_pylist(), batch.column("shard_end").to_pylist())) if "shard_start" in batch.schema.names else [None] * len(index)
                data = frame_records(encode_examples({k: batch.column(k) for k in KEYS if k in batch.schema.names}))
                for i, of, record in zip(index, ranges, data):
                    if out is None or of != planned:
                        if out is not None:
                            close()
                        done.append((f"{self.root}/data/_{self.job}_{uuid.uuid4().hex}", ""))
                        out, packer, planned = open(done[-1][0], "wb"), zlib.compressobj(), of
                        low = high = i
                    low, high = min(low, i), max(high, i)
                    out.write(packer.compress(record))
            if out is not None:
                close()
        except BaseException:
            if out is not None:
                out.close()
            for temporary, _ in done:
                os.remove(temporary)
            raise
        return Written(tuple(done))

    def _sweep(self) -> None:
        """Files of this job that no shard became."""
        for path in Path(self.root, "data").glob(f"_{self.job}_*"):
            path.unlink(missing_ok=True)

    def commit(self, messages):
        shards = [s for m in messages if m is not None for s in m.shards]
        finals = [final for _, final in shards]
        if len(set(finals)) < len(finals):
            self._sweep()
            raise ValueError("two tasks hold rows of one shard; write_records() deals rows out by shard")
        for temporary, final in shards:
            os.utime(temporary)  # a stream takes the commit for the time at which it landed
            os.replace(temporary, final)
        self._sweep()
        if self.overwrite:
            for path in Path(self.root, "data").glob("*.tfrecord"):
                if str(path) not in set(finals):
                    path.unlink()
        meta = Path(self.root, f"_{self.job}.json")
        meta.write_text(json.dumps({"version": 2.0}))
        os.replace(meta, f"{self.root}/metadata.json")

    def abort(self, messages):
        self._sweep()


def register(spark: SparkSession) -> None:
    """Make format("pose_records") known."""
    spark.dataSource.register(PoseRecords)


def read_records(spark: SparkSession, root: str, keys: list[str] | None = None, pattern: str = PATTERN, subsets: str = "*", shards: str = "*", safe: bool = True) -> DataFrame:
    register(spark)
    reader = spark.read.format("pose_records").options(pattern=pattern, subsets=subsets, shards=shards, safe=str(safe).lower())
    return (reader.option("keys", ",".join(keys)) if keys else reader).load(root)


def read_records_from_store(spark: SparkSession, root: str, keys: list[str], pattern: str = "*.tfrecord") -> DataFrame:
    """Records of version 2 below a root in any store that Spark reads; a shard of up to 2 GB is a row until it is decoded.

    Subset is the folder above `data`, below the root. Keys that a record lacks are null.
    """
    unknown = [k for k in keys if k not in KEYS]
    if unknown:
        raise ValueError(f"unknown keys: {', '.join(unknown)}")

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                path, content = batch.column("path")[i].as_py(), batch.column("content")[i].as_buffer()
                subset, shard = batch.column("subset")[i].as_py(), Path(path).stem
                heads, held, size = [], [], 0
                pieces = (bytes(content[a : a + (1 << 20)]) for a in range(0, len(content), 1 << 20))
                for position, data in enumerate(records(pieces, path)):
                    heads.append((subset, shard, position))
                    held.append(data)
                    size += len(data)
                    if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield _batch(heads, decode_examples(held, keys), keys)
                        heads, held, size = [], [], 0
                if held:
                    yield _batch(heads, decode_examples(held, keys), keys)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").rsplit("/", 1)[-1]
    below = F.regexp_extract("path", rf"/{base}/(?:(.*)/)?data/[^/]*$", 1)
    ddl = ", ".join(["subset string", "shard string", "position int", *(f"{k} {spark_type(k)}" for k in keys)])
    return files.select("path", F.coalesce(below, F.lit("")).alias("subset"), "content").mapInArrow(work, ddl)


def write_records(frames: DataFrame, root: str, divisor: int, mode: str = "append") -> None:
    """A shard for each range of the plan of frame_index. Mode overwrite also removes shards that are not in the plan.

    Rows are dealt out by shards, so names don't depend on the number of tasks. A frame_index must not be null or repeated.
    """
    register(frames.sparkSession)
    indices = placed_in_shards(frames, "frame_index", divisor).select(F.col("i").alias("frame_index"), F.col("start").alias("shard_start"), F.col("end").alias("shard_end"))
    dealt = frames.join(indices, "frame_index").repartition("shard_start").sortWithinPartitions("shard_start", "frame_index")
    columns = ["frame_index", "shard_start", "shard_end", *(k for k in KEYS if k in frames.columns)]
    dealt.select(*columns).write.format("pose_records").mode(mode).save(root)
