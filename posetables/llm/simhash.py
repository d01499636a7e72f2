"""SimHash near-duplicates with pivot distance tables.

Fingerprints: each bit is the majority of that bit over the XXH64 values of all 3-word shingles. Equal
fingerprints meet first, so that copies cost one row. Distinct ones are cut into blocks of bits; two that differ
in at most max_bits bits agree in all but max_bits blocks, so they meet in the bucket of some choice of agreeing
blocks (nothing is lost). In a bucket, each fingerprint's Hamming distances to many fixed reference fingerprints
(the pivots) are tabled. Because |d(x,p) - d(y,p)| <= d(x,y), pairs whose tables differ by more than max_bits in
any coordinate are discarded, the first coordinate by sorted windows; survivors are verified bit by bit. A bucket
of more than TILE fingerprints is dealt out as pairs of tiles, and each task gives a spanning forest of the links
that it found, never its pairs. Components come from distributed union-find.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any other; rows with the
same doc_id are rows of their own; a null doc_id keeps its row and never names a component unless all of its
component's ids are null; an empty table gives an empty result; texts of any length are read whole; other
columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_texts, shared, table
from .components import connected_components, popcount, spanning_stars

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BLOCKS = 5
TILE = 2048
PIVOTS = np.random.default_rng(6).integers(0, 2**64, 24, dtype=np.uint64)


def shingle_hashes(text: str, shingle: int = SHINGLE) -> list[int]:
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space parts words
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return [digest(b" ".join(words), SEED)]
    return [digest(x, SEED) for x in map(b" ".join, zip(*(words[i:] for i in range(shingle))))]


def fingerprint_array(texts: list[str]) -> np.ndarray:
    """Fingerprints (uint64) of texts."""
    ones = np.zeros((len(texts), 64), bool)
    for i, text in enumerate(texts):
        h = np.array(shingle_hashes(text), np.uint64)
        if len(h):
            for k in range(0, len(h), 1 << 16):  # a bounded table of bits for long texts
                bits = np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                total = bits.sum(axis=0, dtype=np.int64) + (total if k else 0)
            ones[i] = 2 * total > len(h)
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    return map_texts(docs, lambda texts: [fingerprint_array(texts).view(np.int64)], "fp long")


def block_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """Bit masks of every choice of blocks - max_bits blocks of the 64 bits."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << k for k in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(parts, blocks - max_bits)]


def pivot_links(fps: np.ndarray, side: np.ndarray | None, max_bits: int = MAX_BITS, pivots: np.ndarray = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs within max_bits; with side, only pairs from different sides."""
    first = popcount(fps ^ pivots[0]).astype(np.int16)
    order = np.argsort(first, kind="stable")
    fps, tables = fps[order], popcount(fps[order][:, None] ^ pivots[None, :]).astype(np.int16)
    side = None if side is None else side[order]
    end = np.searchsorted(tables[:, 0], tables[:, 0] + max_bits, side="right")
    out_i, out_j = [], []
    for a in range(0, len(fps), 256):
        rows = np.arange(a, min(a + 256, len(fps)))
        n = end[rows] - rows - 1
        i = np.repeat(rows, n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + i + 1
        if side is not None:
            keep = side[i] != side[j]
            i, j = i[keep], j[keep]
        for k in range(1, len(pivots)):
            keep = np.abs(tables[i, k] - tables[j, k]) <= max_bits
            i, j = i[keep], j[keep]
        keep = popcount(fps[i] ^ fps[j]) <= max_bits
        out_i.append(order[i[keep]])
        out_j.append(order[j[keep]])
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.zeros(0, np.int64),) * 2


def pivots_allow(x: np.ndarray, y: np.ndarray, max_bits: int = MAX_BITS, pivots: np.ndarray = PIVOTS) -> np.ndarray:
    """Which pairs x[i], y[i] are within max_bits: those that no pivot discards are verified."""
    keep = np.arange(len(x))
    for p in pivots:
        far = np.abs(popcount(x[keep] ^ p).astype(np.int16) - popcount(y[keep] ^ p).astype(np.int16)) > max_bits
        keep = keep[~far]
    out = np.zeros(len(x), bool)
    out[keep] = popcount(x[keep] ^ y[keep]) <= max_bits
    return out


def _bucket_links(max_bits: int):
    def links(rows: dict[str, np.ndarray]) -> tuple[list[int], list[int]]:
        fps = rows["fp"]
        if len(fps) < 2:
            return [], []
        side = rows["tile"] if rows["pa"][0] != rows["pb"][0] else None
        i, j = pivot_links(fps.view(np.uint64), side, max_bits)
        return spanning_stars(fps[i].tolist(), fps[j].tolist())

    keys = ["t", "key", "pa", "pb"]

    def work(batches):
        rest: dict[str, np.ndarray] | None = None
        for batch in batches:  # sorted by key: a bucket is a run, which may go on in the next batch
            cols = {c: batch.column(c).to_numpy() for c in [*keys, "tile", "fp"]}
            if rest is not None:
                cols = {c: np.concatenate([rest[c], v]) for c, v in cols.items()}
            n = len(cols["fp"])
            if not n:
                continue
            cut = np.flatnonzero(np.logical_or.reduce([cols[c][1:] != cols[c][:-1] for c in keys])) + 1
            starts = np.concatenate([[0], cut, [n]])
            a, b = [], []
            twos = starts[:-2][np.diff(starts[:-1]) == 2]  # buckets of two, all at once
            x, y = cols["fp"][twos], cols["fp"][twos + 1]
            near = pivots_allow(x.view(np.uint64), y.view(np.uint64), max_bits) if len(twos) else np.zeros(0, bool)
            a += x[near].tolist()
            b += y[near].tolist()
            for s, e in zip(starts[:-2], starts[1:-1]):
                if e - s == 2:
                    continue
                x, y = links({c: v[s:e] for c, v in cols.items()})
                a += x
                b += y
            rest = {c: v[starts[-2] :] for c, v in cols.items()}
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        if rest is not None:
            a, b = links(rest)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Links a, b that span the components of distinct fingerprints fp within max_bits."""
    masks = block_masks(blocks, max_bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    banded = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("t", "key"))
    many = banded.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = banded.join(many, ["t", "key"]).withColumn("k", F.ceil(F.col("n") / TILE).cast("int")).withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
    pairs = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    dealt = pairs.select("t", "key", F.least("tile", "other").alias("pa"), F.greatest("tile", "other").alias("pb"), "tile", "fp")
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "t", "key", "pa", "pb").sortWithinPartitions("t", "key", "pa", "pb").mapInArrow(_bucket_links(max_bits), "a long, b long")


def simhash_components(docs: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links of at most max_bits bits)."""
    fps = shared(with_fingerprints(docs))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = connected_components(fingerprint_links(distinct.select("fp"), max_bits, blocks))
    placed = shared(distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root")))
    names = shared(placed.groupBy("root").agg(F.min("least").alias("component_id")))  # so that Spark can split a large component
    by_fp = placed.join(names, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns.

    Documents are known by doc_id: rows that share one are one document and stay or go together; those with a null
    doc_id stay.
    """
    kept = simhash_components(docs, max_bits, blocks).where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long") == kept["_kept"], "left_semi").unionByName(docs.where("doc_id is null"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
