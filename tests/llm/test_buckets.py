"""Buckets of line dedup, whatever their size and wherever a batch ends."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from posetables.llm import linedup


@pytest.mark.parametrize("per_batch", [1, 2, 7, 10_000])
def test_members_of_buckets(spark, per_batch):
    rng = random.Random(per_batch)
    rows = [(rng.randrange(60), rng.randrange(40)) for _ in range(300)] + [(1000, 5)] * 50 + [(1001, x % 90) for x in range(400)] + [(-7, 3), (-7, 4), (2000, 1)]
    held = defaultdict(set)
    for k, h in rows:
        held[k].add(h)
    want = sorted((k, h) for k, own in held.items() if len(own) > 1 for h in own)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        got = linedup._bucket_members(spark.createDataFrame(rows, "key long, h long")).collect()
        assert sorted(map(tuple, got)) == want
        assert linedup._bucket_members(spark.createDataFrame([], "key long, h long")).collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def _lines(r, n):
    return ["".join(r.choices("abcd efgé漢😀", k=r.choice([1, 3, 8, 30, 200, 900]))).strip() or "x" for _ in range(n)]


def test_signatures_never_lose_a_pair():
    """Bits differ in no more places than shingle sets do; sizes are exact, and a line's signature doesn't depend on the others."""
    r = random.Random(4)
    left = _lines(r, 400)
    right = [x[: (k := r.randrange(len(x) + 1))] + r.choice(["z", "zz", " q"]) + x[k + r.randrange(3) :] for x in left]
    sizes, bits = linedup.signatures(left + right)
    assert sizes.tolist() == [len(linedup.shingles(x.encode())) for x in left + right]
    n = len(left)
    for i in range(n):
        x, y = linedup.shingles(left[i].encode()), linedup.shingles(right[i].encode())
        differ = int(np.bitwise_count((bits[i] ^ bits[n + i]).view(np.uint64)).sum())
        assert differ <= len(x ^ y)
        if linedup.jaccard(left[i].encode(), right[i].encode()) >= 0.8:
            assert differ <= linedup._unlike(0.8) * (sizes[i] + sizes[n + i])
    one = linedup.signatures(left[7:8])
    assert one[0][0] == sizes[7] and (one[1][0] == bits[7]).all()


@pytest.mark.parametrize("run", [1, 3, 2048])
def test_packed_band_keys(monkeypatch, run):
    """A row of the shuffle holds many band keys, in 12 bytes each; merged, they are in order, also of a key with more rows than a run holds."""
    monkeypatch.setattr(linedup, "RUN", run)
    monkeypatch.setattr(linedup, "PACKED", 500)
    g = np.random.default_rng(run)
    keys, h = g.integers(-(1 << 42), 1 << 42, 3000), g.integers(-(1 << 63), (1 << 63) - 1, 3000)
    keys[::3] = 12345
    rows = pa.Table.from_batches(linedup._runs([(keys[i : i + 300], h[i : i + 300]) for i in range(0, 3000, 300)])).sort_by([("part", "ascending"), ("key", "ascending"), ("h", "ascending")])
    assert sum(rows.column(x).combine_chunks().nbytes for x in ("keys", "hashes")) <= 12 * 3000 + 8 * (rows.num_rows + 1)
    for size in (1, 7, 10_000):
        k, got = (np.concatenate(x) for x in zip(*linedup._merged(rows.to_batches(size))))
        assert list(zip(k.tolist(), got.tolist())) == sorted(zip((keys & ((1 << 43) - 1)).tolist(), h.tolist()))


def test_smallest_line_and_third_line_of_buckets(spark):
    rows = [(1, 5), (1, 3), (2, 9), (3, 1), (3, 2), (3, 7), (3, 7), (4, 4), (4, 4)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for per_batch in (1, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
            got = linedup._bucket_members(spark.createDataFrame(rows, "key long, h long"), more=True).collect()
            assert sorted(map(tuple, got)) == [(1, 3, 3, False), (1, 5, 3, False), (3, 1, 1, True), (3, 2, 1, True), (3, 7, 1, True)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
