"""Removal of repeated strings against a dictionary of every string, and suffix order against sorted()."""

import hashlib
import random

import numpy as np
import pytest

from posetables.llm import suffixes as s


def brute(rows, length=100):
    """doc_id -> (bytes, removed, spans, digest), by a dictionary of all strings in order."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if (x := data[i : i + length]) in seen:
                gone[i : i + length] = True
            seen.add(x)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out[doc_id] = (len(data), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def ours(df, **kw):
    rows = s.remove_repeats(df, **kw).drop("kept").collect()
    assert len(rows) == df.count()
    return {r.doc_id: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("letters,n,length", [(2, 400, 5), (2, 3000, 40), (4, 2000, 8), (200, 2000, 3), (1, 300, 20)])
def test_order_of_suffixes(letters, n, length):
    rng = np.random.default_rng(n)
    data = rng.integers(0, letters, n).astype(np.uint8)
    data[rng.integers(0, n, 5)] = 255
    for share in (1.0, 0.3):
        wanted = np.zeros(n, bool)
        wanted[: n - length] = rng.random(n - length) < share
        order = s.sort_suffixes(data, wanted, length)
        strings = [data[i : i + length].tobytes() for i in order]
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        assert strings == sorted(strings)
        lcp = s.common_prefixes(data, order, length, at_once=17)
        for k in range(1, len(order)):
            want = next((j for j, (a, b) in enumerate(zip(strings[k - 1], strings[k])) if a != b), length)
            assert lcp[k] == want


def test_anchors_cover_each_string_once(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randrange(0, 700))).encode() for _ in range(60)] + [b"", b"x" * 99, b"y" * 100, b"z" * 400]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for step in (1 << 20, 256):
        monkeypatch.setattr(s, "STEP", step)
        h, document, start, n = s.anchors(np.frombuffer(b"".join(texts), np.uint8), offsets)
        by_string = {}
        starts = []
        for a, d, x, k in zip(h, document, start, n):
            for i in range(x, x + k):
                starts.append((d, i))
                assert by_string.setdefault(texts[d][i : i + 100], a) == a
        assert sorted(starts) == [(d, i) for d, t in enumerate(texts) for i in range(len(t) - 99)]


def made_rows():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghié日") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [prose(40) for _ in range(6)] + ["ab" * 300, "-" * 150]
    rows = [(i, " ".join(x for _ in range(3) for x in (prose(rng.randrange(30)), rng.choice(shared)))) for i in range(0, 300, 2)]
    rows += [(i + 1, t if i % 4 else t[: len(t) // 2] + "!" + t[len(t) // 2 :]) for i, t in rows[:60]]
    return rows + [(1001, ""), (1002, None), (1003, "x" * 99), (1004, "x" * 100), (1005, "x" * 101), (1006, "x" * 5000), (1007, prose(30) + "é" * 60 + prose(3)), (1008, prose(1) + "é" * 60)]


@pytest.mark.parametrize("tile_rows,sorted_bytes", [(4096, 3_000_000), (7, 2000), (1, 1)])
def test_made_rows(spark, tile_rows, sorted_bytes):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as tag", "'x' as runs", "2 as h")
    assert ours(df.repartition(5), tile_rows=tile_rows, sorted_bytes=sorted_bytes) == brute(rows)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([tuple(r) for r in df.select("doc_id", "text").collect()])
    got = {r.doc_id: tuple(r)[1:] for r in s.op11_suffix_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert got == want
    assert sum(r[1] for r in want.values()) > 0


def test_repeated_ids_and_empty_table(spark):
    text = "".join(random.Random(1).choices("abcdef ", k=300))
    rows = s.remove_repeats(spark.createDataFrame([(1, text), (1, text), (2, text), (2, "other"), (None, text), (None, None)], "doc_id long, text string")).drop("kept").collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in rows) == [(0, 0, 0), (0, 300, 0), (1, 300, 300), (1, 300, 300), (2, 5, 0), (2, 300, 300)]
    assert s.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
