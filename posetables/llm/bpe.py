"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last WINDOW characters cuts a text where its low bits are zero, so that documents that
share a passage share its chunks, wherever the passage stands. A worker encodes each chunk once and reuses the ids for
every document in which it comes again. A chunk's ends are not trusted: at a join, the text from the last but one place of
the left chunk where a pre-token starts (a space before a character that is no white space) to the second such place of the
right one is encoded anew, and must agree with the left chunk's ids up to its last place and with the right chunk's from
its first place on. As long as it doesn't, or a chunk has too few such places, the stretch grows over the next chunk.
The ids are those of the whole text, which tests hold against the tokenizers library.

Defined results: null and empty texts have no ids and decode to the empty text; the special token's string in a
text is the special token, as in the library; repeated rows are encoded alike; an empty table gives an empty
result; texts of any length are encoded whole; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import sha256_hex, slices, table, texts_of

WINDOW = 16
MEAN_CHUNK = 256
#: A task's cache of chunks has two generations of so many chunks each; the older one goes when the newer one is full.
CACHE_CHUNKS = 20_000
CACHE_JOINS = 50_000
RANKS_FILE = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json as ranks
SPECIAL = {"<|endoftext|>": 50256}


def load_encoding(path: str | None = None):
    """The tiktoken encoding of a ranks file; by default the public 50k byte-level vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(RANKS_FILE), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def cut_points(text: str, window: int = WINDOW, mean: int = MEAN_CHUNK) -> list[int]:
    """Where a text is cut: after characters at which the rolling hash of the last window characters has zero low bits."""
    n = len(text)
    if n <= 2 * window:
        return []
    h = np.frombuffer(text.encode("utf-32-le"), np.uint32) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    step, factor = 1, 0x01000193
    while step < window:  # sums over 2, 4, 8, ... characters
        h = h[step:] + h[:-step] * np.uint32(factor)
        factor = factor * factor & 0xFFFFFFFF
        step *= 2
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    return (np.flatnonzero((h >> np.uint32(12)) & np.uint32(mean - 1) == 0) + window).tolist()


def sync_points(chunk: str) -> tuple[int, int, int, int] | None:
    """The first two and the last two places in a chunk at a space before what is no white space; None if there aren't four."""

    def step(i: int, back: bool) -> int:
        while i >= 0 and (i + 1 >= len(chunk) or chunk[i + 1].isspace()):
            i = chunk.rfind(" ", 0, i) if back else chunk.find(" ", i + 1)
        return i

    a = step(chunk.find(" "), False)
    b = step(chunk.find(" ", a + 1), False) if a >= 0 else -1
    d = step(chunk.rfind(" "), True)
    c = step(chunk.rfind(" ", 0, d), True) if d > 0 else -1
    return (a, b, c, d) if 0 <= a < b <= c < d else None


class Chunk:
    """A chunk of a text with ids of its own: head, ids from the first to the last trusted place, tail; and what a join must agree with."""

    __slots__ = ("head", "first", "middle", "last", "tail", "text")

    def __init__(self, text: str, ids: Callable[[str], bytes]):
        self.text = text
        at = sync_points(text)
        if at is None:
            self.middle = None
            return
        a, b, c, d = at
        self.head, self.tail = text[:b], text[c:]
        self.first, self.middle, self.last = ids(text[a:b]), ids(text[b:c]), ids(text[c:d])


class ChunkEncoder:
    """encode(text): ids as little-endian uint32 bytes."""

    def __init__(self, encode: Callable[[str], list[int]], chunks: int = CACHE_CHUNKS, joins: int = CACHE_JOINS):
        self.plain, self.most_chunks, self.most_joins = encode, chunks, joins
        self.young: dict[str, Chunk] = {}
        self.old: dict[str, Chunk] = {}
        self.joins: dict[str, bytes] = {}
        self.encoded = self.reused = self.grown = 0

    def ids(self, text: str) -> bytes:
        return np.array(self.plain(text), "<u4").tobytes()

    def chunk(self, text: str) -> Chunk:
        if text in self.young:
            self.reused += 1
            return self.young[text]
        if text in self.old:
            self.reused += 1
            found = self.old[text]
        else:
            self.encoded += 1
            found = Chunk(text, self.ids)
        if len(self.young) >= self.most_chunks:
            self.old, self.young = self.young, {}
        self.young[text] = found
        return found

    def join(self, text: str) -> bytes:
        """Ids of the stretch between two chunks' trusted parts."""
        if len(text) > 64:
            return self.ids(text)
        if (ids := self.joins.get(text)) is None:
            if len(self.joins) >= self.most_joins:
                self.joins.clear()
            ids = self.joins[text] = self.ids(text)
        return ids

    def ordinary(self, text: str, whole: list[bytes]) -> None:
        out: list[bytes] = []
        begin, open_end, agreed = 0, "", b""  # what is not yet encoded, and the ids with which that must begin
        for end in [*cut_points(text), len(text)]:
            if begin == end:
                continue
            chunk = self.chunk(text[begin:end])
            begin = end
            if chunk.middle is not None:
                ids = self.join(open_end + chunk.head)
                if ids.startswith(agreed) and ids.endswith(chunk.first) and len(ids) >= len(agreed) + len(chunk.first):
                    out += (ids, chunk.middle)
                    open_end, agreed = chunk.tail, chunk.last
                    continue
                self.grown += 1
            open_end += chunk.text
        rest = self.ids(open_end)
        whole += [*out, rest] if rest.startswith(agreed) else [self.ids(text)]

    def encode(self, text: str) -> bytes:
        out: list[bytes] = []
        for k, part in enumerate(text.split(token := next(iter(SPECIAL)))):
            if k:
                out.append(np.array([SPECIAL[token]], "<u4").tobytes())
            if part:
                self.ordinary(part, out)
        return b"".join(out)


_worker: dict = {}


def worker_encoding(path: str | None):
    """One encoding and one chunk cache for each Python worker, kept from task to task."""
    if path not in _worker:
        encoding = load_encoding(path)
        _worker[path] = encoding, ChunkEncoder(encoding.encode_ordinary)
    return _worker[path]


def _encoded(encoder: ChunkEncoder, texts: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(encoder.encode(t), "<u4") for t in texts]


def _decoded(encoding, doc_id: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    """DECODED of rows with these ids."""
    return pa.RecordBatch.from_pydict({
        "doc_id": doc_id,
        "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
        "ids_sha256": pa.array([sha256_hex(x.astype("<u4").tobytes()) for x in ids], pa.string()),
        "text": pa.array([encoding.decode_bytes(x.tolist()).decode("utf-8", "replace") for x in ids], pa.string()),
    })


DECODED = "doc_id long, n_tokens long, ids_sha256 string, text string"


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) of every document."""

    def work(batches):
        _, encoder = worker_encoding(path)
        for batch in batches:
            for start, end, texts in slices(batch):
                ids = _encoded(encoder, texts)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                values = pa.array(np.concatenate(ids).view("<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, end - start), pa.ListArray.from_arrays(offsets, values)], names=["doc_id", "ids"])

    return texts_of(docs).mapInArrow(work, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and the decoded text of doc_id, ids."""

    def work(batches):
        encoding, _ = worker_encoding(path)
        for batch in batches:
            lists = batch.column("ids")
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for a in range(0, batch.num_rows, 256):
                rows = range(a, min(a + 256, batch.num_rows))
                yield _decoded(encoding, batch.column("doc_id").slice(a, len(rows)), [values[offsets[i] : offsets[i + 1]] for i in rows])

    return encoded.mapInArrow(work, DECODED)


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """decode_documents(encode_documents(docs)) with one Python worker for each task rather than two; ids stay in it."""

    def work(batches):
        encoding, encoder = worker_encoding(path)
        for batch in batches:
            for start, end, texts in slices(batch):
                yield _decoded(encoding, batch.column("doc_id").slice(start, end - start), _encoded(encoder, texts))

    return texts_of(docs).mapInArrow(work, DECODED)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = encode_and_decode(table(spark, sf_dir, "documents"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
