"""Language-model scoring with a weighted backoff automaton.

The n-grams of the training documents, up to ORDER words, become an automaton. Its states are the root, every word,
and every word pair that was seen; a state has an arc for each word seen after it. The root has an arc for every word,
weighted by the smoothed unigram log10((c + 0.1) / (N + 0.1 (V + 1))), one for unknown words too. Higher arcs have the
Dirichlet-smoothed log10((c(hw) + K P(w | h')) / (c(h) + K)) (MacKay and Peto, 1995), where h' is h without its first
word. A failure arc leads from each state to the state of its longest proper suffix, weighted log10(K / (c(h) + K)),
so the weights that leave a state sum to one. A text is read once from left to right: while the state has no arc for
the token the failure arc is taken, then the arc, and the weights add up to the text's log-probability. Many texts are
walked side by side, each with a state of its own; a long text is walked in pieces, each of which first reads the
ORDER - 1 words before it, after which the state is that of the whole walk.

The model is never in one place. Each task packs its texts into blocks of about BLOCK_CHARS characters; a block sends
its distinct n-grams, with training counts, to buckets of the hash range (sorted and delta-coded, a binary row for each
block and bucket that have n-grams in common, so never more rows than n-grams), a bucket adds up what all blocks sent and
answers each block with the totals of just its n-grams, in the order in which they came, so that the answers need no
keys. From them a block builds the part of the automaton that its texts can reach. Blocks and buckets grow with the
input in number, not in size, a frequent n-gram weighs a few bytes for each block, and nothing but a sum of lengths goes
to the driver; N and V are one row.

N-grams are known by 64-bit hashes: with 1e8 distinct ones the chance that any two collide is about 3e-4.

Defined results: null and empty texts have one token, the end; repeated rows count again; a null doc_id is hashed as
the empty string, to tell its fold; an empty table gives an empty result; further columns are ignored. Texts of any
length are scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import slices, table, texts_of

ALPHA = 0.1
ORDER = 3
#: Weight of the next lower state's distribution, in tokens, for states of one word and of two.
CONCENTRATION = (1000.0, 3.0)
BLOCK_CHARS = 8_000_000
#: Tokens that are walked in one piece.
PIECE = 1024
END = np.uint64(xxhash.xxh64_intdigest(b"</s>\n"))  # no word holds a line feed
START = np.uint64(xxhash.xxh64_intdigest(b"<s>\n"))
_M = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> np.ndarray:
    words = text.lower().split()  # of bytes: only A-Z change, only ASCII white space parts words
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    h = (v ^ (v >> np.uint64(31))) * _M + w
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _coded(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers with bytes of like weight together, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in arrays))


def _decoded(data: bytes, sizes: list[int], dtype) -> list[np.ndarray]:
    raw, width, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), np.dtype(dtype).itemsize, 0, []
    for n in sizes:
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(dtype).reshape(-1))
        at += n * width
    return out


class Block:
    """The n-grams of a block of texts (bytes). keys[k]: sorted distinct hashes of the (k+1)-grams; ids[k]: the place in keys[k] of the one that ends at each token.

    A text's first word follows START; there is no trigram at it (its id is meaningless).
    """

    def __init__(self, texts: list[bytes]):
        each = [tokens(t) for t in texts]
        self.sizes = np.array([len(x) for x in each])
        self.starts = np.cumsum(self.sizes) - self.sizes
        grams = [np.concatenate(each)]
        inner = np.ones(len(grams[0]), bool)
        inner[self.starts] = False
        before = np.empty_like(grams[0])
        before[1:], before[self.starts] = grams[0][:-1], START
        grams.append(pair_hash(before, grams[0]))
        before[1:] = grams[1][:-1]
        grams.append(pair_hash(before, grams[0]))
        self.inner, self.keys, self.ids = inner, [], []
        for k, h in enumerate(grams):
            keys, ids = np.unique(h if k < 2 else h[inner], return_inverse=True)
            if k == 2:
                whole = np.zeros(len(h), ids.dtype)
                whole[inner] = ids
                ids = whole
            self.keys.append(keys)
            self.ids.append(ids)

    def edges(self, order: int, buckets: int) -> np.ndarray:
        """Where each bucket's hashes begin, and the end of the last."""
        bucket = (self.keys[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


class Automaton:
    """The part of the model that a block's texts can reach.

    States: 0 is the root; 1 + i follows word i; the next one follows START; pairs + i follows pair i. Arcs are numbered
    by n-gram: the word's, then the pairs', then the triples'. weight is nan for an arc that isn't there.
    """

    def __init__(self, block: Block, totals: list[np.ndarray], n: int, v: int, concentration=CONCENTRATION):
        c1, c2, c3 = totals
        words, pairs = len(c1), len(c2)
        self.ids = [block.ids[0], block.ids[1] + words, block.ids[2] + words + pairs]
        before = np.empty(len(block.ids[0]), np.int64)  # the word before each token, as a number; START is the last
        before[1:], before[block.starts] = block.ids[0][:-1], words
        first, last, pair_of, suffix_of = np.empty(pairs, np.int64), np.empty(pairs, np.int64), np.zeros(len(c3), np.int64), np.zeros(len(c3), np.int64)
        first[block.ids[1]], last[block.ids[1]] = before, block.ids[0]
        inner = np.flatnonzero(block.inner)
        pair_of[block.ids[2][inner]], suffix_of[block.ids[2][inner]] = block.ids[1][inner - 1], block.ids[1][inner]
        texts = c1[block.ids[0][block.starts[0] + block.sizes[0] - 1]]  # as many starts as ends
        c1s = np.append(c1, texts)
        k2, k3 = concentration
        with np.errstate(divide="ignore"):
            p1 = (c1 + ALPHA) / (n + ALPHA * (v + 1))
            p2 = (c2 + k2 * p1[last]) / (c1s[first] + k2)
            p3 = (c3 + k3 * p2[suffix_of]) / (c2[pair_of] + k3)
            self.weight = np.log10(np.concatenate([p1, np.where(c2 > 0, p2, np.nan), np.where(c3 > 0, p3, np.nan)]))
            self.fail_weight = np.concatenate([[0.0], np.log10(k2 / (c1s + k2)), np.log10(k3 / (c2 + k3))])
        self.start = 1 + words
        first_pair = self.start + 1
        self.fail = np.concatenate([[0], np.zeros(words + 1, np.int64), 1 + last])
        self.target = np.concatenate([np.where(c1 > 0, 1 + np.arange(words), 0), first_pair + np.arange(pairs), first_pair + suffix_of])
        self.level = np.repeat(np.array([0, 1, 2], np.int8), [1, words + 1, pairs])

    def walk(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log10 probability of each text (its first token's place, and its number of tokens)."""
        pieces = -(-sizes // PIECE)
        text = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        skip = np.where(nth > 0, ORDER - 1, 0)  # tokens before the piece, read for the state alone
        begin = starts[text] + nth * PIECE - skip
        length = np.minimum(PIECE, sizes[text] - nth * PIECE) + skip
        order = np.argsort(-length, kind="stable")
        begin, skip, length = begin[order], skip[order], length[order]
        state, total = np.where(skip > 0, 0, self.start), np.zeros(len(order))
        active = np.searchsorted(-length, -np.arange(length[0]), side="left")
        a, b, c = self.ids
        for t, m in enumerate(active.tolist()):
            at, s = begin[:m] + t, state[:m]
            level = self.level[s]
            arc = np.where(level == 2, c[at], np.where(level == 1, b[at], a[at]))
            step = self.weight[arc]
            lost = np.flatnonzero(np.isnan(step))
            failed = np.zeros(m)
            while len(lost):
                failed[lost] += self.fail_weight[s[lost]]
                s[lost] = self.fail[s[lost]]
                arc[lost] = np.where(self.level[s[lost]] == 1, b[at[lost]], a[at[lost]])
                step[lost] = self.weight[arc[lost]]
                lost = lost[np.isnan(step[lost])]
            step += failed
            if t < ORDER - 1:
                step[skip[:m] > t] = 0.0
            total[:m] += step
            state[:m] = self.target[arc]
        return np.bincount(text[order], total, len(sizes))


PACKED = "block long, doc_id array<long>, held_out array<boolean>, sizes array<int>, texts binary"
SENT = "block long, bucket int, sizes array<int>, keys binary, counts binary"
ANSWERED = "block long, bucket int, sizes array<int>, totals binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, token_score double"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _pack(batches):
    """Blocks of about BLOCK_CHARS characters of a task's texts; a longer text is a block of its own."""
    from pyspark import TaskContext

    number, schema = TaskContext.get().partitionId() << 32, _arrow(PACKED)

    def row(ids, held, texts):
        return pa.RecordBatch.from_pylist([{"block": number, "doc_id": ids, "held_out": held, "sizes": [len(x) for x in texts], "texts": zstandard.ZstdCompressor(level=3).compress(b"".join(texts))}], schema=schema)

    ids, held, texts, size = [], [], [], 0
    for batch in batches:
        for start, end, some in slices(batch):
            ids += batch.column("doc_id").slice(start, end - start).to_pylist()
            held += batch.column("held_out").slice(start, end - start).to_pylist()
            texts += [x.encode() for x in some]
            size += sum(map(len, some))
            if size >= BLOCK_CHARS:
                yield row(ids, held, texts)
                number += 1
                ids, held, texts, size = [], [], [], 0
    if texts:
        yield row(ids, held, texts)


def _texts(row: dict) -> list[bytes]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(row["texts"]), [], 0
    for n in row["sizes"]:
        out.append(raw[at : at + n])
        at += n
    return out


def _send(buckets: int):
    def work(batches):
        schema = _arrow(SENT)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block(_texts(row))
                train = np.repeat(~np.array(row["held_out"], bool), block.sizes)
                counts = []
                for k in range(ORDER):
                    use = train & block.inner if k == 2 else train
                    counts.append(np.bincount(block.ids[k][use], minlength=len(block.keys[k])).astype(np.uint32))
                edges = [block.edges(k, buckets) for k in range(ORDER)]
                out = []
                for bucket in range(buckets):
                    cuts = [(e[bucket], e[bucket + 1]) for e in edges]
                    if all(a == b for a, b in cuts):
                        continue
                    parts = [block.keys[k][a:b].copy() for k, (a, b) in enumerate(cuts)]
                    for k, (a, b) in enumerate(cuts):
                        parts[k][1:] -= block.keys[k][a:b][:-1]
                    out.append({"block": row["block"], "bucket": bucket, "sizes": [b - a for a, b in cuts], "keys": _coded(*parts), "counts": _coded(*[counts[k][a:b] for k, (a, b) in enumerate(cuts)])})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return work


def _totals(rows: pa.Table, order: int) -> tuple[np.ndarray, list[int], np.ndarray]:
    """What all blocks sent of an order: (totals of the distinct n-grams, where each block's end, their places among the distinct ones)."""
    sizes = rows.column("sizes").to_pylist()
    keys = [np.cumsum(_decoded(x, s, np.uint64)[order], dtype=np.uint64) for x, s in zip(rows.column("keys").to_pylist(), sizes)]
    counts = np.concatenate([_decoded(x, s, np.uint32)[order] for x, s in zip(rows.column("counts").to_pylist(), sizes)])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    return np.bincount(place, weights=counts, minlength=len(distinct)), np.cumsum([len(x) for x in keys]).tolist(), place


def _words(rows: pa.Table) -> pa.Table:
    """n and v of a bucket's words."""
    totals, _, _ = _totals(rows, 0)
    return pa.table({"n": pa.array([int(totals.sum())], pa.int64()), "v": pa.array([int((totals > 0).sum())], pa.int64())})


def _add(rows: pa.Table) -> pa.Table:
    mine: list[list[np.ndarray]] = [[] for _ in range(rows.num_rows)]
    for order in range(ORDER):
        totals, ends, place = _totals(rows, order)
        for own, a, b in zip(mine, [0, *ends[:-1]], ends):
            own.append(totals[place[a:b]].astype(np.uint64))
    return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"), "sizes": rows.column("sizes"), "totals": [_coded(*own) for own in mine]}, schema=_arrow(ANSWERED))


def _score(concentration):
    def work(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row, schema = rows.to_pylist()[0], _arrow(SCORED)
        answers = answers.sort_by("bucket")
        parts = [_decoded(x, s, np.uint64) for x, s in zip(answers.column("totals").to_pylist(), answers.column("sizes").to_pylist())]
        totals = [np.concatenate([p[k] for p in parts]).astype(np.float64) for k in range(ORDER)]
        block = Block(_texts(row))
        model = Automaton(block, totals, row["n"], row["v"], concentration)
        score = model.walk(block.starts, block.sizes)
        each = lambda x: np.add.reduceat(x, block.starts)
        known, base = each((totals[0][block.ids[0]] > 0).astype(np.int64)), each(model.weight[block.ids[0]])
        return pa.table({"doc_id": row["doc_id"], "held_out": row["held_out"], "n_tokens": block.sizes, "n_known": known, "train_tokens": [row["n"]] * len(score), "base_score": base, "score": score, "token_score": score / block.sizes}, schema=schema)

    return work


def score_texts(docs: DataFrame, held_out, concentration=CONCENTRATION) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and token_score (score by token) of every document.

    held_out: a Column over doc_id and text; where it is true the model learns nothing.
    """
    texts = texts_of(docs).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 + chars // BLOCK_CHARS
    blocks = texts.mapInArrow(_pack, PACKED).repartition(n, "block")
    sent = blocks.mapInArrow(_send(buckets), SENT)
    answers = sent.groupBy("bucket").applyInArrow(_add, ANSWERED)
    sums = sent.groupBy("bucket").applyInArrow(_words, "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))  # one row
    whole = blocks.join(F.broadcast(sums))
    return whole.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(concentration), SCORED)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10
    return score_texts(table(spark, sf_dir, "documents"), fold == 0)
