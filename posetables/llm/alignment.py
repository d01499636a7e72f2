"""Alignment of the tokens of two tokenizers, in Arrow.

Both token lists of a batch of texts are flattened, with the indices of their parents; a segmented cumulative sum over the
tokens' byte lengths gives where each ends in its document. A hash join of both sides on (document, end) finds the places at which
both end, which cut the document into groups. Tokens of one group are linked; groups of several tokens are counted by
token first, so that a run of equal tokens is one row on each side of the join.

A first pass keeps, for each document, its distinct pairs of linked ids and how often each occurs. Batches count with
Table.group_by in how many documents a pair is, and Spark adds these partial counts up. Pairs of many documents, of which
there are at most HOT_PAIRS by choice of the least count, are looked up in a broadcast table; all others meet their counts
in a join, in which no pair has many rows because it is in few documents.

Defined results: texts that are null, empty, or that a tokenizer doesn't give back byte for byte have no tokens: zeros and an
empty groups_sha256; special tokens' strings in a text are plain text; each row of a table is a document of its own, whatever its doc_id;
texts of any length are aligned whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe import load_encoding
from .common import sha256_hex, shared_folder, slices, table, texts_of

PIECES_FILE = "piece_bpe_32k.model"
#: Pairs in the broadcast table; a row has 13 bytes.
HOT_PAIRS = 1_000_000
#: Characters that are aligned at once.
SLICE_CHARS = 400_000
#: Rows of partial counts that a task holds before it hands them on.
HELD_COUNTS = 1_000_000


class Tokenizers:
    """Both tokenizers and, as Arrow arrays, their tokens' bytes, lengths, and decimal ids with what follows them."""

    def __init__(self, ranks: str | None = None, pieces: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.a = load_encoding(ranks)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces or public_tokenizers.path(PIECES_FILE))
        n_a, n_b = self.a.n_vocab, self.b.get_piece_size()
        of_rank = {i: t for t, i in self.a._mergeable_ranks.items()} | {i: t.encode() for t, i in self.a._special_tokens.items()}
        bytes_b = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(n_b)]
        self.bytes_a, self.bytes_b = pa.array([of_rank.get(i, b"") for i in range(n_a)], pa.binary()), pa.array(bytes_b, pa.binary())
        self.n_a, self.n_b = n_a, n_b
        self.written = pa.array([f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, [",", ";", ""])) for end in ends for i in range(n)])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [np.array(self.a.encode_ordinary(" " + t) if t else [], np.int32) for t in texts]
        b = self.b.encode(texts, out_type=int, num_threads=1)
        return a, [np.array(x if t else [], np.int32) for x, t in zip(b, texts)]


def _lists(ids: list[np.ndarray], keep: np.ndarray) -> pa.ListArray:
    """Ids of the texts that keep names, and empty lists for the others."""
    kept = [x if k else x[:0] for x, k in zip(ids, keep)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in kept])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int32)))


def _joined(ids: list[np.ndarray], token_bytes: pa.Array) -> pa.Array:
    """The bytes of each text's tokens."""
    lists = _lists(ids, np.ones(len(ids), bool))
    tokens = pc.take(token_bytes, lists.values)
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, tokens), pa.scalar(b"", pa.binary()))


def token_ends(lists: pa.ListArray, token_bytes: pa.Array) -> pa.Table:
    """document, end (bytes into the document) and place (in the flattened list) of every token."""
    ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    running = pc.cumulative_sum(pc.cast(pc.binary_length(pc.take(token_bytes, ids)), pa.int64()))
    before = np.concatenate([[0], running.to_numpy()])[lists.offsets.to_numpy()[:-1]]  # bytes before each document's first token
    ends = pc.subtract(running, pc.take(pa.array(before, pa.int64()), parents))
    return pa.table({"document": pc.cast(parents, pa.int64()), "end": ends, "place": pa.array(np.arange(len(ids)), pa.int64())})


def _counted(groups: np.ndarray, ids: np.ndarray, name: str) -> pa.Table:
    """How often an id comes in a group."""
    return pa.table({"group": groups, name: ids}).group_by(["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", name, f"times_{name}"])


class Aligned:
    """Groups and links of a slice of texts."""

    def __init__(self, tokenizers: Tokenizers, texts: list[str]):
        t = tokenizers
        ids_a, ids_b = t.encode(texts)
        whole = pa.array([(" " + x).encode() for x in texts], pa.binary())
        keep = np.array([bool(x) for x in texts], bool)
        for ids, token_bytes in ((ids_a, t.bytes_a), (ids_b, t.bytes_b)):
            keep &= pc.equal(_joined(ids, token_bytes), whole).to_numpy(zero_copy_only=False)
        a, b = _lists(ids_a, keep), _lists(ids_b, keep)
        self.n_documents, self.offsets_a, self.offsets_b = len(texts), a.offsets.to_numpy(), b.offsets.to_numpy()
        self.n_a, self.n_b = np.diff(self.offsets_a), np.diff(self.offsets_b)
        both = token_ends(a, t.bytes_a).join(token_ends(b, t.bytes_b), ["document", "end"], join_type="inner", right_suffix="_b", use_threads=False)
        self.last_a, self.last_b = np.sort(both["place"].to_numpy()), np.sort(both["place_b"].to_numpy())  # last tokens of each group
        self.group_document = np.searchsorted(self.offsets_a[1:], self.last_a, side="right")
        self.n_groups = np.bincount(self.group_document, minlength=self.n_documents)
        first = lambda last: np.concatenate([[0], last[:-1] + 1]) if len(last) else last
        self.size_a, self.size_b = self.last_a - first(self.last_a) + 1, self.last_b - first(self.last_b) + 1
        self.n_links = np.bincount(self.group_document, self.size_a * self.size_b, self.n_documents).astype(np.int64)
        self.a, self.b, self.tokenizers = a.values.to_numpy(), b.values.to_numpy(), t

    def pairs(self) -> pa.Table:
        """document, pair, times: each linked pair of ids of a document, by document and pair."""
        n_b, groups = self.tokenizers.n_b, np.arange(len(self.last_a))
        single = (self.size_a == 1) & (self.size_b == 1)
        code = lambda a, b: a.astype(np.int64) * n_b + b
        parts = [pa.table({"document": self.group_document[single], "pair": code(self.a[self.last_a[single]], self.b[self.last_b[single]]), "times": np.ones(int(single.sum()), np.int64)})]
        if not single.all():
            of_a, of_b = np.repeat(groups, self.size_a), np.repeat(groups, self.size_b)
            more_a, more_b = ~single[of_a], ~single[of_b]
            links = _counted(of_a[more_a], self.a[more_a], "a").join(_counted(of_b[more_b], self.b[more_b], "b"), "group", join_type="inner", use_threads=False)
            times = pc.multiply(links["times_a"], links["times_b"])
            parts.append(pa.table({"document": self.group_document[links["group"].to_numpy()], "pair": code(links["a"].to_numpy(), links["b"].to_numpy()), "times": times}))
        made = pa.concat_tables(parts).group_by(["document", "pair"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["document", "pair", "times"])
        return made.sort_by([("document", "ascending"), ("pair", "ascending")])

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups as text; nothing for documents without tokens."""
        n_a, n_b = self.tokenizers.n_a, self.tokenizers.n_b
        groups = np.arange(len(self.last_a))
        of_a, of_b = np.repeat(groups, self.size_a), np.repeat(groups, self.size_b)
        written = np.empty(len(self.a) + len(self.b), np.int64)
        end_a, end_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        end_a[self.last_a] = 1
        end_b[self.last_b] = 1
        end_b[self.offsets_b[1:][self.n_b > 0] - 1] = 2
        b_before, a_so_far = np.concatenate([[0], self.last_b + 1]), self.last_a + 1
        written[np.arange(len(self.a)) + b_before[of_a]] = self.a + n_a * end_a
        written[np.arange(len(self.b)) + a_so_far[of_b]] = self.b + n_b * end_b + 2 * n_a
        lists = pa.ListArray.from_arrays(pa.array(self.offsets_a + self.offsets_b, pa.int32()), pc.take(self.tokenizers.written, pa.array(written)))
        return [sha256_hex(x.as_buffer()) if n else "" for x, n in zip(pc.binary_join(lists, ""), self.n_a)]


_worker: dict = {}


def _tokenizers(ranks: str | None, pieces: str | None) -> Tokenizers:
    if (ranks, pieces) not in _worker:
        _worker[ranks, pieces] = Tokenizers(ranks, pieces)
    return _worker[ranks, pieces]


DIGEST = ["n_a", "n_b", "n_groups", "n_links"]


def align_documents(docs: DataFrame, ranks: str | None = None, pieces: str | None = None, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """row (unique), doc_id, counts and digest of each document, with its pairs and how often each is linked."""

    def work(batches):
        from pyspark import TaskContext

        t, row = _tokenizers(ranks, pieces), TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, end, texts in slices(batch, limit=slice_chars):
                x = Aligned(t, texts)
                pairs = x.pairs()
                n = np.bincount(pairs["document"].to_numpy(), minlength=len(texts))
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                listed = [pa.ListArray.from_arrays(offsets, pairs[c].combine_chunks().cast(kind)) for c, kind in (("pair", pa.int64()), ("times", pa.int32()))]
                rows = pa.array(np.arange(row, row + len(texts)), pa.int64())
                row += len(texts)
                counts = [pa.array(getattr(x, c), pa.int64()) for c in DIGEST]
                yield pa.RecordBatch.from_arrays([rows, batch.column("doc_id").slice(start, end - start), *counts, pa.array(x.digests(), pa.string()), *listed], names=["row", "doc_id", *DIGEST, "groups_sha256", "pairs", "times"])

    return texts_of(docs).mapInArrow(work, f"row long, doc_id long, {', '.join(f'{c} long' for c in DIGEST)}, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """pair, n (documents that hold it), best (no pair of its first id is in more documents)."""

    def partial(batches):
        held = None
        for batch in batches:
            flat = pa.table({"pair": pc.list_flatten(batch.column("pairs"))})
            found = flat.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
            if held is not None:
                found = pa.concat_tables([held, found]).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])
            held = found
            if held.num_rows > HELD_COUNTS:
                yield from held.combine_chunks().to_batches()
                held = None
        if held is not None:
            yield from held.combine_chunks().to_batches()

    counts = aligned.select("pairs").mapInArrow(partial, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    first_id = F.expr(f"pair div {n_b}")
    most = counts.groupBy(first_id.alias("first_id")).agg(F.max("n").alias("most"))
    return counts.withColumn("first_id", first_id).join(most, "first_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _least_hot(counts: DataFrame, most: int) -> int:
    """The least power of two such that no more than `most` pairs are in as many documents; 64 rows at most come to the driver."""
    sizes = dict(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count("*").alias("pairs")).collect())
    total, least = 0, max(sizes, default=0) + 1
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > most:
            break
        least = k
    return 1 << least


def score_links(aligned: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """n_best and count_sum of each aligned document. Both tables are read again and again, so they should be written ones."""
    spark = aligned.sparkSession
    least = _least_hot(counts, hot_pairs)
    hot = counts.where(F.col("n") >= least).toPandas().sort_values("pair")
    shipped = spark.sparkContext.broadcast((hot["pair"].to_numpy(np.int64), hot["n"].to_numpy(np.int64), hot["best"].to_numpy(bool)))

    def look_up(batches):
        codes, n, best = shipped.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").values.to_numpy().astype(np.int64)
            offsets, values = pairs.offsets.to_numpy(), pairs.values.to_numpy()
            place = np.minimum(np.searchsorted(codes, values), max(len(codes) - 1, 0))
            known = codes[place] == values if len(codes) else np.zeros(len(values), bool)
            add = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
            found = [add(np.where(known, x[place] * times, 0) if len(codes) else np.zeros(len(values), np.int64)) for x in (best, n)]
            rare = add(~known)
            rare_offsets = pa.array(np.concatenate([[0], np.cumsum(rare)]), pa.int32())
            lists = [pa.ListArray.from_arrays(rare_offsets, pa.array(x[~known], pa.int64())) for x in (values, times)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(x, pa.int64()) for x in found), *lists], names=[*kept, "n_best", "count_sum", "rare", "rare_times"])

    kept = ["row", "doc_id", *DIGEST, "groups_sha256"]
    plain = "row long, doc_id long, " + "".join(f"{c} long, " for c in DIGEST) + "groups_sha256 string"
    found = aligned.mapInArrow(look_up, f"{plain}, n_best long, count_sum long, rare array<long>, rare_times array<long>")
    result = ["doc_id", *DIGEST, "n_best", "count_sum", "groups_sha256"]
    if least <= 1:  # no pair is missing from the table
        return found.select(*result)
    rare = found.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("x")).select("row", F.col("x.rare").alias("pair"), F.col("x.rare_times").alias("times"))
    more = rare.join(counts.where(F.col("n") < least), "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    plus = lambda c, d: (F.col(c) + F.coalesce(d, F.lit(0))).alias(c)
    return found.join(more, "row", "left").select("doc_id", *DIGEST, plus("n_best", "more_best"), plus("count_sum", "more_sum"), "groups_sha256")


def align(docs: DataFrame, ranks: str | None = None, pieces: str | None = None, hot_pairs: int = HOT_PAIRS, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """Counts, digest, best links and summed pair counts of each document. What both passes share is written to the shared folder."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/alignment-{uuid.uuid4().hex}"
    align_documents(docs, ranks, pieces, slice_chars).write.option("compression", "zstd").parquet(f"{folder}/aligned")
    aligned = spark.read.parquet(f"{folder}/aligned")
    pair_counts(aligned, _tokenizers(ranks, pieces).n_b).write.option("compression", "zstd").parquet(f"{folder}/counts")
    return score_links(aligned, spark.read.parquet(f"{folder}/counts"), hot_pairs)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
