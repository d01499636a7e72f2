"""Toxicity by a counterfactual-regularised classifier.

A text is the set of its words (lower case, no ASCII punctuation) and of their beginnings of 4 to 6 bytes, which carry
over to inflected forms. Features are chosen by chi-square on a bounded sample of labelled rows; those of identity terms
always take part. A logistic regression is fitted on the rows. In each sentence of the sample that names a group, the
group's term is swapped for each other term of its list, and into neutral sentences (of rows without label 1, naming no
group) each term is put in; the mean squared change of the score, not of the logit, under all swaps and under all
mentions is part of the loss, so that naming a group moves no score by itself. Spark counts equal sentences, and each weighs
what it was counted. All neutral ones take part: the most frequent in every step of the fit, the others in turn.

The sample is bounded in rows and in characters, so what the driver gets has a bound whatever the length of texts.

Defined results: null and empty texts get the score of the intercept; a document with several labels is toxic if one
says so; rows without a label, and those longer than LONGEST, are scored and not learned from; with no labels at all, or labels of one kind only, the
score is the share of label 1 (0.5 if there are none); ties of the sample's hash go by doc_id; repeated rows are scored
alike and learned from once; an empty table gives an empty result; further columns are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import map_texts, shared, slices, table, texts_of

#: Bound of the sample: so many labelled rows, the first by a hash of doc_id, of so many characters at most, and in all so many.
SAMPLE_ROWS = 15_000
LONGEST = 1_000_000
SAMPLE_CHARS = 50_000_000
#: Distinct neutral sentences that take part in each step of the fit, and of the others in one step of STEPS, or more if there are more.
COMMON, DEALT = 1000, 2000
STEPS = 250
FEATURES = 4096
LEAST_ROWS = 5
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
#: Weight of the penalty beside the loss.
FAIRNESS = 20.0
#: Terms that name groups of people, in lists whose members stand for one another.
IDENTITY = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("she", "he"), ("her", "his"), ("mother", "father"),
    ("black", "white", "asian", "latino"), ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"), ("immigrant", "native", "refugee"), ("immigrants", "natives", "refugees"), ("old", "young"), ("disabled", "deaf", "blind"),
)
_SWAPS = {t.encode(): [u.encode() for u in group if u != t] for group in IDENTITY for t in group}
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_SENTENCE = re.compile(rb"[.!?\n]+")


def words_of(text: str | bytes) -> set[bytes]:
    return set((text if isinstance(text, bytes) else text.encode()).translate(_CLEAN).split())


def features_of_words(words: set[bytes]) -> set[bytes]:
    return words.union(*({w[:n] + b"*" for w in words if len(w) >= n} for n in PREFIXES))


#: Features of the identity terms.
TERM_FEATURES = sorted(features_of_words(set(_SWAPS)))


@dataclass
class ToxicityModel:
    weights: dict[bytes, float]
    intercept: float

    def logit(self, words: set[bytes]) -> float:
        get, found = self.weights.get, set()
        for w in words:
            if w in self.weights:
                found.add(w)
            for n in PREFIXES:
                if len(w) >= n and (p := w[:n] + b"*") in self.weights:
                    found.add(p)
        return self.intercept + sum(map(get, sorted(found)))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(words_of(text)), -500, 500))))


def sentences(text: str) -> list[set[bytes]]:
    """The words of each sentence that has any."""
    return [w for part in _SENTENCE.split(text.encode()) if (w := words_of(part))]


def counterfactuals(words: set[bytes]) -> list[set[bytes]]:
    """A sentence's words with each identity term swapped for each other one of its list."""
    return [(words - {t}) | {u} for t in sorted(words & _SWAPS.keys()) for u in _SWAPS[t]]


class Pairs:
    """Sentences (lists of feature numbers) and their changes: (sentence, features that come, features that go, weight)."""

    def __init__(self, rows: list[list[int]], changes: list[tuple[int, list[int], list[int], float]]):
        self.n = len(rows)
        self.at, self.cols = _flat(rows)
        self.of = np.array([c[0] for c in changes], np.int64)
        self.swap_at, self.swap_cols = _flat([[*c[1], *c[2]] for c in changes])
        self.signs = np.array([s for c in changes for s in [1.0] * len(c[1]) + [-1.0] * len(c[2])])
        self.weight = np.array([c[3] for c in changes], float)

    def penalty(self, w: np.ndarray, b: float, step: int = 0) -> tuple[float, np.ndarray, float]:
        """Weighted sum of squared changes of the score, and its gradient by w and b."""
        if not len(self.of):
            return 0.0, np.zeros_like(w), 0.0
        z = np.bincount(self.at, w[self.cols], self.n) + b
        y = z[self.of] + np.bincount(self.swap_at, self.signs * w[self.swap_cols], len(self.of))
        p, q = _sigmoid(z[self.of]), _sigmoid(y)
        change = q - p
        dq, dp = 2 * self.weight * change * q * (1 - q), -2 * self.weight * change * p * (1 - p)
        both = np.bincount(self.of, dq + dp, self.n)
        g = np.bincount(self.cols, both[self.at], len(w)) + np.bincount(self.swap_cols, self.signs * dq[self.swap_at], len(w))
        return float((self.weight * change**2).sum()), g, float(both.sum())


class Mentions:
    """Neutral sentences, counted, and what putting each mention (a list of feature numbers) into each of them changes.

    The weights of all sentences and mentions sum to 0.5. The common sentences count at every step, the others at every
    k-th, k-fold, so that the sum over k steps is that of all.
    """

    def __init__(self, rows: list[list[int]], counts: list[int], mentions: list[list[int]], common: int = COMMON, dealt: int = DEALT, steps: int = STEPS):
        sizes = np.array([len(x) for x in rows], np.int64)
        self.cols = np.concatenate([np.asarray(x, np.int32) for x in rows] or [np.zeros(0, np.int32)])
        self.sizes, self.begin = sizes, np.cumsum(sizes) - sizes
        self.weight = np.asarray(counts, float) * 0.5 / max(1, sum(counts) * len(mentions))
        self.mentions = mentions
        self.m_at, self.m_cols = _flat(mentions)
        order = np.argsort(-self.weight, kind="stable")
        self.common, rest = order[:common], np.random.default_rng(4).permutation(order[common:])
        size = max(dealt, -(-len(rest) // steps))
        self.parts = [rest[i : i + size] for i in range(0, len(rest), size)]

    def penalty(self, w: np.ndarray, b: float, step: int = 0) -> tuple[float, np.ndarray, float]:
        """As that of Pairs, of the sentences of this step."""
        part = self.parts[step % len(self.parts)] if self.parts else self.common[:0]
        some, many = np.concatenate([self.common, part]), len(self.mentions)
        if not len(some) or not many:
            return 0.0, np.zeros_like(w), 0.0
        weight = np.concatenate([self.weight[self.common], self.weight[part] * len(self.parts)])[:, None]
        sizes = self.sizes[some]
        at = np.repeat(np.arange(len(some)), sizes)
        cols = self.cols[np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.begin[some], sizes)]
        z = np.bincount(at, w[cols], len(some)) + b
        y = z[:, None] + np.bincount(self.m_at, w[self.m_cols], many)[None, :]
        # What a sentence has already doesn't come with the mention.
        had, near = np.flatnonzero(np.isin(cols, self.m_cols)), np.argsort(self.m_cols, kind="stable")
        first, last = (np.searchsorted(self.m_cols[near], cols[had], side) for side in ("left", "right"))
        each = np.repeat(had, last - first)
        which = near[np.arange(len(each)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)]
        cell, own = at[each] * many + self.m_at[which], cols[each]
        y -= np.bincount(cell, w[own], y.size).reshape(y.shape)
        p, q = _sigmoid(z)[:, None], _sigmoid(y)
        change = q - p
        dq, dp = 2 * weight * change * q * (1 - q), -2 * weight * change * p * (1 - p)
        both = (dq + dp).sum(axis=1)
        g = np.bincount(cols, both[at], len(w)) + np.bincount(self.m_cols, dq.sum(axis=0)[self.m_at], len(w)) - np.bincount(own, dq.reshape(-1)[cell], len(w))
        return float((weight * change**2).sum()), g, float(both.sum())


class Penalties(list):
    """Several penalties as one."""

    def penalty(self, w: np.ndarray, b: float, step: int = 0) -> tuple[float, np.ndarray, float]:
        each = [x.penalty(w, b, step) for x in self]
        return sum(x[0] for x in each), sum((x[1] for x in each), np.zeros_like(w)), sum(x[2] for x in each)


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate([np.asarray(x, np.int64).reshape(-1) for x in lists] or [np.zeros(0, np.int64)])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_logistic(rows: list[list[int]], labels: np.ndarray, pairs: Pairs | Mentions | Penalties, n: int, l2: float = 2e-4, fairness: float = FAIRNESS, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept for rows of feature numbers; both labels weigh the same in all."""
    at, cols = _flat(rows)
    share = np.where(labels > 0, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    w, b, m, v = np.zeros(n), 0.0, np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1):
        err = (_sigmoid(np.bincount(at, w[cols], len(rows)) + b) - labels) * share
        g, gb = np.bincount(cols, err[at], n) + l2 * w, err.sum()
        if fairness:
            _, pg, pb = pairs.penalty(w, b, t)
            g, gb = g + fairness * pg, gb + fairness * pb
        g = np.append(g, gb)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def _bytes(lists: list[list[int]]) -> bytes:
    """Lists of numbers as one string: their number, their lengths, and all of them."""
    return np.array([len(lists), *map(len, lists), *(f for x in lists for f in x)], "<i4").tobytes()


def _lists(data: bytes) -> list[list[int]]:
    x = np.frombuffer(data, "<i4")
    sizes, values = x[1 : 1 + x[0]], x[1 + x[0] :].tolist() if len(x) else []
    ends = np.cumsum(sizes).tolist()
    return [values[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def fit(labelled: DataFrame, features: int = FEATURES, fairness: float = FAIRNESS) -> ToxicityModel:
    """A model from the sample's text, toxic. The driver gets the chosen features' names, the sample's rows of them, and its distinct sentences with their counts."""
    sample = shared(labelled.select("text", "toxic").repartition(int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def count(batches):
        for batch in batches:
            for start, _, texts in slices(batch):
                counts: dict[bytes, list[int]] = {}
                for i, text in enumerate(texts):
                    y = batch.column("toxic")[start + i].as_py()
                    for f in features_of_words(words_of(text)):
                        counts.setdefault(f, [0, 0])[y] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())], names=["f", "neg", "pos"])

    n_neg, n_pos = (sample.where(F.col("toxic") == y).count() for y in (0, 1))
    if not n_neg or not n_pos:
        share = 0.5 if n_neg == n_pos else float(n_pos > 0)
        return ToxicityModel({}, {0.0: -30.0, 0.5: 0.0, 1.0: 30.0}[share])
    sums = sample.mapInArrow(count, "f binary, neg long, pos long").groupBy("f").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).where(F.col("neg") + F.col("pos") >= LEAST_ROWS)
    chi = (F.col("pos") * n_neg - F.col("neg") * n_pos) ** 2 / ((F.col("pos") + F.col("neg")) * (n_neg + n_pos - F.col("pos") - F.col("neg") + 1))
    chosen = sorted({bytes(r["f"]) for r in sums.orderBy(chi.desc(), "f").limit(features).collect()} | set(TERM_FEATURES))
    number = {f: i for i, f in enumerate(chosen)}
    pick = lambda words: sorted(number[f] for f in features_of_words(words) if f in number)

    def choose(batches):
        """Rows of the documents."""
        for batch in batches:
            for start, _, texts in slices(batch):
                toxic = batch.column("toxic").slice(start, len(texts)).to_numpy().astype("i1").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([toxic]), pa.array([_bytes([pick(words_of(x)) for x in texts])])], names=["toxic", "rows"])

    def choose_sentences(batches):
        """Sentences that name a group, with what each swap makes of them, and neutral ones (plus and minus are null)."""
        code = lambda features: np.array(features, "<i4").tobytes()
        for batch in batches:
            for start, _, texts in slices(batch):
                counted: dict[tuple, int] = {}
                for text, y in zip(texts, batch.column("toxic").slice(start, len(texts)).to_pylist()):
                    for words in sentences(text):
                        if changed := counterfactuals(words):
                            have = pick(words)
                            keys = [(code(have), code(sorted(set(other) - set(have))), code(sorted(set(have) - set(other)))) for other in map(pick, changed)]
                        else:
                            keys = [] if y else [(code(pick(words)), None, None)]
                        for key in keys:
                            counted[key] = counted.get(key, 0) + 1
                have, plus, minus = zip(*counted) if counted else ((), (), ())
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.binary()) for x in (have, plus, minus)), pa.array(counted.values(), pa.int64())], names=["have", "plus", "minus", "n"])

    got = sample.mapInArrow(choose, "toxic binary, rows binary").collect()
    rows, labels = [x for r in got for x in _lists(r["rows"])], np.concatenate([np.frombuffer(r["toxic"], "i1") for r in got]).astype(float)
    counted = sample.mapInArrow(choose_sentences, "have binary, plus binary, minus binary, n long").groupBy("have", "plus", "minus").agg(F.sum("n").alias("n"))
    counted = counted.toArrow().sort_by([("have", "ascending"), ("plus", "ascending"), ("minus", "ascending")])
    numbers = lambda name, table: [np.frombuffer(x, "<i4").tolist() for x in table.column(name).to_pylist()]
    named, neutral = counted.filter(pc.is_valid(counted.column("plus"))), counted.filter(pc.is_null(counted.column("plus")))
    bases: dict[bytes, int] = {}
    of = [bases.setdefault(x, len(bases)) for x in named.column("have").to_pylist()]
    times, total = named.column("n").to_pylist(), sum(named.column("n").to_pylist())
    changes = [(i, plus, minus, 0.5 * c / total) for i, plus, minus, c in zip(of, numbers("plus", named), numbers("minus", named), times)]
    swaps = Pairs([np.frombuffer(x, "<i4").tolist() for x in bases], changes)
    mentions = Mentions([np.frombuffer(x, "<i4") for x in neutral.column("have").to_pylist()], neutral.column("n").to_pylist(), [pick({t}) for t in _SWAPS])
    w, b = fit_logistic(rows, labels, Penalties([swaps, mentions]), len(chosen), fairness=fairness)
    return ToxicityModel({f: float(w[i]) for f, i in number.items()}, float(b))


def labelled_sample(docs: DataFrame, labels: DataFrame, held_out, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS, longest: int = LONGEST) -> DataFrame:
    """text, toxic of the labelled rows that are not held out: the first by a hash of doc_id, within the three bounds. Equal rows are one."""
    y = labels.where("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = y.where(~F.coalesce(held_out, F.lit(True))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    short = texts_of(docs).where(F.length("text") <= longest).join(F.broadcast(chosen), "doc_id").distinct()  # sample_rows rows at most
    rows = shared(short.withColumn("mark", F.xxhash64("text")))
    first = rows.select(F.xxhash64("doc_id").alias("place"), "doc_id", "mark", F.length("text").alias("chars")).orderBy("place", "doc_id", "mark").limit(sample_rows)
    within = F.sum("chars").over(Window.orderBy("place", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, 0))  # of sample_rows rows at most
    kept = first.withColumn("total", within).where(F.col("total") <= sample_chars).select("doc_id", "mark")
    return rows.join(F.broadcast(kept), ["doc_id", "mark"], "left_semi").select("text", "toxic")


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out, sample_rows: int = SAMPLE_ROWS, fairness: float = FAIRNESS) -> DataFrame:
    """doc_id, score of every document, learned from labels (doc_id, toxic) where held_out (a Column over doc_id) is false."""
    model = fit(labelled_sample(docs, labels, held_out, sample_rows), fairness=fairness)
    return map_texts(docs, lambda texts: [[model.score(t) for t in texts]], "score double")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
