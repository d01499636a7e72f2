"""Personal data by patterns and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans. The network, written in numpy, is trained on a bounded sample of the corpus's
windows, labelled with base spans, and on such windows into which labelled spans that no pattern finds are written: phone
numbers without a plus sign, mail addresses with (at) and dot or without a domain's dot, cards with other separators, IPv6
and defanged addresses, and, as windows to leave alone, dates, times, versions, amounts and order numbers. It reads windows
of WIDTH characters, STRIDE apart, of every text: those that hold a digit, an @ or a spelled-out one, because each kind
needs one. Each window is decoded by Viterbi, with the spans' CRF marginals as their confidence; spans cut off by a
window's edge are left to the window in which they are whole, and over the whole text the set of non-overlapping spans
with the largest total confidence is chosen (weighted interval scheduling). Spans that touch no base span are added.

Defined results: null and empty texts have no spans; without a window to learn from nothing is trained and base spans
stand alone; repeated rows give repeated results; equal confidences go by place and kind; an empty table gives an empty
result; other columns are ignored. Texts of any length are scanned whole; the network finds spans of up to WIDTH - STRIDE
characters wherever they stand, longer ones can come from the patterns only.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_texts, sha256_hex, shared, slices, spans_text, table, texts_of

KINDS = ["email", "ip", "card", "phone"]
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]|[\[({](?:at|AT)[\])}]|\x20at\x20")
_DIGIT = re.compile("[0-9]")
WIDTH, STRIDE = 64, 16
TAGS = 1 + 2 * len(KINDS)  # O, then begin and inside of each kind
#: Bound of the training sample: so many windows with a span and so many without, the first by a hash.
SAMPLE_WINDOWS = 2000
CONFIDENCE = 0.9


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans: list[tuple[str, int, int]] = []
    if "@" in text:
        spans += [("email", m.start(), m.end()) for m in _EMAIL.finditer(text)]
    if _DIGIT.search(text):
        spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 40 and 12 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d):
                spans.append(("card", m.start(), m.end()))
        if "+" in text:
            spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return spans


def char_ids(text: str) -> np.ndarray:
    """0 pads; ASCII has a number each, other letters one, other characters another."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64) + 1
    return np.where(c <= 128, c, np.where(c < 0x250, 129, 130))


def windows_of(text: str) -> list[int]:
    """Starts of the windows that hold a hint."""
    starts: set[int] = set()
    for m in _HINT.finditer(text):
        k = m.start() // STRIDE
        starts.update(range(max(0, k + 1 - WIDTH // STRIDE), k + 1))
    return [STRIDE * k for k in sorted(starts)]


def window_matrix(ids: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.concatenate([ids, np.zeros(WIDTH, np.int64)])
    return padded[np.asarray(starts)[:, None] + np.arange(WIDTH)[None, :]]


def tags_of(spans: list[tuple[str, int, int]], length: int) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if not tags[a:b].any():
            k = KINDS.index(kind)
            tags[a], tags[a + 1 : b] = 1 + 2 * k, 2 + 2 * k
    return tags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class BiLstmCrf:
    """Character embedding, an LSTM each way, a linear layer, and CRF transitions; float32 numpy."""

    def __init__(self, chars: int = 131, dim: int = 12, hidden: int = 16, tags: int = TAGS, seed: int = 7):
        r = np.random.default_rng(seed)
        init = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.h = hidden
        self.p = {"E": init(chars, dim), "W": init(2 * hidden, tags), "c": np.zeros(tags, np.float32), "T": np.zeros((tags, tags), np.float32)}
        for d in "fb":
            self.p |= {f"X{d}": init(dim, 4 * hidden), f"H{d}": init(hidden, 4 * hidden), f"b{d}": np.zeros(4 * hidden, np.float32)}
            self.p[f"b{d}"][hidden : 2 * hidden] = 1

    def _run(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        n, length, _ = x.shape
        h = c = np.zeros((n, self.h), np.float32)
        out = np.empty((n, length, self.h), np.float32)
        pre = x @ self.p[f"X{d}"] + self.p[f"b{d}"]
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            z = pre[:, t] + h @ self.p[f"H{d}"]
            gates = _sigmoid(z[:, : 3 * self.h])
            i, f, o = gates[:, : self.h], gates[:, self.h : 2 * self.h], gates[:, 2 * self.h :]
            g = np.tanh(z[:, 3 * self.h :])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep is not None:
                keep.append((t, h, before, i, f, o, g, tc))
            h = o * tc
            out[:, t] = h
        return out

    def emissions(self, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        x = self.p["E"][ids]
        logs = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        hidden = np.concatenate([self._run(x, "f", logs["f"]), self._run(x, "b", logs["b"])], axis=2)
        if keep is not None:
            keep |= {"x": x, "logs": logs, "hidden": hidden}
        return hidden @ self.p["W"] + self.p["c"]

    def _alpha_beta(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        T, length = self.p["T"], e.shape[1]
        a, b = np.empty_like(e), np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for t in range(1, length):
            a[:, t] = e[:, t] + _logsumexp(a[:, t - 1][:, :, None] + T[None], 1)
        for t in range(length - 2, -1, -1):
            b[:, t] = _logsumexp(T[None] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
        return a, b, _logsumexp(a[:, -1], 1)

    def marginals(self, e: np.ndarray) -> np.ndarray:
        a, b, z = self._alpha_beta(e)
        return np.exp(a + b - z[:, None, None])

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        n, length, _ = e.shape
        best, back = e[:, 0], np.empty(e.shape, np.int8)
        for t in range(1, length):
            s = best[:, :, None] + self.p["T"][None]
            back[:, t] = s.argmax(1)
            best = e[:, t] + s.max(1)
        path = np.empty((n, length), np.int64)
        path[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        return path

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of a window, and its gradients."""
        n, length = ids.shape
        kept: dict = {}
        e = self.emissions(ids, kept)
        a, b, z = self._alpha_beta(e)
        rows = np.arange(n)
        gold = e[rows[:, None], np.arange(length)[None], tags].sum(1) + self.p["T"][tags[:, :-1], tags[:, 1:]].sum(1)
        de = np.exp(a + b - z[:, None, None])
        de[rows[:, None], np.arange(length)[None], tags] -= 1
        de /= n
        dT = np.zeros_like(self.p["T"])
        for t in range(1, length):
            dT += np.exp(a[:, t - 1][:, :, None] + self.p["T"][None] + (e[:, t] + b[:, t])[:, None, :] - z[:, None, None]).sum(0)
        np.subtract.at(dT, (tags[:, :-1].reshape(-1), tags[:, 1:].reshape(-1)), 1)
        g = {"T": dT / n, "W": np.einsum("ntk,ntj->kj", kept["hidden"], de), "c": de.sum((0, 1))}
        dh_all = de @ self.p["W"].T
        dx = np.zeros_like(kept["x"])
        for d, part in (("f", dh_all[:, :, : self.h]), ("b", dh_all[:, :, self.h :])):
            gX, gH, gb = (np.zeros_like(self.p[k + d]) for k in "XHb")
            dh = dc = np.zeros((n, self.h), np.float32)
            for t, before_h, before_c, i, f, o, gg, tc in reversed(kept["logs"][d]):
                dh = dh + part[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - gg * gg)], axis=1)
                gX += kept["x"][:, t].T @ dz
                gH += before_h.T @ dz
                gb += dz.sum(0)
                dx[:, t] += dz @ self.p[f"X{d}"].T
                dh, dc = dz @ self.p[f"H{d}"].T, dc * f
            g |= {f"X{d}": gX, f"H{d}": gH, f"b{d}": gb}
        g["E"] = np.zeros_like(self.p["E"])
        np.add.at(g["E"], ids, dx)
        return float((z - gold).mean()), g

    def train(self, ids: np.ndarray, tags: np.ndarray, epochs: int = 10, batch: int = 128, rate: float = 0.02, seed: int = 3) -> list[float]:
        """Adam; the mean loss of each epoch."""
        r, losses, step = np.random.default_rng(seed), [], 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for epoch in range(epochs):
            total, order = 0.0, r.permutation(len(ids))
            for a in range(0, len(ids), batch):
                some = order[a : a + batch]
                loss, g = self.gradients(ids[some], tags[some])
                total += loss * len(some)
                step += 1
                scale = min(1.0, 5.0 / (1e-9 + float(np.sqrt(sum((x * x).sum() for x in g.values())))))
                for k, x in g.items():
                    x = x * scale
                    m[k], v[k] = 0.9 * m[k] + 0.1 * x, 0.999 * v[k] + 0.001 * x * x
                    self.p[k] = (self.p[k] - rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(total / max(1, len(ids)))
        return losses


def training_windows(docs: DataFrame, most: int = SAMPLE_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their tags: at most `most` with a span and `most` without, of all documents the first by a hash."""

    def work(batches):
        for batch in batches:
            for _, _, texts in slices(batch):
                out_i, out_t = [], []
                for text in texts:
                    if starts := windows_of(text):
                        ids, tags = char_ids(text), tags_of(base_spans(text), len(text))
                        for i, t in zip(window_matrix(ids, starts), window_matrix(tags, starts)):
                            # a span that begins before the window is not to be learned from its middle
                            if t[0] == 0 or t[0] % 2 == 1:
                                out_i.append(i.astype(np.uint8).tobytes())
                                out_t.append(t.astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out_i, pa.binary()), pa.array(out_t, pa.binary()), pa.array([any(t) for t in out_t], pa.bool_())], names=["ids", "tags", "has"])

    n = docs.count()
    part = min(1.0, 40 * most / max(1, n))  # documents, chosen by their texts' hash, so that windows come from many and are few
    low = min(2**63 - 1, -(2**63) + int(part * 2**64))
    some = texts_of(docs).where(F.xxhash64("text") <= F.lit(low))
    found, h, rows = shared(some.mapInArrow(work, "ids binary, tags binary, has boolean").distinct()), F.xxhash64("ids"), []
    counts = {r["has"]: r["n"] for r in found.groupBy("has").agg(F.count("*").alias("n")).collect()}  # two rows
    for has, n in sorted(counts.items(), reverse=True):
        some = found.where(F.col("has") == has)
        if n > 4 * most:  # the lowest hashes, about 4 * most rows, so that tasks send few rows each however many tasks there are
            some = some.where(h < -(2**63) + 2**64 * 4 * most // n)
        rows += some.orderBy(h, "ids").limit(most).collect()
    both = [np.frombuffer(b"".join(bytes(r[k]) for r in rows), np.uint8).reshape(-1, WIDTH).astype(np.int64) for k in ("ids", "tags")]
    return both[0], both[1]


_NAMES = "anna ben carla david emma felix grace hugo iris jonas kate leo mia noah olga paul rosa sam tara uwe vera will yara zoe smith jones miller garcia chen novak rossi meyer silva kim".split()
_HOSTS = "example mail post company university web office home server local host net shop news".split()
_TOPS = "com org net de io edu fr uk".split()


def _with_luhn(r: np.random.Generator, n: int) -> str:
    body = "".join(map(str, r.integers(0, 10, n - 1)))
    return body + next(c for c in "0123456789" if luhn(body + c))


def variant(kind: str, r: np.random.Generator) -> str:
    """A made-up span of a kind in a spelling that no pattern finds."""
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    d = lambda n: "".join(map(str, r.integers(0, 10, n)))
    if kind == "email":
        sign = pick(["(at)", " (at) ", "[at]", " [at] ", " at ", "{at}", "@"])
        name = pick([pick(_NAMES), f"{pick(_NAMES)}.{pick(_NAMES)}", f"{pick(_NAMES)}{d(2)}", f"{pick(_NAMES)}_{pick(_NAMES)}"])
        if sign == "@":
            return f"{name}@{pick(_HOSTS)}"
        dot = pick([".", " dot ", "(dot)", " [dot] "]) if sign != " at " else " dot "
        return f"{name.replace('.', dot) if r.random() < 0.5 else name}{sign}{pick(_HOSTS)}{dot}{pick(_TOPS)}"
    if kind == "ip":
        if r.random() < 0.5:
            return ":".join(f"{int(r.integers(0, 65536)):x}" for _ in range(int(r.integers(4, 9))))
        dot = pick(["[.]", "(.)", "[dot]"])
        return dot.join(str(int(r.integers(0, 256))) for _ in range(4))
    if kind == "card":
        x, sign = _with_luhn(r, 16), pick([".", "/", "_", " - ", "  "])
        return sign.join(x[i : i + 4] for i in range(0, 16, 4))
    return pick([f"{d(3)}-{d(3)}-{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"({d(3)}) {d(3)} {d(4)}", f"00{d(2)} {d(3)} {d(7)}", f"0{d(3)}/{d(7)}", f"0{d(2)} {d(4)} {d(4)}"])


def decoy(r: np.random.Generator) -> str:
    """Digits or signs that are no personal data."""
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    d = lambda n: "".join(map(str, r.integers(0, 10, n)))
    return pick([
        f"20{d(2)}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.20{d(2)}", f"{d(2)}/{d(2)}/19{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"{d(2)}:{d(2)}", f"{d(1)}.{d(1)}.{d(2)}", f"v{d(1)}.{d(2)}", f"{d(1)},{d(3)},{d(3)}", f"${d(3)}.{d(2)}", f"order {d(9)}",
        f"#{d(8)}", f"ISBN 978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", d(4), d(6), d(11), f"{d(3)}-{d(3)}", f"pages {d(3)}-{d(3)}", f"@{pick(_NAMES)}", "met at noon", "look at the dot com", f"{d(2)} x {d(2)} x {d(2)}", f"id {d(3)}-{d(2)}",
    ])


def augmented(ids: np.ndarray, tags: np.ndarray, seed: int = 5, rounds: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The windows with variants (labelled) and decoys (not) written over a stretch of theirs that has no label."""
    r = np.random.default_rng(seed)
    out_i, out_t = [ids], [tags]
    for _ in range(rounds):
        new_i, new_t = ids.copy(), tags.copy()
        for i, t in zip(new_i, new_t):
            is_decoy = r.random() < 0.35
            kind = KINDS[int(r.integers(len(KINDS)))]
            span = decoy(r) if is_decoy else variant(kind, r)
            left, right = ("" if r.random() < 0.1 else " "), (" " if r.random() < 0.7 else ". ")
            whole = left + span + right
            length = int((i > 0).sum())
            if len(whole) >= min(WIDTH, max(length, 1)) or t.any():
                continue
            at = int(r.integers(0, min(WIDTH, length) - len(whole) + 1))
            i[at : at + len(whole)] = char_ids(whole)
            if not is_decoy:
                a, k = at + len(left), KINDS.index(kind)
                t[a], t[a + 1 : a + len(span)] = 1 + 2 * k, 2 + 2 * k
        out_i.append(new_i)
        out_t.append(new_t)
    return np.concatenate(out_i), np.concatenate(out_t)


def fit(docs: DataFrame, most: int = SAMPLE_WINDOWS, epochs: int = 10) -> BiLstmCrf | None:
    ids, tags = training_windows(docs, most)
    if not len(ids):
        return None
    model = BiLstmCrf()
    model.train(*augmented(ids, tags), epochs)
    return model


def best_intervals(spans: list[tuple[float, str, int, int]]) -> list[tuple[str, int, int]]:
    """The non-overlapping spans (confidence, kind, start, end) of largest total confidence."""
    spans = sorted(set(spans), key=lambda s: (s[3], s[2], s[1]))
    ends = [s[3] for s in spans]
    best: list[float] = [0.0]
    took: list[int] = []
    for score, _, start, _ in spans:
        before = int(np.searchsorted(ends, start, side="right"))
        before = min(before, len(best) - 1)
        took.append(before if best[before] + score > best[-1] else -1)
        best.append(max(best[-1], best[before] + score))
    out, k = [], len(spans)
    while k:
        if took[k - 1] >= 0:
            out.append(spans[k - 1][1:])
            k = took[k - 1]
        else:
            k -= 1
    return out[::-1]


def model_spans(model: BiLstmCrf, texts: list[str], confidence: float = CONFIDENCE) -> list[list[tuple[str, int, int]]]:
    """Spans that the network finds in each text."""
    starts = [windows_of(t) for t in texts]
    matrices = [window_matrix(char_ids(t), s) for t, s in zip(texts, starts) if s]
    found: list[list] = [[] for _ in texts]
    if not matrices:
        return found
    all_ids = np.concatenate(matrices)
    place = [(i, s) for i, own in enumerate(starts) for s in own]
    for a in range(0, len(all_ids), 1024):
        e = model.emissions(all_ids[a : a + 1024])
        path = model.viterbi(e)
        some = np.flatnonzero(path.any(1))
        sure = model.marginals(e[some])
        for row, marg in zip(some.tolist(), sure):
            (i, offset), tags = place[a + row], path[row]
            length = len(texts[i]) - offset
            begins = np.flatnonzero(tags % 2 == 1)
            for b in begins.tolist():
                end, inside = b + 1, tags[b] + 1
                while end < WIDTH and tags[end] == inside:
                    end += 1
                if (end == WIDTH and length > WIDTH) or end > length or (b == 0 and offset):
                    continue  # cut off by the window
                score = float(marg[np.arange(b, end), tags[b:end]].min())
                if score >= confidence:
                    found[i].append((score, KINDS[(tags[b] - 1) // 2], offset + b, offset + end))
    return [best_intervals(f) for f in found]


def plausible(kind: str, s: str) -> bool:
    """Whether a string has what its kind can't be without."""
    digits = "".join(c for c in s if c.isdigit())
    if kind == "email":
        return len(s) >= 6 and ("@" in s or re.search(r"\bat\b", s, re.IGNORECASE) is not None) and s[0].isalnum() and s[-1].isalnum()
    if kind == "ip":
        octets = re.findall("[0-9]+", s)
        return s.count(":") >= 3 or len(octets) == 4 and all(int(x) <= 255 for x in octets)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def scan_pii(docs: DataFrame, model: BiLstmCrf | None) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, n_model (spans that the network adds) and n_spans of every document."""

    def columns(texts: list[str]) -> list:
        out: list[list] = [[] for _ in range(8)]
        more = model_spans(model, texts) if model else [[]] * len(texts)
        for text, guessed in zip(texts, more):
            base = base_spans(text)
            added = [s for s in guessed if plausible(s[0], text[s[1] : s[2]]) and not any(a < s[2] and s[1] < b for _, a, b in base)]
            for col, kind in zip(out, KINDS):
                col.append(sum(s[0] == kind for s in base))
            out[4].append(sha256_hex(spans_text(base, KINDS).encode()))
            out[5].append(spans_text(base + added, KINDS))
            out[6].append(len(added))
            out[7].append(len(base) + len(added))
        return out

    return map_texts(docs, columns, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_model long, n_spans long")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan_pii(docs, fit(docs))
