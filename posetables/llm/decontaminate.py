"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units and names (capitalised words; one that begins a sentence is a name unless
the benchmark has it in lower case) turn into typed placeholders, other words are lower-cased without the punctuation
around them. Numbers may be digits or English number words; number words that follow each other ("twenty five"), a number
and the power of ten behind it ("5 million") and names that follow each other ("New York"), with no mark between them, are one token, so that
a value may have more words than another. Windows of five template tokens of the documents are hash-joined to those of the benchmark. A window
with fewer than two words that are no placeholders is taken literally, so that tables of numbers don't meet by chance; such
windows count only for items that have fewer than three others, and those of one value over and over are left out. An
item of fewer than five tokens is one window, a template if it has three words and literal if not. A bit table of all
benchmark windows, whose size does not depend on the benchmark, first drops windows that no item has; the join decides.

A document and an item match if 80 % of the item's windows are found, or a run of windows that spans min_run tokens; and
the slots must fit: in all of a document and an item, a value of the item stands for one value of the document (so a
re-parameterised question is caught and a chance meeting of placeholders is not). Where a value stands for several, only
the windows that conflict are dropped: windows stay if their words are literally the item's or if their values are
those that stand most often for the item's, and the longest run of a copy that is consistent in itself counts too.

Defined results: null and empty texts match nothing, nor do items without words; repeated rows of documents with one
doc_id are one document; null doc_id or item_id is a group of its own; an empty table on either side gives an empty
result; texts of any length are searched whole; of values that stand equally often the literal one counts, then the
greatest; further columns are ignored (contamination) or kept (drop_contaminated).
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bits import bit_table, holds
from .common import shared, slices, table, texts_of

WINDOW = 5
SHARE = 0.8
MIN_RUN = 13
#: Units of measure, matched in lower case. Fixed values.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years percent % dollar dollars cent cents euro euros usd eur mph kph hz khz mhz ghz kb mb gb tb degree degrees"
)
_UNITS = frozenset(UNITS.split())
#: English number words. Fixed values.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion trillion dozen"
)
POWERS = "hundred thousand million billion trillion dozen"
_NUMBER_WORDS, _POWERS = frozenset(NUMBER_WORDS.split()), frozenset(POWERS.split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*")
_GLUED = re.compile(r"([+-]?[$€£]?\d[\d.,]*)([A-Za-z%]+)")
_EDGE = "\"'`.,;:!?()[]{}<>«»„“”‘’…-–—"
_ENDS = (".", "!", "?", ":", "\"", "”", "»")
_M = (np.random.default_rng(10).integers(1, 2**63, WINDOW, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_CACHE = 300_000


def template_token(word: str) -> str:
    """The template token of a word outside its sentence: a placeholder, or the word in lower case."""
    bare = word.strip(_EDGE)
    low = bare.lower()
    if _NUMBER.fullmatch(bare) or is_spelled(low):
        return "<num>"
    if (m := _GLUED.fullmatch(bare)) and m[2].lower() in _UNITS:
        return "<num+unit>"
    return "<unit>" if low in _UNITS and len(low) > 1 or low == "%" else low or word


def is_spelled(low: str) -> bool:
    """Whether a lower-case word is a number word, or several joined by hyphens."""
    return low in _NUMBER_WORDS or "-" in low and all(x in _NUMBER_WORDS for x in low.split("-"))


def is_slot(token: str) -> bool:
    return token.startswith("<") and token.endswith(">")


class Templates:
    """Template tokens of texts, with a bounded memory of words. known: bit table of the benchmark's lower-case words."""

    def __init__(self, known: np.ndarray | None = None):
        self.known = known
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.hashes: list[int] = []
        self.literal: list[int] = []
        self.capital: list[bool] = []
        self.ends: list[bool] = []
        self.slots: list[bool] = []
        self.spelled: list[bool] = []
        self.powers: list[bool] = []
        self.marked: list[bool] = []
        self.done = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, bool) for _ in range(7))]

    def _arrays(self) -> list[np.ndarray]:
        """The memory as arrays; only what came since the last call is converted."""
        n = len(self.done[0])
        if n < len(self.hashes):
            flags = (self.capital, self.ends, self.slots, self.spelled, self.powers, self.marked)
            new = [np.array(x[n:], kind) for x, kind in ((self.hashes, np.uint64), (self.literal, np.uint64), *((x, bool) for x in flags))]
            # A capitalised word that is nowhere in lower case is a name wherever it stands.
            new.append(new[2] & ~holds(self.known, new[1].view(np.int64)) if self.known is not None else np.zeros(len(new[0]), bool))
            self.done = [np.concatenate(x) for x in zip(self.done, new)]
        return self.done

    def _add(self, raw: bytes) -> int:
        word = raw.decode()
        token, bare = template_token(word), word.strip(_EDGE)
        self.hashes.append(xxhash.xxh64_intdigest(token.encode()))
        self.literal.append(xxhash.xxh64_intdigest((bare.lower() or word).encode(), 1))
        self.slots.append(is_slot(token))
        self.capital.append(bare[:1].isupper() and bare[1:].islower() and not is_slot(token))
        self.ends.append(word.endswith(_ENDS))
        low = bare.lower()
        self.spelled.append(is_spelled(low))
        self.powers.append(low in _POWERS)
        self.marked.append(word[-1:] in _EDGE)
        self.ids[raw] = n = len(self.hashes) - 1
        return n

    def read(self, texts: list[str]) -> list[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text the words (those of one token joined), hashes of their template tokens, hashes of the words themselves, and which of them are slots."""
        if len(self.hashes) > _CACHE:
            self.clear()
        words, ids, starts = [], [], []
        for text in texts:
            lines = [x.split() for x in text.encode().split(b"\n")]
            own = [w for line in lines for w in line]
            first = np.zeros(len(own) + 1, bool)
            first[np.cumsum([0, *map(len, lines)])] = True
            words.append(own)
            starts.append(first[: len(own)])
            get, add = self.ids.get, self._add
            ids.append(np.array([i if (i := get(w)) is not None else add(w) for w in own], np.int64))
        hashes, literal, capital, ends, slots, spelled, powers, marked, always = self._arrays()
        out = []
        name, number = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"<name>", b"<num>"))
        for own, i, first in zip(words, ids, starts):
            if not len(i):
                out.append((own, *(np.zeros(0, np.uint64),) * 2, np.zeros(0, bool)))
                continue
            fresh = first.copy()
            fresh[1:] |= ends[i[:-1]]
            is_name = capital[i] & ~fresh | always[i]
            template, words_at, slot = np.where(is_name, name, hashes[i]), literal[i], slots[i] | is_name
            behind = is_name[1:] & is_name[:-1] | spelled[i[1:]] & spelled[i[:-1]] | powers[i[1:]] & (template[:-1] == number)
            behind &= ~marked[i[:-1]] & ~first[1:]
            if behind.any():
                own, template, words_at, slot = joined_tokens(own, template, words_at, slot, np.concatenate([[False], behind]))
            out.append((own, template, words_at, slot))
        return out


def joined_tokens(words: list[bytes], template: np.ndarray, literal: np.ndarray, slots: np.ndarray, behind: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The arrays of a text where each token of which behind is true belongs to the one before it; its words are joined by "_"."""
    starts = np.flatnonzero(~behind)
    ends = np.append(starts[1:], len(words))
    place = np.arange(len(words)) - np.repeat(starts, ends - starts)
    one = [words[a] for a in starts.tolist()]
    for k in np.flatnonzero(ends - starts > 1).tolist():
        one[k] = b"_".join(words[starts[k] : ends[k]])
    return one, template[starts], np.add.reduceat(literal * (2 * place + 1).astype(np.uint64), starts), slots[starts]


def window_hashes(tokens: np.ndarray, size: int = WINDOW, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the windows of so many tokens that begin at each place (or at those given)."""
    n = max(0, len(tokens) - size + 1)
    h = np.full(n if at is None else len(at), size, np.uint64)
    for k in range(size):
        h = (h ^ (h >> np.uint64(29))) * _M[k] + (tokens[k : k + n] if at is None else tokens[at + k])
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def windows_of(template: np.ndarray, literal: np.ndarray, slots: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, whether it is a template) of a text's windows of so many tokens."""
    n = len(template) - size + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    h, least = window_hashes(template, size), 2 if size == WINDOW else 3
    at = np.arange(n)
    if slots.sum() <= size - least:  # every window has words enough
        return at, h, np.ones(n, bool)
    plain = np.cumsum(np.concatenate([[0], ~slots]))
    is_template = plain[size:] - plain[:-size] >= least
    rest = np.flatnonzero(~is_template)
    if not len(rest):
        return at, h, is_template
    h[rest] = window_hashes(literal, size, rest) ^ np.int64(0x5DEECE66D)
    if size == WINDOW:  # not a value over and over
        keep = np.ones(n, bool)
        keep[rest] = np.any([literal[rest] != literal[rest + k] for k in range(1, size)], axis=0)
        at = np.flatnonzero(keep)
    return at, h[at], is_template[at]


_WINDOWS = "pos long, window long, slots string, size int, template boolean"


def _rows(key: str, batch: pa.RecordBatch, start: int, rows: list[tuple]) -> pa.RecordBatch:
    """rows: (place in the slice, pos, window, slots, size, template)."""
    columns = list(zip(*rows)) or [()] * 6
    ids = pa.array([batch.column(0)[start + i].as_py() for i in columns[0]], pa.int64())
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_())
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns[1:], kinds))], names=[key, "pos", "window", "slots", "size", "template"])


def _slot_values(words: list[bytes], slots: np.ndarray, p: int, size: int) -> str:
    return b" ".join(w if (w := words[p + k].lower().strip(b".,;:!?")) else words[p + k] for k in np.flatnonzero(slots[p : p + size])).decode()


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """h of each word that the benchmark has in lower case."""

    def work(batches):
        for batch in batches:
            found = set()
            for _, _, texts in slices(batch):
                found |= {xxhash.xxh64_intdigest(w.encode(), 1) - (1 << 64 if xxhash.xxh64_intdigest(w.encode(), 1) >> 63 else 0) for text in texts for x in text.split() if (w := x.strip(_EDGE)) and w == w.lower()}
            yield pa.RecordBatch.from_pydict({"h": pa.array(sorted(found), pa.int64())})

    return _items(benchmark).mapInArrow(work, "h long").distinct()


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), F.coalesce(benchmark["text"].cast("string"), F.lit("")).alias("text"))


def benchmark_windows(benchmark: DataFrame, known: np.ndarray) -> DataFrame:
    """item_id, pos, window, slots, size, template of the windows by which each item is searched."""

    def work(batches):
        templates = Templates(known)
        for batch in batches:
            for start, _, texts in slices(batch):
                rows = []
                for i, (words, template, literal, slots) in enumerate(templates.read(texts)):
                    size = min(WINDOW, len(words))
                    at, h, is_template = windows_of(template, literal, slots, size) if size else ([],) * 3
                    few = sum(is_template) < 3
                    rows += [(i, p, x, _slot_values(words, slots, p, size) if t else "", size, t) for p, x, t in zip(map(int, at), h, map(bool, is_template)) if t or few]
                yield _rows("item_id", batch, start, rows)

    return _items(benchmark).mapInArrow(work, f"item_id long, {_WINDOWS}")


def document_windows(docs: DataFrame, known: np.ndarray, found: np.ndarray, sizes: list[int]) -> DataFrame:
    """doc_id, pos, window, slots, size, template of the documents' windows of these sizes that the bit table holds."""

    def work(batches):
        templates = Templates(known)
        for batch in batches:
            for start, _, texts in slices(batch):
                rows = []
                for i, (words, template, literal, slots) in enumerate(templates.read(texts)):
                    for size in sizes:
                        at, h, is_template = windows_of(template, literal, slots, size)
                        for k in np.flatnonzero(holds(found, h)).tolist() if len(h) else []:
                            p, t = int(at[k]), bool(is_template[k])
                            rows.append((i, p, h[k], _slot_values(words, slots, p, size) if t else "", size, t))
                yield _rows("doc_id", batch, start, rows)

    return texts_of(docs).mapInArrow(work, f"doc_id long, {_WINDOWS}")


def fitting_windows(places: list[int], pairs: list[list[tuple[str, str]]]) -> tuple[np.ndarray, int]:
    """Which windows of one copy stay, and the tokens of its longest consistent run.

    places: the windows' positions in the item, ascending; pairs: (item's, document's) value of each slot.
    """
    votes = Counter(x for own in pairs for x in own)
    stands: dict[str, str] = {}
    for a, b in sorted(votes, key=lambda x: (votes[x], x[0] == x[1], x[1])):
        stands[a] = b  # the most frequent one comes last, of several the literal one
    keep = np.array([all(a == b for a, b in own) or all(stands[a] == b for a, b in own) for own in pairs], bool)
    low, longest, values = 0, 0, {}  # values of the run from low on: how often each item's value stands for each of the document's
    for high, own in enumerate(pairs):
        if high and places[high] > places[high - 1] + 1:
            low, values = high, {}
        for a, b in own:
            values.setdefault(a, Counter())[b] += 1
        while any(len(values[a]) > 1 for a, _ in own):
            for a, b in pairs[low]:
                values[a][b] -= 1
                if not values[a][b]:
                    del values[a][b]
            low += 1
        if low <= high:
            longest = max(longest, places[high] - places[low] + WINDOW)
    return keep, longest


def fitting_pair(shifts: list[int], places: list[int], pairs: list[list[tuple[str, str]]]) -> tuple[np.ndarray, int]:
    """Which windows of a document and an item stay, and the tokens of the longest run of a copy (windows at one shift) that is consistent in itself."""
    copies: dict[int, list[int]] = {}
    for i in sorted(range(len(shifts)), key=lambda i: places[i]):
        copies.setdefault(shifts[i], []).append(i)
    keep, _ = fitting_windows(places, pairs)
    return keep, max(fitting_windows([places[i] for i in own], [pairs[i] for i in own])[1] for own in copies.values())


def _fitting(group: pa.Table) -> pa.Table:
    """The windows of a document and an item that stay, and a row without place that has the longest run."""
    pairs = [list(zip(a.split(" "), b.split(" "))) if a else [] for a, b in zip(group["slots"].to_pylist(), group["doc_slots"].to_pylist())]
    keep, longest = fitting_pair(group["shift"].to_pylist(), group["pos"].to_pylist(), pairs)
    kept, one = group.filter(pa.array(keep)), group.slice(0, 1)
    kept = kept.select(["doc_id", "item_id", "pos", "window", "size"]).append_column("run", pa.nulls(len(kept), pa.int64()))
    none = pa.nulls(1, pa.int64())
    return pa.concat_tables([kept, pa.Table.from_arrays([one["doc_id"], one["item_id"], none, none, one["size"], pa.array([longest], pa.int64())], schema=kept.schema)])


def contamination(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, item_id, matched and n_windows (distinct windows of the item), longest_run (tokens) of each matching pair."""
    known = bit_table(benchmark_words(benchmark), "h")
    items = shared(benchmark_windows(benchmark, known))
    lengths = [r["size"] for r in items.select("size").distinct().collect()]  # 1 to WINDOW
    sizes = items.groupBy("item_id").agg(F.countDistinct("window").alias("n_windows"))
    doc = document_windows(docs, known, bit_table(items, "window"), sorted(lengths))
    hits = shared(doc.select("doc_id", "window", F.col("pos").alias("doc_pos"), F.col("slots").alias("doc_slots")))
    met = hits.join(items.drop("template"), "window").withColumn("shift", F.col("doc_pos") - F.col("pos"))
    # Within a document and an item, each value of the item must stand for one value of the document.
    slots = met.where("slots <> ''").select("doc_id", "item_id", F.explode(F.arrays_zip(F.split("slots", " ").alias("a"), F.split("doc_slots", " ").alias("b"))).alias("s"))
    misfit = slots.groupBy("doc_id", "item_id", "s.a").agg(F.min("s.b").alias("low"), F.max("s.b").alias("high")).where("low <> high").select("doc_id", "item_id").distinct()
    same = F.expr("p.doc_id <=> m.doc_id and p.item_id <=> m.item_id")
    whole = met.alias("p").join(misfit.alias("m"), same, "left_anti").select("doc_id", "item_id", "pos", "window", "size", F.lit(None).cast("long").alias("run"))
    mixed = met.alias("p").join(misfit.alias("m"), same, "left_semi").select("doc_id", "item_id", "shift", "pos", "window", "size", "slots", "doc_slots")
    fits = whole.unionByName(mixed.groupBy("doc_id", "item_id").applyInArrow(_fitting, "doc_id long, item_id long, pos long, window long, size int, run long"))
    places = fits.groupBy("doc_id", "item_id", "pos").agg(F.first("window").alias("window"), F.max("run").alias("run"), F.max("size").alias("size"))
    by_pair = Window.partitionBy("doc_id", "item_id").orderBy("pos")  # at most the item's windows
    runs = places.withColumn("island", F.col("pos") - F.row_number().over(by_pair)).groupBy("doc_id", "item_id", "island").agg(F.count("pos").alias("n"), F.collect_set("window").alias("w"), F.max("run").alias("run"), F.max("size").alias("size"))
    pairs = runs.groupBy("doc_id", "item_id").agg(F.greatest(F.max("n") + F.max("size") - 1, F.max("run")).alias("longest_run"), F.size(F.array_distinct(F.flatten(F.collect_list("w")))).cast("long").alias("matched"))
    found = pairs.alias("p").join(sizes.alias("s"), F.expr("p.item_id <=> s.item_id")).where((F.col("matched") >= share * F.col("n_windows")) | (F.col("longest_run") >= min_run))
    return found.select("doc_id", F.col("p.item_id").alias("item_id"), "matched", "n_windows", "longest_run")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, min_run: int = MIN_RUN) -> DataFrame:
    """docs without the documents that match an item; rows with a null doc_id stay."""
    bad = contamination(docs, benchmark, share, min_run).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long") == bad["_bad"], "left_anti")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
