"""Quality rules as a short-circuit cascade.

A sample tells what each rule costs and how often it rejects; the rules are then tried in the order of
rejections per second, and a document's first rejection ends its cascade. A document is kept if no rule
rejects it, so the order changes the time and never the verdict.

Defined results: a null or empty text has no words and fails too_few_words; repeated rows are judged one by
one; ties between rules go by their place; an empty table gives an empty result; texts of any length are read whole; further
columns are ignored (quality_report) or carried (keep_good).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_texts, slices, table, texts_of

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_MULTIPLIERS = np.random.default_rng(20).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


class Features:
    """What rules ask of a text; each is computed when first asked for."""

    def __init__(self, text: str):
        self.raw = text.encode()
        self.words = self.raw.split()  # of bytes: just the six ASCII white spaces part words
        self.n_words = len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def hashes(self) -> np.ndarray:
        return np.fromiter(map(hash, self.words), np.int64, self.n_words).view(np.uint64)

    @cached_property
    def n_repeat_words(self) -> int:
        n = self.n_words - WINDOW + 1
        if n < 2:
            return 0
        h = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            h += self.hashes[k : k + n] * _MULTIPLIERS[k]
        order = np.sort(h)
        twice = order[1:][order[1:] == order[:-1]]
        if not len(twice):
            return 0
        starts = np.isin(h, twice).astype(np.int32)
        edges = np.zeros(self.n_words + 1, np.int32)
        edges[:n] += starts
        edges[WINDOW : WINDOW + n] -= starts
        return int((np.cumsum(edges)[:-1] > 0).sum())

    @cached_property
    def n_echoes(self) -> int:
        """Words that equal the word before."""
        return int((self.hashes[1:] == self.hashes[:-1]).sum())

    @cached_property
    def upper_share(self) -> float:
        """Share of upper case among the ASCII letters."""
        a = np.frombuffer(self.raw, np.uint8)
        upper, lower = int(((a >= 65) & (a <= 90)).sum()), int(((a >= 97) & (a <= 122)).sum())
        return upper / max(1, upper + lower)


@dataclass(frozen=True)
class Rule:
    """rejects(features) tells whether a text goes. base: part of base_failed."""

    name: str
    rejects: Callable[[Features], bool]
    base: bool = False


RULES = (
    Rule("too_few_words", lambda f: f.n_words < 20, base=True),
    Rule("repeated_windows", lambda f: 100 * f.n_repeat_words > 30 * f.n_words, base=True),
    Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words),
    Rule("shouting", lambda f: f.upper_share > 0.6),
    Rule("echoes", lambda f: 5 * f.n_echoes > f.n_words),
    Rule("duplicate_lines", lambda f: 2 * f.n_dup_lines > len(f.lines)),
    Rule("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 20 * f.n_words),
)


#: Bound of the sample from which costs and selectivities come, in documents.
SAMPLE_DOCUMENTS = 4000


def rule_costs(docs: DataFrame, rules: tuple[Rule, ...] = RULES, most: int = SAMPLE_DOCUMENTS, seed: int = 7) -> dict[str, tuple[float, float]]:
    """rule -> (seconds a text, share of texts that it rejects), each rule run on all of a sample of about `most` documents.

    A task gives a row for each rule, so the driver gets a few sums.
    """

    def work(batches):
        spent, hits, n = dict.fromkeys([r.name for r in rules], 0.0), dict.fromkeys([r.name for r in rules], 0), 0
        for batch in batches:
            for _, _, texts in slices(batch):
                for text in texts:
                    n += 1
                    shared = Features(text)
                    for rule in rules:
                        fresh = Features.__new__(Features)
                        fresh.raw, fresh.words, fresh.n_words = shared.raw, shared.words, shared.n_words
                        began = time.perf_counter()
                        hits[rule.name] += rule.rejects(fresh)
                        spent[rule.name] += time.perf_counter() - began
        if n:
            yield pa.RecordBatch.from_pydict({"rule": list(spent), "seconds": list(spent.values()), "rejected": list(hits.values()), "n": [n] * len(spent)})

    fraction = min(1.0, most / max(1, docs.count()))
    sampled = texts_of(docs).sample(fraction=fraction, seed=seed).mapInArrow(work, "rule string, seconds double, rejected long, n long")
    found = {r["rule"]: (r["s"] / r["n"], r["r"] / r["n"]) for r in sampled.groupBy("rule").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("r"), F.sum("n").alias("n")).collect()}
    return {r.name: found.get(r.name, (1.0, 0.0)) for r in rules}


def cascade_order(costs: dict[str, tuple[float, float]], rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Most rejections per second first; ties by place."""
    return tuple(sorted(rules, key=lambda r: -costs[r.name][1] / max(costs[r.name][0], 1e-9)))


def passes(features: Features, ordered: tuple[Rule, ...]) -> bool:
    return not any(rule.rejects(features) for rule in ordered)


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, most: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """doc_id, the counts of the text, base_failed, and kept: what the cascade says."""
    ordered = cascade_order(rule_costs(docs, rules, most), rules)
    base = tuple(r for r in rules if r.base)

    def columns(texts: list[str]) -> list:
        rows = []
        for text in texts:
            f = Features(text)
            kept = passes(f, ordered)
            rows.append((f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, not kept and not passes(f, base), kept))
        return list(map(list, zip(*rows)))

    return map_texts(docs, columns, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, most: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """docs without the documents that a rule rejects, with all their columns."""
    ordered = cascade_order(rule_costs(docs, rules, most), rules)
    at = docs.columns.index("text")

    def work(batches):
        for batch in batches:
            mask = []
            for i in range(batch.num_rows):
                mask.append(passes(Features(batch.column(at)[i].as_py() or ""), ordered))
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


#: The same rows in DuckDB.
OP9_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
 w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
 win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8) x),
 twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM win) x WHERE n > 1),
 inside AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) x GROUP BY doc_id),
 echo AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM w) x WHERE ws[i] = ws[i + 1] GROUP BY doc_id),
 f AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
   CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(inside.n, 0) AS n_repeat_words, coalesce(echo.n, 0) AS n_echoes, len(ls) AS n_lines,
   length(regexp_replace(t, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(t, '[^a-z]', '', 'g')) AS low FROM w LEFT JOIN inside ON inside.doc_id = w.doc_id LEFT JOIN echo ON echo.doc_id = w.doc_id),
 b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND 10 * n_symbols <= n_words AND up / greatest(1, up + low) <= 0.6e0 AND 5 * n_echoes <= n_words AND 2 * n_dup_lines <= n_lines AND word_chars BETWEEN 2 * n_words AND 20 * n_words AS kept FROM b"""
