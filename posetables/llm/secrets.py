"""Secret scans: three patterns, and sliding-window Shannon entropy for what no pattern names.

A candidate is a run of 20 or more characters of [A-Za-z0-9+/_=-]. Within it, a window slides over each run of
a character class; the counts in the window change by one character in and one out, and with them the sum of
c*log2(c), so that the entropy of every window takes constant time. Windows above their class's threshold are
joined into one span, unless the allow-list names the run or the span. A run of 20 to 23 characters of the base64 class is one
window.

Defined results: null and empty texts have no spans (base_sha256 is that of the empty string); repeated rows
give repeated results; an empty table an empty one; other columns are ignored. Texts of any length are scanned whole.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .common import map_texts, sha256_hex, spans_text, table

KINDS = ["assign", "access", "hex", "entropy"]
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of the class is one match, so this is [0-9a-f]+ of 24 and more
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}+")
_HINTS = ("passw", "secret", "token", "api")


@dataclass(frozen=True)
class CharClass:
    """Windows of so many characters of the class, and the bits a character from which they count as random.

    A run shorter than window, but not than least, is one window; its threshold is as far below the most it can reach.
    With fold, letters count alike in either case.
    """

    name: str
    pattern: str
    window: int
    bits: float
    least: int = 0
    fold: bool = False


CLASSES = (
    CharClass("hex", r"[0-9A-Fa-f]+", 20, 3.0, 20, fold=True),
    CharClass("upper", r"[A-Z0-9]+", 16, 3.2, 16),
    CharClass("base64", r"[A-Za-z0-9+/_=-]+", 24, 3.9, 20),
)
#: Strings that look random and are no secrets: placeholders, alphabets, UUIDs, digits only, words (with digits behind) joined by signs.
ALLOW = (
    r"(?i).*example.*",
    r"(?i)(.)\1+",
    r"(?i).*(abcdefghij|0123456789|1234567890|qwertyuiop).*",
    r"[0-9/_=+-]+",
    r"(?!.*[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{7})/?(?:(?:[A-Z]?[a-z]+|[A-Z]{2,}|[A-Z])?[0-9]{0,4}(?:[/_=+-]++|$))+",
    r"(?!.*[b-df-hj-np-tv-xz]{7})(?:[A-Z]?[a-z]{2,}+[0-9]{0,2}+[/_=+-]?+)+",
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
)


def window_entropies(s: str, window: int) -> list[float]:
    """Bits a character of each window of s; the counts are carried from window to window."""
    if len(s) < window:
        return []
    clog = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    counts: dict[str, int] = {}
    total, out, top = 0.0, [], math.log2(window)
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += clog[c + 1] - clog[c]
        if i >= window:
            old = s[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += clog[c - 1] - clog[c]
        if i >= window - 1:
            out.append(top - total / window)
    return out


def entropy_spans(text: str, classes=CLASSES, allow=ALLOW) -> list[tuple[str, int, int]]:
    """Spans of high-entropy windows, overlapping ones joined; the allow-list is held against the candidate and against the span."""
    allowed = [re.compile(x, re.DOTALL) for x in allow]
    named = lambda s: any(p.fullmatch(s) for p in allowed)
    spans: list[tuple[str, int, int]] = []
    for m in _CANDIDATE.finditer(text):
        found: list[tuple[int, int]] = []
        for cls in classes:
            for run in re.finditer(cls.pattern, m[0]):
                window = min(cls.window, max(cls.least or cls.window, len(run[0])))
                for i, h in enumerate(window_entropies(run[0].lower() if cls.fold else run[0], window)):
                    if h >= cls.bits - math.log2(cls.window / window):
                        found.append((m.start() + run.start() + i, m.start() + run.start() + i + window))
        if not found or named(m[0]):
            continue
        joined: list[list[int]] = []
        for a, b in sorted(found):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(b, joined[-1][1])
            else:
                joined.append([a, b])
        spans += [("entropy", a, b) for a, b in joined if not named(text[a:b])]
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        spans += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return spans + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)] if _long(text) else spans


def _long(text: str) -> bool:
    """Whether a stretch without white space reaches 20 characters, as every hex run and candidate does."""
    return max(map(len, text.split()), default=0) >= 20


def secret_spans(text: str, classes=CLASSES, allow=ALLOW) -> tuple[list, list]:
    """(base spans, entropy spans); of the latter those that lie in a base span are dropped."""
    base = base_spans(text)
    more = entropy_spans(text, classes, allow) if _long(text) else []
    return base, [s for s in more if not any(a <= s[1] and s[2] <= b for _, a, b in base)]


def scan_secrets(docs: DataFrame, classes=CLASSES, allow=ALLOW) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, n_entropy and n_spans (all of them) of every document."""

    def columns(texts: list[str]) -> list:
        out: list[list] = [[] for _ in range(7)]
        for text in texts:
            base, more = secret_spans(text, classes, allow)
            for col, kind in zip(out, KINDS[:3]):
                col.append(sum(s[0] == kind for s in base))
            out[3].append(sha256_hex(spans_text(base, KINDS).encode()))
            out[4].append(spans_text(base + more, KINDS))
            out[5].append(len(more))
            out[6].append(len(base) + len(more))
        return out

    return map_texts(docs, columns, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long, n_spans long")


def _allowed_sql(m: str) -> str:
    """ALLOW in DuckDB, whose patterns have neither lookahead nor backreferences."""
    return f"""(contains(lower({m}), 'example') OR replace(lower({m}), lower({m}[1]), '') = '' OR regexp_matches(lower({m}), 'abcdefghij|0123456789|1234567890|qwertyuiop') OR regexp_full_match({m}, '[0-9/_=+-]+')
  OR (NOT regexp_matches({m}, '[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{{7}}') AND regexp_full_match({m}, '/?(?:(?:[A-Z]?[a-z]+|[A-Z]{{2,}}|[A-Z])?[0-9]{{0,4}}(?:[/_=+-]+|$))+'))
  OR (NOT regexp_matches({m}, '[b-df-hj-np-tv-xz]{{7}}') AND regexp_full_match({m}, '(?:[A-Z]?[a-z]{{2,}}[0-9]{{0,2}}[/_=+-]?)+')) OR regexp_full_match({m}, '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}'))"""


#: The same rows in DuckDB: places of matches follow from the lengths of what lies between them; each window is counted anew.
OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
 pat(kind, rank, p) AS (VALUES ('assign', 0, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'), ('access', 1, 'AKIA[A-Z0-9]+'), ('hex', 2, '[0-9a-f]+'), ('entropy', 3, '[A-Za-z0-9+/_=-]{20,}')),
 cut AS (SELECT r, kind, rank, regexp_extract_all(t, p) AS ms, regexp_split_to_array(t, p) AS gaps FROM d, pat WHERE kind <> 'hex' OR regexp_matches(t, '[0-9a-f]{24}')),
 each AS (SELECT r, kind, rank, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM cut WHERE len(ms) > 0),
 found AS (SELECT r, kind, rank, ms[i] AS m, CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a FROM each),
 base AS (SELECT r, kind, rank, a, a + length(m) AS b FROM found WHERE (kind = 'assign' AND length(regexp_extract(m, '^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6) OR (kind = 'access' AND length(m) >= 20) OR (kind = 'hex' AND length(m) >= 24)),
 cand AS (SELECT r, a, m FROM found WHERE kind = 'entropy'),
 cls(cp, w, bits, least, fold) AS (VALUES ('[0-9A-Fa-f]+', 20, 3.0e0, 20, true), ('[A-Z0-9]+', 16, 3.2e0, 16, false), ('[A-Za-z0-9+/_=-]+', 24, 3.9e0, 20, false)),
 runs AS (SELECT r, a, m, w, bits, least, fold, regexp_extract_all(m, cp) AS ms, regexp_split_to_array(m, cp) AS gaps FROM cand, cls),
 run AS (SELECT r, a, m, w, bits, CASE WHEN fold THEN lower(ms[i]) ELSE ms[i] END AS s, least(w, greatest(least, length(ms[i]))) AS v, a + CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS org FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM runs) x),
 win AS (SELECT r, a, m, bits, w, v, org + k AS s, string_split(substring(s, CAST(k + 1 AS BIGINT), v), '') AS cs FROM (SELECT *, unnest(range(0, length(s) - v + 1)) AS k FROM run WHERE length(s) >= v) x),
 hot AS (SELECT r, a, m, s, s + v AS e FROM win WHERE log2(v) - list_sum(list_transform(map_values(list_histogram(cs)), lambda c: c * log2(c))) / v >= bits - log2(w / CAST(v AS DOUBLE))),
 open AS (SELECT DISTINCT * FROM hot WHERE NOT ALLOWED),
 part AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY r, a ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM open),
 isle AS (SELECT *, sum(fresh) OVER (PARTITION BY r, a ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM part),
 span AS (SELECT r, min(s) AS a, max(e) AS b, substring(any_value(m), CAST(min(s) - a + 1 AS BIGINT), CAST(max(e) - min(s) AS BIGINT)) AS m FROM isle GROUP BY r, a, k),
 more AS (SELECT r, 'entropy' AS kind, 3 AS rank, a, b FROM span WHERE NOT ALLOWED AND NOT EXISTS (SELECT 1 FROM base WHERE base.r = span.r AND base.a <= span.a AND span.b <= base.b)),
 every AS (SELECT * FROM base UNION ALL SELECT * FROM more),
 summed AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'entropy') AS n_entropy, count(*) AS n_spans,
   string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (kind <> 'entropy') AS bs, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans FROM every GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(bs, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy, coalesce(n_spans, 0) AS n_spans FROM d LEFT JOIN summed ON summed.r = d.r""".replace("ALLOWED", _allowed_sql("m"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
