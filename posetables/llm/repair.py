"""Repair of conversation structure by depth-first branch-and-bound.

The repaired roles must read `(s?(ua)+)?` by their initials. At each row of a conversation the search may keep, rerole or
delete it, and insert an empty user or assistant turn before it or at the end. It keeps an explicit stack, prunes with
suffix lower bounds and an incumbent (cost, audit), and drops a prefix that is no better than one that reached the same
node before. It ends when nothing on the stack can beat the incumbent, which is then optimal.

Rows are dealt out by range of (conv_id, turn, role, text) rather than by conversation, so that a conversation of any length
is spread over tasks. One that lies inside a partition is solved there. Of one that touches a partition's edge, or has
more than SEGMENT_ROWS rows, each stretch is solved from every state to every state; those small tables are put together
in order, and the texts are then hashed as a stream. Equal rows are counted before they are shuffled.

Defined results: null conv_id, turn, role and text read as one space where text is made of them; rows with a null conv_id
are one conversation whose conv_id is null; rows of the same turn follow each other by role, then text; an empty table gives an empty result;
texts of any length are kept whole; a role that begins with neither s, u nor a can't be kept; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import shared, table

#: Rows of a conversation that are searched at once.
SEGMENT_ROWS = 1024
#: Conversations of a few rows look alike; so many solved patterns are kept by a worker.
KNOWN_PATTERNS = 50_000

COST = {"D": 2, "I": 5, "K": 0, "R": 1}
TRUNCATED_COST = 5
STATES = range(4)  # nothing yet, after s, after u, after a
ACCEPTED = frozenset({0, 3})
INSERTED = (2, 2, 3, 2)  # the state after an inserted or reroled turn
NAMES = ("user", "user", "assistant", "user")  # and its role
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_LEGAL = {"su", "ua", "au"}

# What a row is to the search: its initial (o: another), a capital if it is truncated, x if it has to go.
MUST_GO = "x"


def _moves(code: str | None, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows taken, next state) in a state before a row, or at the end (None); by edit."""
    insert = ("I", COST["I"], 0, INSERTED[state])
    if code is None:
        return [insert]
    moves = [("D", COST["D"], 1, state), insert]
    if code != MUST_GO:
        more = TRUNCATED_COST if code.isupper() else 0
        if (kept := _KEPT.get((state, code.lower()))) is not None:
            moves.append(("K", COST["K"] + more, 1, kept))
        moves.append(("R", COST["R"] + more, 1, INSERTED[state]))
    return moves


_MOVES = {(c, q): _moves(c, q) for c in [*"suaoSUAOx", None] for q in STATES}
_FAR = 1 << 60


def suffix_bounds(codes: str, ends: frozenset[int]) -> list[list[int]]:
    """For each row and state a lower bound of what is still to be paid; it is the least cost itself."""
    bounds: list[list[int]] = [[]] * (len(codes) + 1)
    later = None
    for i in range(len(codes), -1, -1):
        code = codes[i] if i < len(codes) else None
        here = [0 if later is None and q in ends else _FAR for q in STATES]
        if later is not None:
            for q in STATES:
                here[q] = min(cost + later[to] for _, cost, rows, to in _MOVES[code, q] if rows)
        for _ in range(2):  # two inserted turns lead back to where they began
            here = [min(here[q], COST["I"] + here[INSERTED[q]]) for q in STATES]
        bounds[i] = later = here
    return bounds


def search(codes: str, start: int = 0, ends: frozenset[int] = ACCEPTED) -> tuple[int, str] | None:
    """Least (cost, audit) that leads from the start to one of the ends over all rows; None if nothing does."""
    bounds = suffix_bounds(codes, ends)
    limit = bounds[0][start]
    if limit >= _FAR:
        return None
    n = len(codes)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        bound = cost + bounds[i][state]
        if best is not None and (bound > best[0] or (bound == best[0] and audit > best[1][: len(audit)])):
            continue
        if (seen := reached.get((i, state))) is not None and seen <= (cost, audit):
            continue
        reached[i, state] = cost, audit
        if i == n and state in ends and (best is None or (cost, audit) < best):
            best = cost, audit
        children = []
        for edit, price, rows, to in _MOVES[codes[i] if i < n else None, state]:
            f = cost + price + bounds[i + rows][to]
            if f <= (limit if best is None else best[0]):
                children.append((f, edit, (i + rows, to, cost + price, audit + edit)))
        stack += [c[2] for c in sorted(children, reverse=True)]  # the most promising is taken first
    return best


@lru_cache(KNOWN_PATTERNS)
def _known(codes: str) -> tuple[int, str]:
    return search(codes)


def solve(codes: str) -> tuple[int, str]:
    return _known(codes) if len(codes) <= 12 else search(codes)


def repaired(audit: str, state: int, codes: str, roles: list[str], texts: list[str]) -> Iterator[str]:
    """Lines that the edits leave, from a state on."""
    i = 0
    for edit in audit:
        if edit == "D":
            i += 1
        elif edit == "K":
            yield f"{roles[i]}:{texts[i]}"
            state = _KEPT[state, codes[i].lower()]
            i += 1
        else:
            yield f"{NAMES[state]}:{texts[i] if edit == 'R' else ''}"
            state = INSERTED[state]
            i += edit == "R"


#: Counts of a stretch of rows, in the order of its facts.
FACTS = ["rows", "distinct", "first_turn", "last_turn", "low", "high", "blank", "duplicate", "truncated", "illegal"]


class Stretch:
    """Consecutive rows of one conversation."""

    def __init__(self):
        self.codes: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns: list[int | None] = []
        self.faults: list[str] = []

    def add(self, turn, role, text, fault, times: int, first: bool) -> None:
        """Rows that are equal; all but the first of a conversation's equal rows are duplicates, unless they are blank."""
        for k in range(times):
            kind = "d" if fault != "b" and (k or not first) else fault
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            self.codes.append(MUST_GO if kind in "bd" else initial.upper() if kind == "t" else initial)
            self.roles.append(role)
            self.texts.append(text)
            self.turns.append(turn)
            self.faults.append(kind)

    def facts(self) -> list[int | None]:
        turns = [t for t in self.turns if t is not None]
        pairs = zip(self.roles, self.roles[1:])
        ends = [turns[0], turns[-1], turns[0], turns[-1]] if turns else [None] * 4
        return [len(self.codes), len(set(turns)), *ends, *(self.faults.count(x) for x in "bdt"), sum(a[:1] + b[:1] not in _LEGAL for a, b in pairs)]


def _together(parts: list[tuple[list, str, str]]) -> tuple[int, int, int, int, int]:
    """gaps, blank, duplicate, truncated, illegal of stretches (facts, first and last initial) in order."""
    low = high = last_turn = last = None
    distinct = 0
    sums = [0, 0, 0, 0]
    for facts, first_initial, last_initial in parts:
        f = dict(zip(FACTS, facts))
        if not f["rows"]:
            continue
        sums = [a + b for a, b in zip(sums, facts[6:])]
        if last is not None:
            sums[3] += last + first_initial not in _LEGAL
        last = last_initial
        if f["low"] is not None:
            distinct += f["distinct"] - (last_turn == f["first_turn"])
            low, high, last_turn = f["low"] if low is None else min(low, f["low"]), f["high"] if high is None else max(high, f["high"]), f["last_turn"]
    return (high - low + 1 - distinct if low is not None else 0, *sums)


def chain(tables: list[tuple[list, list]]) -> tuple[int, list[tuple[int, str]]]:
    """Least cost over stretches whose tables (costs, audits; from each state to each) follow each other; (state, audit) of each."""
    paths: dict[int, tuple[int, str, list]] = {0: (0, "", [])}
    for costs, audits in tables:
        then: dict[int, tuple[int, str, list]] = {}
        for q, (cost, audit, way) in paths.items():
            for to in STATES:
                if costs[4 * q + to] is not None:
                    found = (cost + costs[4 * q + to], audit + audits[4 * q + to], (way, q, audits[4 * q + to]))
                    if to not in then or found[:2] < then[to][:2]:
                        then[to] = found
        paths = then
    cost, _, way = min((paths[q] for q in ACCEPTED if q in paths), key=lambda x: x[:2])
    out = []
    while way:
        way, q, audit = way
        out.append((q, audit))
    return cost, out[::-1]


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PIECE = "kind int, place long, part int, facts array<long>, initials array<string>, costs array<long>, audits array<string>, codes string, roles array<string>, texts array<string>"
_WHOLE, _TABLE, _TEXT = 0, 1, 2


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


class _Out:
    """Rows that become a batch when there are enough of them."""

    def __init__(self, ddl: str, most_rows: int = 2000, most_chars: int = 2_000_000):
        self.schema = pa.schema([(name, _ARROW[kind]) for name, kind in map(str.split, ddl.split(", "))])
        self.most_rows, self.most_chars = most_rows, most_chars
        self.rows: list[dict] = []
        self.chars = 0

    def add(self, row: dict, chars: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if len(self.rows) >= self.most_rows or self.chars >= self.most_chars:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        made = pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
        self.rows, self.chars = [], 0
        return made


def _result(conv_id, counts: tuple, cost: int, audit: str, digest) -> dict:
    return dict(zip(["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal"], [conv_id, *counts])) | {"cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest()}


def _whole(conv_id, s: Stretch) -> dict:
    codes = "".join(s.codes)
    cost, audit = solve(codes)
    digest = hashlib.sha256("\n".join(repaired(audit, 0, codes, s.roles, s.texts)).encode())
    return _result(conv_id, _together([(s.facts(), s.roles[0][:1] if s.roles else "", s.roles[-1][:1] if s.roles else "")]), cost, audit, digest) | {"kind": _WHOLE}


def _pieces(conv_id, place: int, part: int, s: Stretch) -> list[dict]:
    """The tables of a stretch, and its texts."""
    codes = "".join(s.codes)
    found = [search(codes, q, frozenset({to})) for q in STATES for to in STATES]
    key = {"conv_id": conv_id, "place": place, "part": part}
    initials = [s.roles[0][:1], s.roles[-1][:1]] if s.roles else ["", ""]
    return [
        key | {"kind": _TABLE, "facts": s.facts(), "initials": initials, "costs": [x and x[0] for x in found], "audits": [x and x[1] for x in found]},
        key | {"kind": _TEXT, "codes": codes, "roles": s.roles, "texts": s.texts},
    ]


def _solve_runs(segment_rows: int):
    """Sorted rows of a range: whole conversations that end inside it, pieces of the others."""

    def work(batches):
        from pyspark import TaskContext

        place = TaskContext.get().partitionId()
        out = _Out(f"{RESULT}, {_PIECE}")
        begun, edge, conv_id, part, s, size = False, True, None, 0, Stretch(), 0

        def close(last: bool):
            """The stretch at hand as a whole conversation, or as a piece at an edge of the range or of a long one."""
            chars = sum(map(len, s.texts))
            for row in _pieces(conv_id, place, part, s) if edge or part or last else [_whole(conv_id, s)]:
                yield from out.add(row, chars if row["kind"] == _TEXT else 0)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "times", "first")]
            for conv, turn, role, text, fault, times, first in zip(*columns):
                if begun and conv != conv_id:
                    yield from close(False)
                    edge, part, s, size = False, 0, Stretch(), 0
                begun, conv_id = True, conv
                while times > 0:
                    if len(s.codes) >= segment_rows or size > 4_000_000:
                        for row in _pieces(conv_id, place, part, s):
                            yield from out.add(row, size)
                        part, s, size = part + 1, Stretch(), 0
                    now = min(times, segment_rows - len(s.codes))
                    s.add(turn, role, text, fault, now, first)
                    times, first, size = times - now, False, size + len(text) * now
        if begun:
            yield from close(True)
        yield out.batch()

    return work


def _join_pieces(batches):
    """Pieces sorted by conversation, kind and place: tables first, then the texts as a stream."""
    out = _Out(RESULT)
    begun, conv_id, tables, facts, chosen, at, digest, any_line = False, None, [], [], None, 0, hashlib.sha256(), False

    def done():
        cost, way = chosen or chain(tables)
        yield from out.add(_result(conv_id, _together(facts), cost, "".join(a for _, a in way), digest))

    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("conv_id", "kind")}
            if begun and row["conv_id"] != conv_id:
                yield from done()
                tables, facts, chosen, at, digest, any_line = [], [], None, 0, hashlib.sha256(), False
            begun, conv_id = True, row["conv_id"]
            if row["kind"] == _TABLE:
                initials = batch.column("initials")[i].as_py()
                tables.append((batch.column("costs")[i].as_py(), batch.column("audits")[i].as_py()))
                facts.append((batch.column("facts")[i].as_py(), *initials))
                continue
            chosen = chosen or chain(tables)
            state, audit = chosen[1][at]
            at += 1
            for line in repaired(audit, state, batch.column("codes")[i].as_py(), batch.column("roles")[i].as_py(), batch.column("texts")[i].as_py()):
                digest.update((("\n" if any_line else "") + line).encode())
                any_line = True
    if begun:
        yield from done()
    yield out.batch()


_SPACE = r" \t\n\x0B\f\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times: rows by crc32 of `conv_id:turn` dropped, emptied, without ends, repeated, or of role user.

    A dropped row leaves a row of times 0, which only tells that its conversation is there.
    """
    c = conversations
    text_of = lambda column: F.coalesce(column.cast("string"), F.lit(" "))
    k = F.crc32(F.concat(text_of(c["conv_id"]), F.lit(":"), text_of(c["turn"])).cast("binary")) % 20
    rows = c.select(c["conv_id"].cast("long").alias("conv_id"), c["turn"].cast("long").alias("turn"), text_of(c["role"]).alias("role"), text_of(c["text"]).alias("text"), k.alias("k"))
    hit = lambda n: F.col("k") == n
    return rows.select(
        "conv_id", F.when(~hit(0), F.col("turn")).alias("turn"), F.when(hit(0), "").when(hit(4), "user").otherwise(F.col("role")).alias("role"),
        F.when(hit(0) | hit(1), "").when(hit(2), F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(hit(0), 0).when(hit(3), 2).otherwise(1).alias("times"),
    )


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """gaps, faults, cost, audit and digest of each conversation of conv_id, turn, role, text, times."""
    same = ["conv_id", "role", "digest"]
    other = [F.col(c).alias(f"same_{c}") for c in same]
    equal = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times")).withColumn("digest", F.sha2("text", 256))
    again = equal.where("times > 0").groupBy(*other).agg(F.count("*").alias("turns"), F.min("turn").alias("earliest"), F.bool_or(F.col("turn").isNull()).alias("before_all")).where("turns > 1")
    keys = [F.col(c).eqNullSafe(F.col(f"same_{c}")) for c in same]
    first = F.coalesce(F.when(F.col("before_all"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("earliest")), F.lit(False))
    fault = F.when(~F.col("text").rlike(f"[^{_SPACE}]"), "b").when(~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z"), "t").otherwise("o")
    told = equal.join(again, keys, "left").select("conv_id", "turn", "role", "text", fault.alias("fault"), "times", F.when(F.col("turns").isNull(), True).otherwise(first).alias("first"))
    order = ["conv_id", "turn", "role", "text"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = told.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in ["conv_id", "turn", "role"]]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    solved = shared(dealt.mapInArrow(_solve_runs(segment_rows), f"{RESULT}, {_PIECE}"))
    names = [x.split()[0] for x in RESULT.split(", ")]
    pieces = solved.where(F.col("kind") != _WHOLE).repartition(parts, "conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", "place", "part")
    return solved.where(F.col("kind") == _WHOLE).select(*names).union(pieces.mapInArrow(_join_pieces, RESULT))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))
