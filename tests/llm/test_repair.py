"""Conversation repair against a plain dynamic programme over whole conversations."""

import hashlib
import itertools
import random
import zlib

import pytest

from posetables.llm import repair as r

SPACE = " \t\n\x0b\x0c\r"
NAMES = {0: "user", 1: "user", 2: "assistant", 3: "user"}
AFTER = {0: 2, 1: 2, 2: 3, 3: 2}
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else text.translate({ord(c): None for c in ".!?"}) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def brute_best(rows):
    """rows: (role, text, must_go, truncated); least (cost, audit, lines) by relaxing all nodes row by row."""
    now = {0: (0, "", ())}
    for role, text, must_go, cut in rows:
        now = inserted(now)
        then = {}
        for q, (cost, audit, lines) in now.items():
            options = [(q, (cost + 2, audit + "D", lines))]
            if not must_go:
                more = 5 * cut
                if (q, role[:1]) in KEEP:
                    options.append((KEEP[q, role[:1]], (cost + more, audit + "K", (*lines, f"{role}:{text}"))))
                options.append((AFTER[q], (cost + 1 + more, audit + "R", (*lines, f"{NAMES[q]}:{text}"))))
            for to, found in options:
                if to not in then or found < then[to]:
                    then[to] = found
        now = then
    now = inserted(now)
    return min(now[q] for q in (0, 3) if q in now)


def inserted(now):
    for _ in range(4):
        for q, (cost, audit, lines) in list(now.items()):
            found = (cost + 5, audit + "I", (*lines, f"{NAMES[q]}:"))
            if AFTER[q] not in now or found < now[AFTER[q]]:
                now[AFTER[q]] = found
    return now


def brute(rows):
    """Every conversation's row, by plain loops."""
    out = {}
    for conv in {x[0] for x in rows}:
        own = sorted(brute_damage([x for x in rows if x[0] == conv]), key=lambda x: (x[1] is not None, x[1] or 0, x[2], x[3]))
        turns = [x[1] for x in own if x[1] is not None]
        seen, faults, marked = set(), [], []
        for _, _, role, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit, lines = brute_best(marked)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def ours(df, **kw):
    rows = r.repair(r.damaged(df), **kw).collect()
    assert len({x.conv_id for x in rows}) == len(rows)
    return {x.conv_id: tuple(x)[1:] for x in rows}


def test_search_is_optimal_on_all_short_patterns():
    faults = {"u": ("u", False, False), "a": ("a", False, False), "s": ("s", False, False), "x": ("u", True, False), "U": ("u", False, True), "A": ("a", False, True), "o": ("o", False, False)}
    for n in range(5):
        for codes in itertools.product(faults, repeat=n):
            want = brute_best([(faults[c][0], "t", *faults[c][1:]) for c in codes])
            assert r.search("".join(codes)) == want[:2], codes


def test_long_patterns_and_chains_of_stretches():
    rng = random.Random(5)
    for n in (40, 150, 400):
        codes = "".join(rng.choices("uasxUASoO", k=n))
        want = brute_best([({"x": "u"}.get(c, c.lower()), "t", c == "x", c.isupper()) for c in codes])[:2]
        assert r.search(codes) == want
        tables = []
        for a in range(0, n, 17):
            found = [r.search(codes[a : a + 17], q, frozenset({to})) for q in r.STATES for to in r.STATES]
            tables.append(([x and x[0] for x in found], [x and x[1] for x in found]))
        cost, way = r.chain(tables)
        assert (cost, "".join(x for _, x in way)) == want


@pytest.mark.parametrize("segment_rows", [3, 1024])
def test_given_conversations(spark, segment_rows):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert ours(df, segment_rows=segment_rows) == brute([tuple(x) for x in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("segment_rows", [2, 50, 1024])
def test_awkward_rows(spark, segment_rows):
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(40), *[7] * 30]:
        for turn in range(rng.randrange(6)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 5]), rng.choice(["user", "assistant", "system", "tool", "", None, "user"]), rng.choice(["Hi.", "Hi", "", None, " \t", "é?\n", "Well ... no", "A\nb!"])))
    rows += [(99, 3, "user", "Same.")] * 40 + [(98, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(300)]
    rows += [(97, t, "user", "Again and again.") for t in range(120)]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema)
    assert ours(df.selectExpr("*", "1 as kind", "'x' as digest", "2 as times"), segment_rows=segment_rows) == brute(rows)
    assert ours(spark.createDataFrame([], schema)) == {}


def test_dropped_conversations_stay(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = ours(spark.createDataFrame([(conv, 0, "user", "Hello.")], "conv_id long, turn long, role string, text string"))
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
