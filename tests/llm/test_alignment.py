"""Token alignment against plain loops over the tokenizers library and sentencepiece."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from posetables.llm import alignment


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def byte_alphabet():
    """The byte that each character of a byte-level entry stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute(tools, texts):
    a_tool, b_tool = tools
    alphabet = byte_alphabet()
    documents, held, out = [], Counter(), []
    for text in texts:
        groups, ids_a, ids_b = [], [], []
        if text:
            whole = (" " + text).encode()
            ids_a, ids_b = a_tool.encode(" " + text, add_special_tokens=False).ids, b_tool.encode(text)
            bytes_a = [bytes(alphabet[c] for c in a_tool.id_to_token(i)) for i in ids_a]
            bytes_b = [bytes([int(b_tool.id_to_piece(i)[3:5], 16)]) if b_tool.is_byte(i) else b_tool.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
                ids_a = ids_b = []
            else:
                ends = []
                for parts in (bytes_a, bytes_b):
                    at, own = 0, []
                    for x in parts:
                        at += len(x)
                        own.append(at)
                    ends.append(own)
                shared = sorted(set(ends[0]) & set(ends[1]))
                at = 0
                for cut in shared:
                    groups.append(([i for i, e in zip(ids_a, ends[0]) if at < e <= cut], [i for i, e in zip(ids_b, ends[1]) if at < e <= cut]))
                    at = cut
        links = [(x, y) for p, q in groups for x in p for y in q]
        held.update(set(links))
        documents.append((len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    for n_a, n_b, groups, links in documents:
        told = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), hashlib.sha256(told.encode()).hexdigest() if groups else ""))
    return out


AWKWARD = ["", None, " ", "  ", "a", "<|endoftext|> and <s> </s> <0x41>", "café ▁ low line", "日本語のテキスト", "tab\tand\nline\r\n", "\U0001f600\U0001f601 faces", "x" * 700, "aaaa " * 300, "nul\x00byte", "1234567890 " * 40, "​﻿odd", "a", "a"]


def rows_of(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [(r.doc_id, *(r[c] for c in names)) for r in df.collect()]


@pytest.mark.parametrize("hot_pairs,slice_chars", [(1_000_000, 400_000), (40, 300), (0, 10)])
def test_awkward_texts(spark, tools, hot_pairs, slice_chars):
    df = spark.createDataFrame([(i // 2, t, "x") for i, t in enumerate(AWKWARD)], "doc_id long, text string, pairs string")
    want = [(i // 2, *x) for i, x in enumerate(brute(tools, AWKWARD))]
    assert sorted(rows_of(alignment.align(df, hot_pairs=hot_pairs, slice_chars=slice_chars))) == sorted(want)


def test_documents(spark, tools):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.select("doc_id", "text").collect()
    want = sorted((r.doc_id, *x) for r, x in zip(rows, brute(tools, [r.text for r in rows])))
    assert sorted(rows_of(alignment.op12_token_alignment(spark, "/root/testdata/sf0.001"))) == want
    assert sorted(rows_of(alignment.align(df, hot_pairs=2000))) == want


def test_random_characters(spark, tools):
    rng = random.Random(2)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x800), rng.randrange(0x3000, 0xD000), rng.randrange(0x1F300, 0x1F700)])) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(rows_of(alignment.align(df))) == sorted((i, *x) for i, x in enumerate(brute(tools, texts)))


def test_empty_table(spark):
    assert rows_of(alignment.align(spark.createDataFrame([], "doc_id long, text string"))) == []
