from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from framelake.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def real():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def auto():
    return bpe.unpacked(bpe.packed(PATH))


def ids(text):
    return np.frombuffer(auto().encode(text), "<u4").tolist()


def same(real, text):
    want = real.encode(text, add_special_tokens=False).ids
    assert ids(text) == want, text
    assert auto().decode(auto().encode(text)) == real.decode(want, skip_special_tokens=False)


TRICKY = ["", " ", "aaa aaaa aaaaaaaaaaaaaaa", "don't I'LL we'Ve", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "ΑΣ ΣΑΣ İ", "\x1c a\x1db \x85 \xa0y", "éà Å ﬁ é", "日本語 12345 ½ ²", "😀😀!!!...??", "á́ K Ω", "x" * 5000, "ab" * 3000]


@pytest.mark.parametrize("text", TRICKY)
def test_tricky(real, text):
    same(real, text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcdefghinorstz' .,1é<|>", max_size=60))
def test_random(real, text):
    same(real, text)


def test_all_code_points(real):
    """Alone, between letters and after a mark: also what Python's Unicode tables do not assign."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x32000 or c % 997 == 0 or 0xE0000 <= c < 0xE0200)]
    for i in range(0, len(points), 500):
        for form in ("{}", "a{}b!{}1") if i % 5000 else ("{}", "a{}b", "!{}1", "e\u0301{}"):
            texts = [form.replace("{}", c) for c in points[i : i + 500]]
            want = [e.ids for e in real.encode_batch(texts, add_special_tokens=False)]
            for t, w in zip(texts, want):
                assert ids(t) == w, (t, [hex(ord(c)) for c in t])


def test_documents(real, spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        same(real, r["text"])


def naive(word, merges, suffix):
    parts = [*word[:-1], word[-1] + suffix]
    for a, b in merges:
        i, out = 0, []
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == (a, b):
                out.append(a + b)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


def test_small_automata_by_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        tokens = ["a", "b", "c", "a$", "b$", "c$"]
        merges = []
        while len(merges) < 12:
            u, v = rng.choice([t for t in tokens if t[-1] != "$"]), rng.choice(tokens)
            if u + v not in tokens and len(u + v) < 8:
                merges.append((u, v))
                tokens.append(u + v)
        vocab = {t: i for i, t in enumerate(tokens)}
        a = bpe.compile_merges(vocab, merges, "$", "[abc]+", {})
        for _ in range(80):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 10)))
            assert [tokens[i] for i in a.encode_word(word)] == naive(word, merges, "$"), (word, merges)


def test_columns(spark, real):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "the cat"), (3, "the cat")], "doc_id long, text string").selectExpr("*", "'x' as ids_sha256")
    back = bpe.decode(bpe.encode(df, PATH), PATH).orderBy("doc_id").collect()
    assert [list(r["ids"]) for r in back] == [[], [], real.encode("the cat", add_special_tokens=False).ids] + [ids("the cat")]
    got = bpe.digests(df, PATH).orderBy("doc_id").collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert (got[0]["n_tokens"], got[0]["ids_sha256"], got[1]["decoded_sha256"]) == (0, empty, empty) and got[2] == got[3]
    assert bpe.digests(df.limit(0), PATH).isEmpty()


def test_query_by_library(spark, real):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in queries.op4_bpe(spark, "/root/testdata/sf0.001").collect():
        want = real.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(want) and r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(real.decode(want, skip_special_tokens=False).encode()).hexdigest()
