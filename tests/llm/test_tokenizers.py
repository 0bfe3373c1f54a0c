"""Prefix counts (operator 1) and the byte-level transducer (operator 9) against the libraries."""

import hashlib
import random
import time

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import Row
from tokenizers import Tokenizer

from wavefold.llm import byte_bpe, prefix_counts, queries

SF001 = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["a", "b", "the", "ation", "ing", " ", "  ", "\n", "'re", "'", "r", "l", "'ll", "s", "é", "日", "🙂", "1", "23", "!!", "...", "-----", "<|endoftext|>",
         "\t", " ", "\u0085", "\x1c", "　", "Ü", "٣", "aaaa", "    "]


@pytest.fixture(scope="module")
def counter():
    return prefix_counts.PrefixCounter(JSON)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Coder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def encoding(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.encoder.ranks, special_tokens={})


def made(seed, n):
    r = random.Random(seed)
    return ["".join(r.choices(PARTS, k=r.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("part", ["'", " ", "\n", "' ", "'s", "a", "-"])
def test_long_runs_take_time_in_proportion_to_their_length(counter, library, part):
    began = time.monotonic()
    for text in (part * 300_000, part * 300_000 + "x"):
        assert counter.counts(text)[-1] == len(library.encode(text, add_special_tokens=False).ids)
    assert time.monotonic() - began < 60  # quadratic ways take hours


def test_every_prefix_count_is_the_librarys(counter, library):
    for text in made(1, 600):
        want = [len(library.encode(text[:p], add_special_tokens=False).ids) for p in range(len(text) + 1)]
        assert counter.counts(text).tolist() == want


def test_token_counts_query(spark, library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op1_token_counts(spark, SF001).collect()}
    assert len(got) == len(docs)
    for d in docs:
        n, r = len(library.encode(d.text, add_special_tokens=False).ids), got[d.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(d.text.encode()), n, n > 512)
        assert len(library.encode(d.text[:r.chars_within_limit], add_special_tokens=False).ids) <= 512


def test_table_answers_without_the_text(spark, library):
    texts = [(1, "Some words that're counted,  twice.\n\nAnd more é日🙂"), (2, ""), (3, None), (None, "null id"), (4, "x" * 30_000), (5, " " * 5000), (5, " " * 5000)]
    df = spark.createDataFrame([Row(doc_id=d, text=t, steps="clash", n_tokens=0) for d, t in texts])
    kept = prefix_counts.token_counts(df, JSON, limits=(3,), keep_table=True)
    rows = kept.collect()
    assert len(rows) == len(texts) and {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    asked = spark.createDataFrame([(1, p) for p in (0, 4, 17, 18, 19, 999)] + [(2, 5), (3, None), (9, 1)], "doc_id long, position long")
    answers = {(r.doc_id, r.position): r.n_tokens for r in prefix_counts.counts_at(kept, asked).collect()}
    for p in (0, 4, 17, 18, 19, 999):
        assert answers[1, p] == len(library.encode(texts[0][1][:p], add_special_tokens=False).ids)
    assert answers[2, 5] == 0 and answers[3, None] == 0 and (9, 1) not in answers
    assert prefix_counts.token_counts(df.limit(0), JSON).collect() == []


def test_small_memory_changes_nothing(counter, monkeypatch):
    texts = made(3, 50)
    small = prefix_counts.PrefixCounter(JSON)
    small.memo.half, small.pairs.size = 2, 5
    assert all((small.counts(t) == counter.counts(t)).all() for t in texts)


def test_transducer_is_tiktoken(coder, encoding):
    for text in made(2, 4000):
        assert coder.encoder.encode(text) == encoding.encode_ordinary(text)
    r = random.Random(4)
    for text in ["a" * 5000, " " * 3000 + "=" * 4000, "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=20_000))]:
        assert coder.encoder.encode(text) == encoding.encode_ordinary(text)


def test_full_table_and_streaming_change_nothing(encoding, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_ARROWS", 50)
    small = byte_bpe.Coder(RANKS, public_tokenizers.PATTERN)
    small.encoder.memo.half = 3
    for text in made(5, 500):
        assert small.encoder.encode(text) == encoding.encode_ordinary(text)
    piece = b"internationalisation"
    out, read = [], 0

    def feed():
        nonlocal read
        for b in piece:
            read += 1
            yield b

    for token in small.encoder.transducer.stream(feed()):
        out.append((token, read))
    assert [t for t, _ in out] == list(small.encoder.transducer.encode(piece))
    assert out[0][1] < len(piece)  # the first token is known before the end


def test_streaming_decoder():
    raw = "aé日🙂z".encode() + b"\xff" + "ü".encode() + b"\xf0\x9f\x99"
    for step in (1, 2, 3, 100):
        s = byte_bpe.Utf8Stream()
        got = "".join(s.feed(raw[k:k + step]) for k in range(0, len(raw), step)) + s.end()
        assert got == raw.decode("utf-8", "replace")


def test_byte_bpe_query_and_odd_rows(spark, encoding):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op9_byte_bpe(spark, SF001).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for d in docs:
        ids = encoding.encode_ordinary(d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()), sha(d.text.encode()))
    df = spark.createDataFrame([Row(doc_id=d, text=t, ids="clash") for d, t in [(1, None), (1, ""), (None, "é"), (2, "é " * 40_000)]])
    encoded = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(encoded, RANKS)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=repr) == sorted([(1, ""), (1, ""), (None, "é"), (2, "é " * 40_000)], key=repr)
    rows = byte_bpe.round_trip(df, RANKS, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert all(r.n_tokens == len(r["ids"]) for r in rows) and np.sum([r.n_tokens for r in rows]) > 40_000
    assert byte_bpe.round_trip(df.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_memory_bounds_all_that_a_coder_remembers(encoding):
    small = byte_bpe.Coder(RANKS, public_tokenizers.PATTERN, 0.0005).encoder
    rng = random.Random(5)
    text = " ".join("".join(rng.choice(PARTS) for _ in range(6)) for _ in range(400))
    assert small.encode(text) == encoding.encode(text, disallowed_special=())
    assert small.transducer.arrows <= 200
    assert len(small.transducer.pairs.known) <= 200
    assert len(small.memo.known) + len(small.memo.older) <= 200
