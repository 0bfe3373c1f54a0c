import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from wavefold.llm import dac, queries

SF001 = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(rows):
    tk, start, out = Tokenizer.from_file(PATH), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("n,top", [(1, 256), (5, 1 << 32), (511, 300), (512, 1 << 17), (1024, 256), (5000, 1 << 32), (40_000, 50_000)])
def test_codes_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    codes = dac.Codes(dac.pack(ids))
    assert len(codes) == n and (codes.slice(0, n) == ids).all()
    for i in rng.integers(0, n, 60).tolist():
        assert codes.get(i) == ids[i]
        j = int(rng.integers(i, n + 1))
        assert (codes.slice(i, j) == ids[i:j]).all()
    with pytest.raises(IndexError):
        codes.get(n)


def test_no_ids():
    codes = dac.Codes(dac.pack(np.array([], np.uint32)))
    assert len(codes) == 0 and len(codes.slice(0, 0)) == 0


def test_query_equals_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in queries.op3_token_codes(spark, SF001).collect()]
    assert sorted(got) == plain(rows)


def test_words_are_independent():
    tk, enc = Tokenizer.from_file(PATH), dac.WordEncoder(PATH)
    for t in ["", "á ́b", "It's they'RE\x1cx <|endoftext|>y<|startoftext|> Σας ΟΔΟΣ İI ǅ", "x\x0by\x0cz\r\n  12345 ½ 日本語 🙂!?",
              "a b　c\u0085d", "ﬁ ﷺ ẛ̣ éé '' 's'll"]:
        assert enc.encode([t])[0].tolist() == tk.encode(t, add_special_tokens=False).ids


def test_edges_and_random_access(spark, tmp_path):
    rows = [(None, "null id"), (3, None), (1, ""), (2, "b b"), (2, "a a"), (2, "a a"), (7, "long words here " * 20_000), (5, "tail")]
    df = spark.createDataFrame([Row(doc_id=d, text=t, start=9, part="clash") for d, t in rows])
    out = str(tmp_path / "codes")
    dac.write(df, PATH, out, segment_tokens=1000)
    found = dac.read(spark, out)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in dac.documents(found, digest_only=True).collect()]
    assert sorted(got, key=lambda r: r[1]) == plain(rows)
    flat = [i for r in sorted(dac.documents(found).collect(), key=lambda r: r.start) for i in r.ids]
    asked = [0, 1, 5, 30_000, len(flat) - 1, len(flat), -1, None]
    answer = {r.position: r.token for r in dac.tokens_at(found, spark.createDataFrame([(p,) for p in asked], "position long")).collect()}
    assert answer == {p: flat[p] for p in asked[:5]}


def test_empty_table(spark, tmp_path):
    out = str(tmp_path / "codes")
    dac.write(spark.createDataFrame([], "doc_id long, text string"), PATH, out)
    assert dac.documents(dac.read(spark, out)).collect() == []
