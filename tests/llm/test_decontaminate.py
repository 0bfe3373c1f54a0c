import hashlib
import re

import pytest
from pyspark.sql import Row

from wavefold.llm import decontaminate, queries

SF001 = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, bench, n=10):
    out = []
    windows = []
    for item, text in bench:
        w = words(text)
        k = min(n, len(w))
        windows += [(item, w[i:i + k]) for i in range(len(w) - k + 1)] if w else []
    for d, text in docs:
        w, hit, items = words(text), set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    if item is not None:
                        items.add(str(item))
        out.append((d, len(w), len(hit), sorted(items)))
    return sorted(out, key=repr)


def collected(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=repr)


BENCH = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item, here!"), (10, "short ITEM here"),
         (3, None), (4, " .,;"), (None, "an item without any id"), (5, "straße é日本 x"), (2, "Short item, here!"),
         (6, "a a a a a a a a a a a a"), (7, "one")]
DOCS = [(1, "x ONE two-three four five six seven eight nine (ten) y"), (2, "one two three four five six seven eight nine"),
        (3, "short item. Here; and short item here"), (4, None), (5, ""), (6, "An item without any ID"), (None, "STRAßE É日本 x"), (7, "straße é日本 x"),
        (8, "b " + "a " * 40 + "b"), (8, "b " + "a " * 40 + "b"), (9, "word " * 30_000 + "short item here"), (11, "!!!")]


@pytest.mark.parametrize("bound", [decontaminate.MAX_BROADCAST_WINDOWS, 3])
def test_scan_equals_brute_force_both_ways(spark, bound):
    docs = spark.createDataFrame([Row(doc_id=d, text=t, items="clash", row=1) for d, t in DOCS])
    bench = spark.createDataFrame([Row(item_id=i, text=t, window="clash") for i, t in BENCH], "item_id long, text string, window string")
    assert collected(decontaminate.scan(docs, bench, max_broadcast_windows=bound)) == plain(DOCS, BENCH)
    clean = {repr(d) for d, _, hit, _ in plain(DOCS, BENCH) if not hit}
    kept = decontaminate.decontaminate(docs, bench, max_broadcast_windows=bound)
    assert kept.columns == docs.columns and {repr(r.doc_id) for r in kept.collect()} == clean
    cut = decontaminate.decontaminate(docs, bench, mode="spans", max_broadcast_windows=bound)
    texts = [(r.doc_id, r.text) for r in cut.collect()]
    assert cut.columns == docs.columns and len(texts) == len(DOCS)
    assert sum(len(words(t)) for _, t in texts) == sum(n - hit for _, n, hit, _ in plain(DOCS, BENCH))


def test_remove_spans_keeps_the_rest():
    assert decontaminate.remove_spans_from("Keep, this (drop that) end.", [{"start": 2, "end": 4}]) == "Keep, this () end."


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(60).collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in queries.op10_decontaminate(spark, SF001).collect()}
    for d, n, hit, items in plain(docs, bench):
        r = got[d]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(items), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(items).encode()).hexdigest()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, item_id long")
    some = spark.createDataFrame([Row(doc_id=1, text="some words", item_id=1)])
    assert decontaminate.scan(none, some).collect() == []
    assert collected(decontaminate.scan(some, none)) == [(1, 2, 0, [])]


REPEATED = [(None, "short item here"), (None, "clean words only"), (None, None), (1, "say short item here now"), (1, "a clean text"),
            (1, "short item here"), (2, "x short item here y an item without any id"), (2, "x")]


@pytest.mark.parametrize("bound", [decontaminate.MAX_BROADCAST_WINDOWS, 3])
def test_rows_are_judged_by_their_own_text(spark, bound):
    docs = spark.createDataFrame(REPEATED, "doc_id long, text string")
    bench = spark.createDataFrame(BENCH[:-1], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, bench, max_broadcast_windows=bound)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(None, "clean words only"), (None, None), (1, "a clean text"), (2, "x")], key=repr)
    cut = decontaminate.decontaminate(docs, bench, mode="spans", max_broadcast_windows=bound)
    assert sorted(((r.doc_id, r.text and r.text.split()) for r in cut.collect()), key=repr) == sorted(
        [(None, ""), (None, ["clean", "words", "only"]), (None, None), (1, ["say", "now"]), (1, ["a", "clean", "text"]), (1, ""),
         (2, ["x", "y"]), (2, ["x"])], key=repr)


def test_bound_counts_the_items_of_a_window(spark, monkeypatch):
    ways = []
    by_join = decontaminate._scan_by_join
    monkeypatch.setattr(decontaminate, "_scan_by_join", lambda *a: ways.append(1) or by_join(*a))
    docs = spark.createDataFrame([(1, "a common passage here")], "doc_id long, text string")
    bench = [(i, "common passage") for i in range(20)]
    df = spark.createDataFrame(bench, "item_id long, text string")
    for bound, joins in ((20, 0), (19, 1)):
        assert collected(decontaminate.scan(docs, df, max_broadcast_windows=bound)) == plain([(1, "a common passage here")], bench)
        assert len(ways) == joins
