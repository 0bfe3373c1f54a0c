"""Benchmark decontamination by a broadcast hash set of n-grams (operator 10).

Words are maximal runs of ASCII letters, digits and code points from U+0080,
with A-Z lower-cased. A window is ``n`` consecutive words of a benchmark item;
an item with fewer words, but at least one, is one window. Every word of a
document inside an occurrence of a window is hit.

Method: the distinct windows of the benchmark are broadcast to the executors as
a hash set, behind a check of their number; one pass over the documents rolls a
hash along the words, and every hash hit is verified word by word. Documents
are never shuffled. A benchmark beyond the bound takes the other way, exact as
well: window digests of documents and benchmark meet in a shuffle join.

Defined cases: a null or wordless text has no words and is clean; null texts in
the benchmark have no windows; an item without an id still hits words but is
not listed; repeated items and ids count once; an empty benchmark hits nothing.
Repeated document rows are scanned one by one, each gives a row.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavefold.llm.common import drop_worker_state, id_text, rows_of, slices, stored

#: Largest number of distinct windows, each counted for every item listed with it, that is broadcast (some 100 bytes each).
MAX_BROADCAST_WINDOWS = 1_000_000
#: Words scanned at once in a task; bounds the arrays, not the texts.
SCAN_WORDS = 1_000_000

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

SCAN_SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def _windows(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    if len(words) < n:
        return {tuple(words)}
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def benchmark_windows(bench: DataFrame, n: int = 10, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows with each item that holds them: ``(window, item)``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for items, texts in rows_of(batches, "item", "text"):
            pairs = [(b" ".join(w), i) for i, t in zip(items, texts) for w in _windows(words_of(t), n)]
            yield pa.RecordBatch.from_pydict(
                {"window": pa.array([w.decode() for w, _ in pairs], pa.string()),
                 "item": pa.array([i for _, i in pairs], pa.string())})

    rows = bench.select(bench[item_col].cast("string").alias("item"), bench[text_col].cast("string").alias("text"))
    return rows.mapInArrow(cut, "window string, item string").distinct()


def _listed(pairs: DataFrame) -> DataFrame:
    """``(window, items)``; items without an id are not listed."""
    return pairs.groupBy("window").agg(F.collect_set("item").alias("items"))


class WindowSet:
    """The benchmark's windows as a hash set over word numbers; 0 is any other word."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.word_no: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = {}
        for text, items in windows:
            key = tuple(self.word_no.setdefault(w, len(self.word_no) + 1) for w in text.encode().split(b" "))
            self.items[key] = items
        self.hashes = {}
        for length, keys in itertools.groupby(sorted(self.items, key=len), key=len):
            self.hashes[length] = np.unique(_rolled(np.array(list(keys), np.uint64).reshape(-1, length)))

    def occurrences(self, numbers: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
        """(start, length, items) of every window in a sequence of word numbers."""
        known = np.concatenate(([0], np.cumsum(numbers > 0)))
        for length, hashes in self.hashes.items():
            if len(numbers) < length:
                continue
            starts = np.flatnonzero(known[length:] - known[:-length] == length)
            for block in range(0, len(starts), SCAN_WORDS):
                at = starts[block:block + SCAN_WORDS]
                rolled = _rolled(numbers[at[:, None] + np.arange(length)])
                near = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
                for i in at[hashes[near] == rolled].tolist():
                    items = self.items.get(tuple(numbers[i:i + length].tolist()))
                    if items is not None:
                        yield i, length, items


def _rolled(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        out = out * _MULTIPLIER + rows[:, k].astype(np.uint64)
    return out


def _merged(covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(covered):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(found: WindowSet, ids: list, texts: list[str]) -> Iterator[dict]:
    """Rows of SCAN_SCHEMA for a few documents scanned as one sequence, 0 between them."""
    words = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths + 1)
    get = found.word_no.get
    numbers = np.fromiter(
        itertools.chain.from_iterable(itertools.chain(map(get, w, itertools.repeat(0)), (0,)) for w in words),
        np.int64, int(ends[-1]) if len(ends) else 0)
    hits: dict[int, tuple[list, set]] = {}
    for start, length, items in found.occurrences(numbers):
        k = int(np.searchsorted(ends, start, side="right"))
        first = start - int(ends[k]) + int(lengths[k]) + 1
        covered, names = hits.setdefault(k, ([], set()))
        covered.append((first, first + length))
        names.update(items)
    for k, doc_id in enumerate(ids):
        covered, names = hits.get(k, ((), ()))
        spans = _merged(list(covered))
        yield {"doc_id": doc_id, "n_words": int(lengths[k]), "n_hit": sum(e - s for s, e in spans),
               "items": sorted(names), "spans": [{"start": s, "end": e} for s, e in spans]}


def scan(docs: DataFrame, bench: DataFrame, *, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", bench_text_col: str = "text",
         max_broadcast_windows: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """Per document row: words, hit words, items (sorted strings) and hit spans in words."""
    pairs = benchmark_windows(bench, n, item_col, bench_text_col)
    windows = _listed(pairs)
    rows = id_text(docs, id_col, text_col)
    # the bound is checked on the number, items included, before anything is brought to the driver
    if pairs.limit(max_broadcast_windows + 1).count() > max_broadcast_windows:
        # stored: fixes the row numbers for all readers
        keyed = stored(rows.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
        return _scan_by_join(keyed, windows).drop("row")
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast([(r.window, list(r["items"])) for r in windows.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        found = WindowSet(held.value)
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                            ("items", pa.list_(pa.string())),
                            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        for ids, texts in rows_of(batches, "doc_id", "text"):
            start, size, out = 0, 0, []
            for k, t in enumerate(texts):
                size += len(t) // 2
                if size > SCAN_WORDS:
                    out += _scan(found, ids[start:k + 1], texts[start:k + 1])
                    start, size = k + 1, 0
            out += _scan(found, ids[start:], texts[start:])
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.mapInArrow(run, SCAN_SCHEMA)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _scan_by_join(keyed: DataFrame, windows: DataFrame) -> DataFrame:
    """The way for a benchmark too large to broadcast: 128-bit window digests meet in a join.

    ``keyed`` is stored and has ``(row, doc_id, text)``; ``row`` tells rows apart and stays beside the result.
    """
    lengths = [r[0] for r in windows.select(F.size(F.split("window", " ")).alias("k")).distinct().collect()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "row", "text"):
            for i, t in zip(ids, texts):
                w = words_of(t)
                for k in lengths:
                    at = range(len(w) - k + 1)
                    yield pa.RecordBatch.from_pydict({
                        "row": pa.array([i] * len(at), pa.int64()), "start": pa.array(at, pa.int64()),
                        "len": pa.array([k] * len(at), pa.int64()),
                        "digest": pa.array([_digest(w[p:p + k]) for p in at], pa.binary())})

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, items in rows_of(batches, "window", "items"):
            yield pa.RecordBatch.from_pydict({
                "digest": pa.array([_digest(t.encode().split(b" ")) for t in texts], pa.binary()),
                "items": pa.array(items, pa.list_(pa.string()))})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, docs, texts in rows_of(batches, "row", "doc_id", "text"):
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(ids, pa.int64()), "doc_id": pa.array(docs, pa.int64()),
                "n_words": pa.array([len(words_of(t)) for t in texts], pa.int64())})

    hits = (keyed.mapInArrow(cut, "row long, start long, len long, digest binary")
            .join(windows.mapInArrow(key, "digest binary, items array<string>"), "digest")
            .groupBy("row").agg(F.collect_set(F.struct("start", "len")).alias("at"),
                                F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, docs, n_words, at, items in rows_of(batches, "row", "doc_id", "n_words", "at", "items"):
            spans = [_merged([(x["start"], x["start"] + x["len"]) for x in a or ()]) for a in at]
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(ids, pa.int64()), "doc_id": pa.array(docs, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array([sum(e - s for s, e in x) for x in spans], pa.int64()),
                "items": pa.array([sorted(x or ()) for x in items], pa.list_(pa.string())),
                "spans": pa.array([[{"start": s, "end": e} for s, e in x] for x in spans],
                                  pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    counted = keyed.mapInArrow(count, "row long, doc_id long, n_words long")
    return counted.join(hits, "row", "left").mapInArrow(fold, f"row long, {SCAN_SCHEMA}")


def remove_spans_from(text: str | None, spans: list) -> str | None:
    """The text without the words of the given word spans and what lies between them."""
    if not spans:
        return text
    raw = text.encode()
    at = [m.span() for m in WORD.finditer(raw.lower())]
    out, end = [], 0
    for s in spans:
        out.append(raw[end:at[s["start"]][0]])
        end = at[s["end"] - 1][1]
    return b"".join([*out, raw[end:]]).decode()


def decontaminate(docs: DataFrame, bench: DataFrame, *, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", bench_text_col: str = "text", mode: str = "documents",
                  max_broadcast_windows: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """``docs`` without contamination, same columns.

    ``mode="documents"`` drops every document with a hit word; ``mode="spans"``
    keeps all documents and cuts the hit words out of their texts. Every row is
    judged by its own text, also where ids are null or repeated.
    """
    if mode not in ("documents", "spans"):
        raise ValueError("mode is 'documents' or 'spans'")
    # the verdict needs no items
    windows = benchmark_windows(bench, n, item_col, bench_text_col).select("window").distinct()
    if windows.limit(max_broadcast_windows + 1).count() > max_broadcast_windows:
        kept = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "decontaminate")
        keyed = id_text(kept, id_col, text_col, F.col("__row").alias("row"))
        spans = _scan_by_join(keyed, windows.withColumn("items", F.array().cast("array<string>"))).filter("n_hit > 0")
        bad = spans.select(F.col("row").alias("__at"), F.col("spans").alias("__spans"))
        same = F.col("__row") == F.col("__at")
        if mode == "documents":
            return kept.join(bad, same, "left_anti").drop("__row")
        rows = kept.join(bad, same, "left").drop("__row", "__at")

        def cut_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k, s = batch.schema.get_field_index(text_col), batch.schema.get_field_index("__spans")
                new = [remove_spans_from(t, x) for t, x in zip(batch.column(k).to_pylist(), batch.column(s).to_pylist())]
                batch = batch.set_column(k, text_col, pa.array(new, pa.string()))
                yield batch.select([c for c in batch.schema.names if c != "__spans"])

        return rows.mapInArrow(cut_known, docs.schema)
    held = docs.sparkSession.sparkContext.broadcast([(r.window, []) for r in windows.collect()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        found = WindowSet(held.value)
        for batch in slices(batches):
            k = batch.schema.get_field_index(text_col)
            texts = batch.column(k).to_pylist()
            spans = [next(_scan(found, [0], [t or ""]))["spans"] for t in texts]
            if mode == "documents":
                yield batch.filter(pa.array([not x for x in spans], pa.bool_()))
            else:
                new = [remove_spans_from(t, x) for t, x in zip(texts, spans)]
                yield batch.set_column(k, text_col, pa.array(new, pa.string()))

    return docs.mapInArrow(cut, docs.schema)
