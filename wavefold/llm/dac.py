"""Token ids in directly addressable codes (operator 3).

A segment's ids are cut into chunks of 8 bits. Level 0 holds the low chunk of
every id; a continuation bitmap says which ids go on, and level 1 holds the next
chunk of only those, and so on. Each bitmap has a rank directory, the number of
ones before every 512 bits. The chunk of id ``i`` on the next level is at
``rank(i)``, so any token is read in as many steps as it has chunks, without
decoding its neighbours.

Files: a Parquet table with a row per segment, so that Spark's committer writes
it and any store that Spark reads can hold it. A segment has whole documents, in
ascending id order, at least SEGMENT_TOKENS ids unless it ends its part:

    part int        number of the id range
    seq int         number of the segment in its part
    before long     ids of the part before the segment
    n_tokens long   ids in the segment
    doc_ids, ends   per document its id, and the end of its ids in the segment
    payload binary  the codes: b"DAC1", then little-endian u32 number of levels;
                    for each level u64 number of chunks, the chunks, and, on all
                    but the last, the bitmap (bit i of byte j is id 8j + i) and
                    the directory (u32 each)

Method for ``start``: documents are dealt out by ranges of their id and sorted;
a part knows its own offsets, and the sums of the parts (one row for each) give
what lies before it.

Defined cases: a null text is empty and has only the end id; null ids come
first; repeated ids keep all their rows, in the order of their texts; an empty
table writes a table without rows.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavefold.llm.common import Memo, id_text, rows_of, worker_state

MAGIC = b"DAC1"
#: Bits between two entries of a rank directory.
RANK_BITS = 512
#: Ids of a segment, at least.
SEGMENT_TOKENS = 65_536
#: Words that a worker remembers, and characters of text it looks up at once; results don't depend on them.
MEMO_WORDS, LOOK_UP_CHARS = 1_200_000, 1_000_000

SEGMENTS = ("part int, seq int, before long, n_tokens long, doc_ids array<long>, ends array<long>, payload binary")


def pack(ids: np.ndarray) -> bytes:
    """The codes of ids from 0 to 2**32 - 1."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        goes_on = rest > 0xFF
        levels.append((rest & 0xFF, goes_on))
        if not goes_on.any():
            break
        rest = rest[goes_on] >> 8
    out = [MAGIC, struct.pack("<I", len(levels))]
    for k, (chunks, goes_on) in enumerate(levels):
        out += [struct.pack("<Q", len(chunks)), chunks.astype(np.uint8).tobytes()]
        if k < len(levels) - 1:
            full = np.zeros(-(-len(goes_on) // RANK_BITS) * RANK_BITS, bool)
            full[:len(goes_on)] = goes_on
            ones = full.reshape(-1, RANK_BITS).sum(axis=1)
            out += [np.packbits(full, bitorder="little").tobytes(),
                    np.concatenate(([0], np.cumsum(ones)))[:-1].astype("<u4").tobytes()]
    return b"".join(out)


class Codes:
    """Random access to packed ids."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC1 payload")
        (n_levels,), at = struct.unpack_from("<I", payload, 4), 8
        self.levels: list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]] = []
        for k in range(n_levels):
            (n,) = struct.unpack_from("<Q", payload, at)
            chunks = np.frombuffer(payload, np.uint8, n, at + 8)
            at += 8 + n
            bits = directory = None
            if k < n_levels - 1:
                blocks = -(-n // RANK_BITS)
                bits = np.frombuffer(payload, np.uint8, blocks * RANK_BITS // 8, at)
                directory = np.frombuffer(payload, "<u4", blocks, at + len(bits))
                at += len(bits) + 4 * blocks
            self.levels.append((chunks, bits, directory))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bits: np.ndarray, directory: np.ndarray, i: int) -> int:
        """Ones before position ``i``."""
        block, byte = i // RANK_BITS, i // 8
        if block == len(directory):  # the end of a full last block
            block -= 1
        ones = int(directory[block]) + int(np.bitwise_count(bits[block * RANK_BITS // 8:byte]).sum(dtype=np.int64))
        return ones + (int(bits[byte]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else ones

    def get(self, i: int) -> int:
        """Id ``i``: one chunk of each level it reaches."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * k
            if bits is None or not bits[i // 8] >> i % 8 & 1:
                break
            i = self._rank(bits, directory, i)
        return value

    def slice(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` to ``end``: on each level the chunks between two ranks."""
        out = np.zeros(end - start, np.uint32)
        at = np.arange(end - start)
        for k, (chunks, bits, directory) in enumerate(self.levels):
            out[at] |= chunks[start:end].astype(np.uint32) << np.uint32(8 * k)
            if bits is None:
                break
            goes_on = np.unpackbits(bits[start // 8:-(-end // 8)], bitorder="little")[start % 8:][:end - start].astype(bool)
            at = at[goes_on]
            if not len(at):
                break
            start = self._rank(bits, directory, start)
            end = start + len(at)
        return out


#: Fixed value: the split of the word tokenizers that `WordEncoder` can ask piece by piece.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Of a text in lower-case ASCII and Latin letters: what that split never cuts through nor joins.
PIECE = re.compile(r"'?[a-zÀ-ÖØ-įı-ɏ]+|[0-9]|[^\sa-z0-9À-ÖØ-įı-ɏ]+")
#: Anything else, or what may begin a special token (<|): such words are asked for whole.
OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-įı-ɏ]")
PLAIN = bytes([*range(9, 14), *range(32, 127)])
#: Words asked of the library in one text.
ASKED_TOGETHER = 256


class WordEncoder:
    """A tokenizers file; a worker asks the library once for each piece that it does not remember.

    Files whose normalizer and split work on every word alone (lower case,
    WORD_SPLIT, word ends marked) get pieces: the ids of a text are those of its
    pieces laid end to end. Any other file gets whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [(n["type"]) for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        specials = [t["content"] for t in spec["added_tokens"]]
        mark = spec["model"].get("end_of_word_suffix")
        self.by_piece = (kinds == ["NFC", "Replace", "Lowercase"] and splits == [WORD_SPLIT, None] and bool(mark)
                         and all(t.startswith("<|") and not re.search(r"\s", t) for t in specials))
        if self.by_piece:
            vocab = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(mark)]] = True
        self.memo = Memo(MEMO_WORDS)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ask(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pieces. Those that are one word each are asked for together, and parted at the ends of words."""
        one = [p for p in pieces if p.isalpha() and (p.isascii() or not OTHER.search(p))]
        sure = set(one)
        alone = [p for p in pieces if p not in sure]
        groups = [one[k:k + ASKED_TOGETHER] for k in range(0, len(one), ASKED_TOGETHER)]
        out: dict[str, bytes] = {}
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups])):
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(group):
                raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
                out.update((p, raw[a:b]) for p, a, b in zip(group, at, at[1:]))
            else:
                alone += group
        out.update((p, x.tobytes()) for p, x in zip(alone, self._ids(alone)))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_piece:
            return self._ids(texts)
        pieces: list[str] = []
        ends = [0]
        for t in texts:
            pieces += self._pieces(t)
            ends.append(len(pieces))
        found = list(map(self.memo.known.get, pieces))
        missing = [k for k, x in enumerate(found) if x is None]
        new = {pieces[k] for k in missing}
        made = {p: self.memo.older[p] for p in new & self.memo.older.keys()}
        made |= self._ask(list(new - made.keys()))
        self.memo.update(made)
        for k in missing:
            found[k] = made[pieces[k]]
        return [np.frombuffer(b"".join(found[a:b]), "<u4") for a, b in zip(ends, ends[1:])]

    @staticmethod
    def _pieces(text: str) -> list[str]:
        raw = text.encode()
        rest = raw.translate(None, PLAIN)
        if b"<|" not in raw and (not rest or OTHER.search(rest.decode()) is None):
            return PIECE.findall(raw.lower().decode())
        words = re.split(r"[ \t-\r]+", text)
        return list(itertools.chain.from_iterable(
            [w] if OTHER.search(w) or "<|" in w else PIECE.findall(w.encode().lower().decode()) for w in words if w))


def _encoder(path: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return worker_state(f"words:{path}", lambda: WordEncoder(path))


def _looked_up(encoder: WordEncoder, ids: list, texts: list[str]) -> Iterator[tuple[int | None, np.ndarray]]:
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size > LOOK_UP_CHARS or k == len(texts) - 1:
            yield from zip(ids[start:k + 1], encoder.encode(texts[start:k + 1]))
            start, size = k + 1, 0


def segments(docs: DataFrame, path: str, *, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text",
             segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Rows of SEGMENTS, in ascending document id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = _encoder(path), TaskContext.get().partitionId()
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        docs_: list = []
        parts: list[np.ndarray] = []
        seq = before = size = 0

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([len(x) for x in parts], dtype=np.int64)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "before": pa.array([before], pa.int64()), "n_tokens": pa.array([size], pa.int64()),
                "doc_ids": pa.array([docs_], pa.list_(pa.int64())), "ends": pa.array([ends], pa.list_(pa.int64())),
                "payload": pa.array([pack(np.concatenate(parts))], pa.binary())})

        for ids, texts in rows_of(batches, "doc_id", "text"):
            for i, x in _looked_up(encoder, ids, texts):
                docs_.append(i)
                parts.append(np.concatenate((x, tail)))
                size += len(parts[-1])
                if size >= segment_tokens:
                    yield flush()
                    seq, before, size, docs_, parts = seq + 1, before + size, 0, [], []
        if docs_:
            yield flush()

    ranged = id_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ranged.mapInArrow(run, SEGMENTS)


def write(docs: DataFrame, tokenizer: str, out: str, **options) -> None:
    """Encode and write the files; see `segments` for the options."""
    segments(docs, tokenizer, **options).write.parquet(out)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the ids of all documents before each."""
    found = spark.read.schema(SEGMENTS).parquet(path)
    sums = sorted((r["part"], r["n"]) for r in found.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    bases = spark.createDataFrame(
        [(p, b) for (p, _), b in zip(sums, itertools.accumulate((n for _, n in sums), initial=0))], "part int, base long")
    return found.join(F.broadcast(bases), "part").select(  # a row for each id range
        (F.col("base") + F.col("before")).alias("start"), "n_tokens", "doc_ids", "ends", "payload")


def documents(read_segments: DataFrame, digest_only: bool = False) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens and its ids, or only their CRC-32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, doc_ids, ends, payloads in rows_of(batches, "start", "doc_ids", "ends", "payload"):
            for start, ids, stop, payload in zip(starts, doc_ids, ends, payloads):
                codes, begin = Codes(payload), [0, *stop[:-1]]
                out = {"doc_id": pa.array(ids, pa.int64()), "start": pa.array([start + b for b in begin], pa.int64()),
                       "n_tokens": pa.array([e - b for b, e in zip(begin, stop)], pa.int64())}
                whole = codes.slice(0, len(codes)).astype("<u4")  # every document is wanted: one sweep through the levels
                found = (whole[b:e] for b, e in zip(begin, stop))
                if digest_only:
                    out["ids_crc32"] = pa.array([zlib.crc32(x) for x in found], pa.int64())
                else:
                    out["ids"] = pa.array([x.astype(np.int64) for x in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    last = "ids_crc32 long" if digest_only else "ids array<long>"
    return read_segments.select("start", "doc_ids", "ends", "payload").mapInArrow(
        run, f"doc_id long, start long, n_tokens long, {last}")


def tokens_at(read_segments: DataFrame, positions: DataFrame) -> DataFrame:
    """``(position, token)`` for rows of global positions; positions outside the files have no row.

    Positions and segments meet on stretches of the global numbering, so each
    position meets the few segments of its stretch.
    """
    span = 1 << 20
    parts = read_segments.withColumn("stretch", F.explode(F.sequence(
        F.floor(F.col("start") / span), F.floor((F.col("start") + F.col("n_tokens") - 1) / span))))
    asked = positions.select(F.col("position").cast("long").alias("position")).withColumn(
        "stretch", F.floor(F.col("position") / span))
    met = asked.join(parts.select("stretch", "start", "n_tokens", "payload"), "stretch").filter(
        "position >= start and position < start + n_tokens").groupBy("start").agg(
        F.collect_set("position").alias("positions"), F.first("payload").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, at, payloads in rows_of(batches, "start", "positions", "payload"):
            for start, some, payload in zip(starts, at, payloads):
                codes = Codes(payload)
                yield pa.RecordBatch.from_pydict({"position": pa.array(some, pa.int64()),
                                                  "token": pa.array([codes.get(p - start) for p in some], pa.int64())})

    return met.mapInArrow(run, "position long, token long")
