"""Exact token counts at every prefix of a text, by dynamic programming (operator 1).

For a byte-level BPE tokenizer file (merge list, the usual splitting pattern,
added special tokens) the operator gives, for every code point prefix
``text[:p]``, the number of tokens the tokenizer would make of that prefix.

Method: the encoding of a prefix of a split piece ends in exactly one token
that is compatible with the last token before it, and a pair is compatible when
its two tokens, put together, are encoded as that pair. So one forward pass over
the bytes fills ``last token`` and ``count`` for every prefix from shorter
prefixes, without encoding any of them. The counts of a whole text are the
counts of its pieces laid end to end (stored as differences, 16 bits each), with
the prefixes mended that end where a cut changes the split: inside white space
before a word, inside a contraction, inside a special token's string.
Truncation and budget questions (`longest_prefix`, `counts_at`) are then
look-ups in that table.

Defined cases: a null text is empty; an empty text has no tokens and an empty
table; repeated rows are answered one by one; a null id stays null; long runs of
one kind of character take time in proportion to their length; a code point that
changed the count by more than 16 bits hold would raise a ValueError (no wrapped table).
"""

from __future__ import annotations

import json
import operator
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wavefold.llm.bpe_pairs import Pairs
from wavefold.llm.common import Memo, id_text, rows_of, worker_state

# Fixed value: the splitting pattern of this tokenizer family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The contractions of that pattern.
CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))
#: Pieces remembered in a worker, the longest that are, and pairs judged; results don't depend on them.
MEMO_PIECES, MEMO_CHARS, MEMO_PAIRS = 400_000, 40, 400_000


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in this family's vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(moved)}


def _sixteen_bits(steps: list[int]) -> bytes:
    try:
        return struct.pack(f"<{len(steps)}h", *steps)
    except struct.error:
        raise ValueError("one more code point changes the count by more than 16 bits hold") from None


class PrefixCounter:
    """Counts for one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"], pre.get("type"), pre.get("use_regex"), spec["normalizer"]) != ("BPE", "ByteLevel", True, None) \
                or pre["add_prefix_space"]:
            raise ValueError("a byte-level BPE file with the usual split and no normalizer is needed")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that strip or stand alone are not supported")
        as_byte = _byte_of_char()
        raw = lambda s: bytes(as_byte[c] for c in s)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranks = {(raw(a), raw(b)): k for k, (a, b) in reversed(list(enumerate(pairs)))}
        self.pairs = Pairs(lambda a, b: ranks.get((a, b)), MEMO_PAIRS)
        # a token in play is one that its own bytes are encoded as
        vocab = {raw(s) for s in model["vocab"]}
        self.tokens = {t for t in vocab if len(t) == 1 or self.pairs.merged(t) == [t]}
        self.heads = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.split, self.space = regex.compile(PATTERN), regex.compile(r"\s{2,}")
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.ends: dict[bytes, tuple] = {}
        self.memo = Memo(MEMO_PIECES)

    def _ends(self, seen: bytes) -> tuple[bytes, tuple[tuple[bytes, int], ...]]:
        """The longest end of ``seen`` that begins a token, and the tokens that end there, longest first."""
        inside = next(seen[k:] for k in range(len(seen)) if seen[k:] in self.heads)
        found = tuple((inside[k:], len(inside) - k) for k in range(len(inside)) if inside[k:] in self.tokens)
        if len(self.ends) > MEMO_PIECES:
            self.ends.clear()
        self.ends[seen] = inside, found
        return inside, found

    def byte_counts(self, piece: bytes) -> list[int]:
        """Token counts of every byte prefix of one split piece, the empty one first."""
        last: list[bytes] = [b""]
        count = [0]
        inside = b""
        ends, fits = self.ends.get, self.pairs.known.get
        for end in range(1, len(piece) + 1):
            seen = inside + piece[end - 1:end]
            inside, found = ends(seen) or self._ends(seen)
            for token, n in found:
                before = last[end - n]
                if n == end or (f := fits((before, token))) or f is None and self.pairs.fit(before, token):
                    last.append(token)
                    count.append(count[end - n] + 1)
                    break
            else:
                raise ValueError("the merges leave a prefix without an encoding")
        return count

    def piece_counts(self, piece: str) -> list[int]:
        """Token counts of the code point prefixes of a piece, the empty one left out."""
        if piece in CONTRACTIONS:  # cut, it falls apart
            return [sum(self.byte_counts(x.encode())[-1] for x in self.split.findall(piece[:k]))
                    for k in range(1, len(piece) + 1)]
        raw = piece.encode()
        counts = self.byte_counts(raw)
        if len(raw) == len(piece):
            return counts[1:]
        ends = np.flatnonzero((np.frombuffer(raw, np.uint8)[1:] & 0xC0) != 0x80) + 1
        return [*(counts[k] for k in ends.tolist()), counts[-1]]

    def _steps(self, piece: str) -> bytes:
        steps = self.memo.older.get(piece)
        if steps is None:
            counts = self.piece_counts(piece)
            steps = _sixteen_bits(list(map(operator.sub, counts, [0, *counts])))
            if len(piece) > MEMO_CHARS:
                return steps
        self.memo.put(piece, steps)
        return steps

    def _plain(self, text: str) -> np.ndarray:
        """Counts at 0..len(text) for a text without special tokens."""
        known, steps = self.memo.known.get, self._steps
        laid = b"".join([known(p) or steps(p) for p in self.split.findall(text)])
        out = np.zeros(len(text) + 1, np.int64)
        np.cumsum(np.frombuffer(laid, "<i2"), out=out[1:])
        for m in self.space.finditer(text):  # a prefix that ends in white space takes all of it as one piece
            if m.end() < len(text):
                out[m.end()] = out[m.start()] + self.piece_counts(m[0])[-1]
        return out

    def counts(self, text: str) -> np.ndarray:
        """counts[p]: the tokens of ``text[:p]``, for p from 0 to len(text)."""
        if self.special is None or self.special.search(text) is None:
            return self._plain(text)
        parts, end = [np.zeros(1, np.int64)], 0
        for m in self.special.finditer(text):
            here = self._plain(text[end:m.start()]) + parts[-1][-1]
            before = text[end:m.start()]
            # a cut special string is ordinary text after the pieces before it; white space between moves with it
            at = max((p.start() for p in self.split.finditer(before) if not before[p.start() - 1:p.start()].isspace()), default=0)
            inside = [here[at] + self._plain(before[at:] + m[0][:k])[-1] for k in range(1, len(m[0]))]
            parts += [here[1:], np.array([*inside, here[-1] + 1], np.int64)]
            end = m.end()
        return np.concatenate([*parts, self._plain(text[end:])[1:] + parts[-1][-1]])


def longest_prefix(counts: np.ndarray, limit: int) -> int:
    """Code points of the longest prefix with at most ``limit`` tokens."""
    return int(np.flatnonzero(counts <= limit)[-1])


def _counter(path: str) -> PrefixCounter:
    return worker_state(f"prefix:{path}", lambda: PrefixCounter(path))


def token_counts(docs: DataFrame, path: str, *, limits: Sequence[int] = (512,), keep_table: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: n_chars, n_bytes, n_tokens, and ``fits_<limit>`` for each limit,
    the code points of the longest prefix within that many tokens.

    With ``keep_table`` the table itself comes along: ``steps``, one little-endian
    16-bit difference for every code point; `counts_at` answers from it.
    """
    names = [f"fits_{k}" for k in limits]
    fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
              *((n, pa.int64()) for n in names), *([("steps", pa.binary())] if keep_table else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for ids, texts in rows_of(batches, "doc_id", "text"):
            out: dict[str, list] = {n: [] for n, _ in fields}
            for i, text in zip(ids, texts):
                counts = counter.counts(text)
                row = [i, len(text), len(text.encode()), int(counts[-1]), *(longest_prefix(counts, k) for k in limits)]
                if keep_table:
                    row.append(_sixteen_bits(np.diff(counts).tolist()))
                for column, value in zip(out.values(), row):
                    column.append(value)
            yield pa.RecordBatch.from_pydict({n: pa.array(out[n], t) for n, t in fields})

    schema = ", ".join(f"{n} {'binary' if pa.types.is_binary(t) else 'long'}" for n, t in fields)
    return id_text(docs, id_col, text_col).mapInArrow(run, schema)


def counts_at(table: DataFrame, questions: DataFrame) -> DataFrame:
    """Tokens of ``text[:position]`` for rows (doc_id, position), from a kept table.

    Positions beyond the text count the whole text; negative or null positions
    count nothing; questions about unknown documents have no answer row.
    """
    joined = questions.select("doc_id", "position").join(table.select("doc_id", "steps"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, at, steps in rows_of(batches, "doc_id", "position", "steps"):
            counts = [int(np.frombuffer(s, "<i2")[:max(0, p or 0)].sum(dtype=np.int64)) for p, s in zip(at, steps)]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "position": pa.array(at, pa.int64()),
                                              "n_tokens": pa.array(counts, pa.int64())})

    return joined.mapInArrow(run, "doc_id long, position long, n_tokens long")
