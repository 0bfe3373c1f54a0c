"""Byte-level BPE as a finite-state transducer, and a streaming decoder (operator 9).

The rank file is compiled, lazily, into a deterministic transducer over bytes.
A state stands for all ways in which the bytes read so far may still be split
by the bytes to come: the places where a token may have begun that is not yet
ended, each with the bytes since then, the last token before it and the tokens
not yet agreed on. Reading a byte ends at most one token that is compatible
with the token before it (a pair is compatible when the merges encode its bytes
as that pair), drops the places no token can reach any more, and emits the
tokens on which all places left agree. A token is at most so many bytes long,
so the look-ahead is bounded and so is the number of states. A state and its
arrows are made when a text first needs them; once the table is full, rarer ones
are made anew each time (results don't depend on that).

Decoding joins the bytes of the tokens and feeds them to an incremental UTF-8
machine, which keeps the one to three bytes of a character that is not complete
and gives out whole characters only.

Defined cases: a null text is empty; an empty text has no tokens; a piece that
is itself in the rank file is that one token; unknown ids raise; malformed
bytes decode to U+FFFD; repeated rows are encoded one by one.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wavefold.llm.bpe_pairs import Pairs
from wavefold.llm.common import Memo, id_text, rows_of, worker_state

#: Pieces, arrows of the transducer and judged pairs that a worker remembers; results don't depend on them.
MEMO_PIECES, MEMO_BYTES, MEMO_ARROWS, MEMO_PAIRS = 400_000, 48, 400_000, 400_000
#: Token ids given to the decoder at a time.
DECODE_IDS = 65_536


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """Lazily determinised transducer of a rank file."""

    def __init__(self, ranks: dict[bytes, int], memory: float = 1.0):
        self.most_arrows = int(MEMO_ARROWS * memory)
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte needs a rank")
        self.ranks = ranks
        self.begins = {t[:k] for t in ranks for k in range(1, len(t))}
        self.pairs = Pairs(lambda a, b: ranks.get(a + b), int(MEMO_PAIRS * memory))
        self.states: dict[tuple, dict] = {}
        self.arrows = 0
        self.start = self._state(((b"", b"", ()),))  # the one place before the first byte

    def _state(self, places: tuple) -> dict:
        """A state is the table of its arrows, byte -> (tokens emitted, next state); None holds its places."""
        return self.states.setdefault(places, {None: places})

    def _arrow(self, state: dict, byte: int) -> tuple[tuple[int, ...], dict]:
        ended, made, rank_of, begins, fits = None, [], self.ranks.get, self.begins, self.pairs.known.get
        byte_ = bytes((byte,))
        for since, last, pending in state[None]:
            seen = since + byte_
            if ended is None and (rank := rank_of(seen)) is not None:
                fit = fits((last, seen))
                if fit or fit is None and self.pairs.fit(last, seen):
                    ended = (b"", seen, (*pending, rank))
            if seen in begins:
                made.append((seen, last, pending))
        if ended is None:
            raise ValueError("the ranks leave a prefix without an encoding")
        made.append(ended)
        agreed, first, fewest = 0, ended[2], min(len(p) for _, _, p in made)
        while agreed < fewest and all(p[agreed] == first[agreed] for _, _, p in made):
            agreed += 1
        places = tuple((s, t, p[agreed:]) for s, t, p in made) if agreed else tuple(made)
        if self.arrows >= self.most_arrows:  # a full table: what is rare is made anew each time
            return first[:agreed], {None: places}
        self.arrows += 1
        arrow = state[byte] = first[:agreed], self._state(places)
        return arrow

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Token ids of one split piece, each as soon as no later byte can change it."""
        state = self.start
        for byte in data:
            emitted, state = state.get(byte) or self._arrow(state, byte)
            yield from emitted
        yield from state[None][-1][2]

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one split piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        state, out = self.start, []
        for byte in piece:
            emitted, state = state.get(byte) or self._arrow(state, byte)
            if emitted:
                out += emitted
        out += state[None][-1][2]
        return tuple(out)


class Encoder:
    """Texts to ids: splits by the pattern and sends each piece through the transducer."""

    def __init__(self, path: str, pattern: str, memory: float = 1.0):
        self.ranks = read_ranks(path)
        self.split = regex.compile(pattern)
        self.transducer = Transducer(self.ranks, memory)
        self.memo = Memo(int(MEMO_PIECES * memory))

    def _piece(self, piece: str) -> bytes:
        found = self.memo.older.get(piece)
        if found is None:
            raw = piece.encode()
            ids = self.transducer.encode(raw)
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(raw) > MEMO_BYTES:
                return found
        self.memo.put(piece, found)
        return found

    def encode(self, text: str) -> list[int]:
        known, piece = self.memo.known.get, self._piece
        laid = b"".join([known(p) or piece(p) for p in self.split.findall(text)])
        return np.frombuffer(laid, "<u4").tolist()


class Utf8Stream:
    """Incremental UTF-8: bytes go in as they come, whole characters come out.

    ``feed`` holds back the bytes of a character whose end has not come; ``end``
    gives what is left (a torn character is U+FFFD).
    """

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def _torn(data: bytes) -> int:
        """How many bytes at the end belong to a character that still lacks some."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 != 0x80:  # not a continuation: a lead byte, or a character of one byte
                need = 4 if b >= 0xF0 else 3 if b >= 0xE0 else 2 if b >= 0xC0 else 1
                return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        torn = self._torn(data)
        self.held = data[len(data) - torn:]
        return data[:len(data) - torn].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def decode_chunks(bytes_of: dict[int, bytes], ids: list[int]) -> Iterator[str]:
    """The text of the ids, in parts of whole characters."""
    stream = Utf8Stream()
    for k in range(0, len(ids), DECODE_IDS):
        yield stream.feed(b"".join(map(bytes_of.__getitem__, ids[k:k + DECODE_IDS])))
    yield stream.end()


class Coder:
    def __init__(self, path: str, pattern: str, memory: float = 1.0):
        self.encoder = Encoder(path, pattern, memory)
        self.bytes_of = {r: t for t, r in self.encoder.ranks.items()}
        self.digits = {r: str(r) for r in self.bytes_of}


def _coder(path: str, pattern: str, memory: float = 1.0) -> Coder:
    return worker_state(f"fst:{path}:{pattern}:{memory}", lambda: Coder(path, pattern, memory))


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row its token ids: ``(doc_id, ids array<int>)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for ids, texts in rows_of(batches, "doc_id", "text"):
            for i, t in zip(ids, texts):  # a row at a time: ids of a whole batch would be large
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([i], pa.int64()),
                                                  "ids": pa.array([coder.encoder.encode(t)], pa.list_(pa.int32()))})

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str = "") -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids are no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = worker_state(f"bytes:{path}", lambda: {r: t for t, r in read_ranks(path).items()})
        for docs, ids in rows_of(batches, "doc_id", "ids"):
            for i, x in zip(docs, ids):
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([i], pa.int64()),
                                                  "text": pa.array(["".join(decode_chunks(bytes_of, x or []))], pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, *, keep_ids: bool = False, memory: float = 1.0,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: n_tokens, and SHA-256 of the comma-joined ids and of the decoded
    bytes; with ``keep_ids`` also the ids. ``memory`` scales what a worker remembers (1: some 250 MB)."""
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string()), *([("ids", pa.list_(pa.int32()))] if keep_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern, memory)
        for docs_, texts in rows_of(batches, "doc_id", "text"):
            rows = []
            for i, t in zip(docs_, texts):
                ids = coder.encoder.encode(t)
                decoded = hashlib.sha256()
                for part in decode_chunks(coder.bytes_of, ids):
                    decoded.update(part.encode())
                digest = hashlib.sha256(",".join(map(coder.digits.__getitem__, ids)).encode())
                rows.append((i, len(ids), digest.hexdigest(), decoded.hexdigest(), np.array(ids, np.int32) if keep_ids else None))
            yield pa.RecordBatch.from_pydict({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(fields)})

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return id_text(docs, id_col, text_col).mapInArrow(run, schema)
