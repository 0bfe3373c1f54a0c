"""Which pairs of BPE tokens stand side by side in an encoding."""

from __future__ import annotations

from collections.abc import Callable

NEVER = 1 << 60


class Pairs:
    """Judges pairs by the merges, given as ``rank(left, right)`` (None: no such merge).

    A sequence of tokens is the encoding of its bytes when each two neighbours,
    put together, are encoded as those two. ``known`` remembers up to ``size``
    judgements.
    """

    def __init__(self, rank: Callable[[bytes, bytes], int | None], size: int):
        self.rank, self.size = rank, size
        self.known: dict[tuple[bytes, bytes], bool] = {}
        self.edges: dict[bytes, tuple | None] = {}

    def history(self, piece: bytes) -> list[tuple[int, list[bytes]]]:
        """Plain BPE of a few bytes, the lowest rank first, the leftmost of equals: the parts after
        each merge, with the highest rank merged so far (the time of that merge)."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        time, out = -1, [(-1, parts)]
        while len(parts) > 1:
            ranked = [(r, i) for i in range(len(parts) - 1) if (r := self.rank(parts[i], parts[i + 1])) is not None]
            if not ranked:
                break
            r, at = min(ranked)
            time = max(time, r)
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2:]]
            out.append((time, parts))
        return out

    def merged(self, piece: bytes) -> list[bytes]:
        return self.history(piece)[-1][1]

    def _edges(self, token: bytes) -> tuple | None:
        """What stands at a token's left and right edge while it is merged: (part, time it is replaced) in
        order; None if its own bytes are not merged to it."""
        history = self.history(token)
        edges = None
        if len(history[-1][1]) == 1:
            edges = tuple(
                [(parts[side], until) for (_, parts), (until, after) in zip(history, [*history[1:], (NEVER, [b""])])
                 if parts[side] != after[side]] for side in (0, -1))
        self.edges[token] = edges
        return edges

    def fit(self, left: bytes, right: bytes) -> bool:
        """Whether the merges leave this pair as it is; an empty ``left`` is the beginning.

        Both tokens grow by their own merges in the order of time; the pair fits
        if at no time the parts on both sides of the border would merge first.
        """
        edges = self.edges
        to = edges[right] if right in edges else self._edges(right)
        fits = to is not None
        if fits and left:
            on = edges[left] if left in edges else self._edges(left)
            rights, lefts, i, j = on[1], to[0], 0, 0
            while True:
                (r, r_until), (l, l_until) = rights[i], lefts[j]  # noqa: E741
                across = self.rank(r, l)
                if across is not None and across < r_until and across <= l_until:
                    fits = False
                    break
                if r_until == l_until == NEVER:
                    break
                if r_until <= l_until:
                    i += 1
                else:
                    j += 1
        if len(self.known) > self.size:
            self.known.clear()
        self.known[left, right] = fits
        return fits
