"""SimHash near-duplicates by vantage-point trees over fingerprints (operator 7).

A-Z is lower-cased; words are runs of anything but ASCII white space; the
shingles are ``k`` consecutive words joined by a space, repeats included (the
whole sequence if there are fewer words). A fingerprint bit is set if over half
of the shingles' XXH64 values (seed 42) have it; a text without words has
fingerprint zero and links like any other. Documents link whose fingerprints
differ in at most ``max_bits`` bits; a component is what such links reach.

Method:

1. Equal fingerprints are folded first, so a group of copies is one point.
2. A vantage-point tree is fitted on a bounded sample of the points. A node
   holds a vantage point and a radius; a point goes inside or outside by its
   Hamming distance. By the triangle inequality a link across the radius joins
   a point outside to one inside that is less than ``max_bits`` from the radius,
   so those points go outside as well, and every link has a leaf that holds
   both its ends. The leaves are the shards: every point is sent to its leaves.
3. Each shard goes on with vantage points of its own rows down to small
   blocks, which are compared exactly. It gives its components as stars (one
   row for each linked point), never all pairs of a group.
4. Alternating large-star and small-star joins make one star per component.

The sample only shapes the shards; every point is compared with every point
that can link to it.

Defined cases: null text counts as empty; null ids are kept and never chosen as
a component's id unless all its ids are null; repeated rows share a component;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavefold.llm.common import drop_worker_state, gathered, id_text, rows_of, slices, stored
from wavefold.session import checkpoint

#: The tree is fitted on at most so many points, and at most an eighth of all.
TREE_SAMPLE = 16_384
#: Points wanted in a shard, and in a block that is compared pair by pair.
SHARD_POINTS, BLOCK_POINTS = 2_048, 512
#: A leaf of more than so many shards' points is split again, by a tree fitted on some LEAF_SAMPLE of them.
LEAF_SHARDS, LEAF_SAMPLE = 32, 4_096
#: Pairs of fingerprints compared at once.
COMPARE_CELLS = 2_000_000
#: Shingles whose bits are counted at once.
COUNT_BLOCK = 65_536


def fingerprint(text: str | None, k: int) -> int:
    """64-bit SimHash of the word shingles; words are runs without ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    laid = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(k, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(laid[a:b], 42) for a, b in zip(starts, ends[k - 1:].tolist())], "<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNT_BLOCK):
        block = hashes[at:at + COUNT_BLOCK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``: fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for ids, texts in rows_of(batches, "doc_id", "text"):
            fps = np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "fp": pa.array(fps)})

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _split(points: np.ndarray, bits: int, tries: int = 8) -> tuple[np.uint64, int, np.ndarray, np.ndarray] | None:
    """The best of a few vantage points: (point, radius, inside, outside), or None if none parts them.

    ``inside`` has distances up to the radius; ``outside`` all others and the band
    of width ``bits`` inside the radius.
    """
    best = None
    for v in points[np.linspace(0, len(points) - 1, min(tries, len(points))).astype(np.int64)]:
        far = np.bitwise_count(points ^ v)
        upto = np.cumsum(np.bincount(far, minlength=65))
        band = np.concatenate((np.zeros(bits, np.int64), upto))[:65]  # those at most radius - bits away
        largest = np.maximum(upto, len(points) - band)
        radius = int(np.argmin(largest))
        if best is None or largest[radius] < best[0]:
            best = (largest[radius], v, radius, far)
    size, v, radius, far = best
    if size > 0.9 * len(points):
        return None
    return v, radius, np.flatnonzero(far <= radius), np.flatnonzero(far > radius - bits)


class VantageTree:
    """Flat tree: ``child`` pairs hold a node's number, or -1 - leaf."""

    def __init__(self, sample: np.ndarray, total: int, bits: int, shard_points: int = SHARD_POINTS):
        self.bits, self.leaves = bits, 0
        self.vantage: list[int] = []
        self.radius: list[int] = []
        self.child: list[list[int]] = []
        scale = total / max(1, len(sample))
        self.root = self._grow(sample, scale, shard_points)

    def _grow(self, points: np.ndarray, scale: float, wanted: int) -> int:
        parted = _split(points, self.bits) if len(points) * scale > wanted and len(points) >= 16 else None
        if parted is None:
            self.leaves += 1
            return -self.leaves
        v, radius, inside, outside = parted
        at = len(self.vantage)
        self.vantage.append(int(v))
        self.radius.append(radius)
        self.child.append([0, 0])
        self.child[at] = [self._grow(points[inside], scale, wanted), self._grow(points[outside], scale, wanted)]
        return at

    def leaves_of(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, positions of the points that go to it)."""
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            at, here = todo.pop()
            if not len(here):
                continue
            if at < 0:
                yield -1 - at, here
                continue
            far = np.bitwise_count(points[here] ^ np.uint64(self.vantage[at])).astype(np.int64)
            inside, outside = self.child[at]
            todo += [(inside, here[far <= self.radius[at]]), (outside, here[far > self.radius[at] - self.bits])]


def _near(some: np.ndarray, points: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For a few rows of ``some`` at a time: (first row, who of ``points`` is near each)."""
    step = max(1, COMPARE_CELLS // max(1, len(points)))
    for at in range(0, len(some), step):
        yield at, np.bitwise_count(some[at:at + step, None] ^ points[None, :]) <= bits


def _block_stars(points: np.ndarray, bits: int, link) -> None:
    """Give ``link`` the components of a block: arrays of two or more points of it."""
    left = points[np.concatenate([near.sum(axis=1) for _, near in _near(points, points, bits)]) > 1]
    while len(left):
        group, edge, left = [left[:1]], left[:1], left[1:]
        while len(edge) and len(left):
            reached = np.logical_or.reduce([near.any(axis=0) for _, near in _near(edge, left, bits)])
            edge, left = left[reached], left[~reached]
            group.append(edge)
        link(np.concatenate(group))


def stars(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (point, smaller point) that hold together what links of ``bits`` reach among distinct points."""
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def link(group: np.ndarray) -> None:
        group = np.sort(group)
        out.append((group[1:], np.full(len(group) - 1, group[0])))

    todo = [points]
    while todo:
        here = todo.pop()
        parted = _split(here, bits) if len(here) > BLOCK_POINTS else None
        if parted is None:
            _block_stars(here, bits, link)
        else:
            todo += [here[parted[2]], here[parted[3]]]
    if not out:
        return points[:0], points[:0]
    both = np.unique(np.stack([np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])]), axis=1)
    return both[0], both[1]


def shards_of(points: DataFrame, bits: int, shard_points: int = SHARD_POINTS, tree_sample: int = TREE_SAMPLE,
              leaf_points: int | None = None) -> DataFrame:
    """``(shard, fp)``: every link of ``bits`` among distinct ``fp`` values has both its ends in some shard.

    No shard has more than ``leaf_points`` rows (LEAF_SHARDS times ``shard_points``), give or take
    a hash's spread over the pieces of a leaf that cannot be parted.
    """
    bound = leaf_points or LEAF_SHARDS * shard_points
    total = points.count()
    take = min(tree_sample, total // 8)
    sample = [r.fp for r in points.orderBy(F.xxhash64("fp"), "fp").limit(take).collect()] if take else []
    tree = VantageTree(np.array(sample, np.int64).view(np.uint64), total, bits, shard_points)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for leaf, at in tree.leaves_of(fps.view(np.uint64)):
                yield pa.RecordBatch.from_pydict({"shard": pa.array([str(leaf)] * len(at)), "fp": pa.array(fps[at])})

    def split(part: pa.Table) -> pa.Table:
        # a salt's rows of one leaf, and the leaf's sample, which is the same for every salt
        fps = np.ascontiguousarray(part.column("fp").to_numpy())
        drawn = part.column("drawn").to_numpy(zero_copy_only=False).astype(bool)
        here = VantageTree(np.sort(fps[drawn]).view(np.uint64), part.column("n")[0].as_py(), bits, shard_points)
        old, mine = part.column("shard")[0].as_py(), fps[~drawn]
        found = [(leaf, mine[at]) for leaf, at in here.leaves_of(mine.view(np.uint64))]
        names = [f"{old}.{leaf}" for leaf, at in found for _ in range(len(at))]
        return pa.table({"shard": pa.array(names, pa.string()), "fp": pa.array(np.concatenate([mine[:0], *(at for _, at in found)])),
                         "whole": pa.array([here.leaves == 1] * len(names), pa.bool_())})

    done, level = [], 0
    sent = stored(points.select("fp").mapInArrow(send, "shard string, fp long"), "simhash-sent").withColumn("whole", F.lit(False))
    while True:
        sizes = stored(sent.groupBy("shard", "whole").agg(F.count("*").alias("n")).filter(F.col("n") > bound), "simhash-large")
        if sizes.isEmpty():
            return _all([*done, sent.select("shard", "fp")])
        done.append(sent.join(sizes, ["shard", "whole"], "left_anti").select("shard", "fp"))
        large = sent.join(sizes, ["shard", "whole"])
        # pieces of half the bound: any two of them are one shard
        piece, pieces = F.xxhash64("fp", F.lit(-1)), F.ceil(F.col("n") * 2 / bound).cast("int")
        ball = large.filter("whole").withColumn("p", F.pmod(piece, pieces).cast("int")).withColumn(
            "o", F.explode(F.sequence(F.lit(0), pieces - 1)))
        done.append(ball.select(F.concat_ws("|", "shard", F.least("p", "o"), F.greatest("p", "o")).alias("shard"), "fp"))
        level += 1
        salts = F.ceil(F.col("n") / bound).cast("int")
        rows = large.filter("not whole").select("shard", "fp", "n", salts.alias("salts"))
        wanted = float(min(LEAF_SAMPLE, max(64, tree_sample)) << 30)
        chance = F.pmod(F.xxhash64("fp", F.lit(level)), F.lit(1 << 30)).cast("double") * F.col("n")
        drawn = rows.filter(chance < wanted).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("fp", F.lit(-level)), "salts").cast("int"))
        both = salted.select("shard", "salt", "fp", "n", F.lit(False).alias("drawn")).unionByName(
            drawn.select("shard", "salt", "fp", "n", F.lit(True).alias("drawn")))
        sent = stored(both.groupBy("shard", "salt").applyInArrow(split, "shard string, fp long, whole boolean"), "simhash-sent")


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def link_fingerprints(points: DataFrame, bits: int, shard_points: int = SHARD_POINTS, tree_sample: int = TREE_SAMPLE,
                      leaf_points: int | None = None) -> DataFrame:
    """Star links ``(a, b)``, b < a as unsigned numbers mapped to longs, over distinct ``fp`` values."""

    def compare(shard: pa.Table) -> pa.Table:
        fps = np.ascontiguousarray(shard.column("fp").to_numpy()).view(np.uint64)
        a, b = stars(fps, bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    sent = shards_of(points, bits, shard_points, tree_sample, leaf_points)
    return sent.groupBy("shard").applyInArrow(compare, "a long, b long")


def connected(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``(node, root)`` of every linked node but the roots, by alternating star joins.

    Roots are the smallest node of their component in the order of ``long``. ``rows``: about how many links
    there are, if that is known.
    Each round is checkpointed; rounds grow with the logarithm of the longest chain.
    """

    def smaller_first(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    links = smaller_first(links)
    edges = checkpoint(links if rows is None else gathered(links, rows))
    seen = mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = smaller_first(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        edges = checkpoint(gathered(smaller_first(small), 2 * seen[0]))  # no more than an edge and a root for each of them
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def components(fps: DataFrame, max_bits: int = 2, shard_points: int = SHARD_POINTS) -> DataFrame:
    """``(fp, root, component_id)`` for every distinct fp of ``(doc_id, fp)`` rows.

    component_id is the smallest doc_id of the component.
    """
    points = stored(gathered(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), fps.count()), "simhash-points")
    links = link_fingerprints(points, max_bits, shard_points)
    rooted = points.join(connected(links, points.count()).withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, *, k: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    shard_points: int = SHARD_POINTS) -> DataFrame:
    """Per document row: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    fps = stored(fingerprints(docs, k, id_col, text_col), "simhash-fps")
    return gathered(fps.join(components(fps, max_bits, shard_points), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"), fps.count())


def keep_first(docs: DataFrame, *, k: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
               shard_points: int = SHARD_POINTS) -> DataFrame:
    """``docs`` with one row of each component, that of its smallest id; same columns.

    Repeated rows of that id and fingerprint are one; among rows that tie in id
    and component but not in text, one fingerprint stays (the smallest as a long).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            fps = np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64)
            yield batch.append_column("__fp", pa.array(fps))

    with_fp = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])
    marked = stored(docs.mapInArrow(run, with_fp), "simhash-docs")
    fps = marked.select(F.col(id_col).cast("long").alias("doc_id"), F.col("__fp").alias("fp"))
    found = components(fps, max_bits, shard_points)
    chosen = (fps.distinct().join(found, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
              .groupBy("root").agg(F.min(F.struct("fp")).alias("one"), F.first("component_id").alias("__id"))
              .select(F.col("one.fp").alias("__rep"), "__id"))
    kept = marked.join(chosen, (F.col("__fp") == F.col("__rep"))
                       & marked[id_col].cast("long").eqNullSafe(F.col("__id")), "left_semi")
    return kept.dropDuplicates(["__fp", id_col]).select(*[F.col(f"`{c}`") for c in docs.columns])

