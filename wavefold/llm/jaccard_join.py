"""Similarity join of word-shingle sets, size-aware (operator 11).

A-Z is lower-cased; words are runs of anything but ASCII white space. A document's
set has its distinct shingles of ``k`` words (the whole sequence as one, if it has
fewer words; none without words). Two documents link when
``100 * |intersection| >= percent * |union|``; a component is what links reach.

Method (heavy-light):

1. Equal sets are folded by a 128-bit digest; every further step has one point for them.
2. Two sets of sizes a and b link when they share ``o = ceil(percent * (a + b) / (100 + percent))``
   shingles. Small sets list their subsets of every such size o: two small sets link exactly
   if they list the same subset under an o that is enough for their sizes. Whoever links under a
   subset links with the smallest set that lists it, so one star for a subset holds its links.
3. Large sets are scanned through inverted lists. Shingles are ordered by how often they occur
   (a bounded count sketch of the corpus: it shapes the order only), and a set is listed under its
   first shingles, rare ones first: linked sets share one of those. Sizes and places in the order
   rule most pairs out.
4. Lists are not paired out. Every list has a pivot that all its other sets are compared with; what
   links is one component from then on. Only lists that still join several components go on, with
   PIVOTS_GROW times as many pivots in each round, until every pair of one list that
   is not in one component has been compared. A pair whose sets differ in too many places, by the parities of their
   shingles in PARITIES bits, is passed over, from the second round on where the two meet in a list; all others are
   compared exactly, on the texts' whole sets.
5. The boundary between small and large is the size with the lowest cost: subsets listed, or
   shingles listed and compared (a set's own and its pivot's), over the corpus's histogram of sizes.

Shingles are 64-bit hashes; two of one document pair that fall together would have to do so
among some thousands. Only linked sets, never whole groups of copies, reach the joins.

Defined cases: null and empty texts have the empty set and link with nothing (their component
is their own id); null ids are kept and are a component's id only if all its ids are null; repeated rows
share a component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavefold.llm.bitmaps import hash_bits, hit
from wavefold.llm.common import drop_worker_state, gathered, id_text, rows_of, slices, stored
from wavefold.llm.simhash import connected
from wavefold.llm.words import chained, mix, word_hashes

#: The largest size that is ever weighed as small (its subsets are counted in the millions beyond).
MOST_SMALL = 32
#: Counters of the sketch, and counters in a row of it (rows of one block are added up in one task).
SKETCH, SKETCH_ROW = 1 << 20, 1 << 10
#: Bits of a set's parities.
PARITIES = 512
#: Shingles compared with one pivot in a task's stretch of rows.
CHUNK_SHINGLES = 200_000
#: Pairs that are worth a partition of their own.
PAIRS_EACH = 5_000
#: Pivots of a list grow by this factor with every round.
PIVOTS_GROW = 64


def needed(a: int, b: int, percent: int) -> int:
    """Shingles that sets of sizes a and b share at least when they link."""
    return -(-percent * (a + b) // (100 + percent))


def partners(a: int, percent: int, most: int) -> range:
    """Sizes of the small sets that a set of size a can link with."""
    return range(-(-percent * a // 100), min(most, 100 * a // percent) + 1)


def subset_sizes(a: int, percent: int, most: int) -> list[int]:
    return sorted({o for b in partners(a, percent, most) if (o := needed(a, b, percent)) <= a})


def listed(a: int, percent: int) -> int:
    """How many of its shingles a set of size a is listed under."""
    return a - -(-percent * a // 100) + 1


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest small size: the one with the lowest cost over the numbers of sets by size (up to MOST_SMALL)."""

    def cost(most: int) -> int:
        light = sum(n * sum(comb(a, o) for o in subset_sizes(a, percent, most)) for a, n in sizes.items() if a <= most)
        heavy = sum(n * (listed(a, percent) + 2 * a) for a, n in sizes.items() if a >= least_listed(most, percent))
        return light + heavy

    return min(range(MOST_SMALL + 1), key=lambda most: (cost(most), most))


def least_listed(most: int, percent: int) -> int:
    """The smallest size that can link with a large set."""
    return -(-percent * (most + 1) // 100)


def shingle_sets(texts: list[str | bytes], k: int) -> list[np.ndarray]:
    """Every text's set as sorted unsigned 64-bit hashes."""
    h, n_words = word_hashes([(t.encode() if isinstance(t, str) else t).lower() for t in texts])
    whole = h
    for j in range(1, k):
        whole = chained(whole[:-1], h[j:]) if len(h) > j else whole[:0]
    out, end = [], 0
    for n in n_words.tolist():
        start, end = end, end + n
        if n >= k:
            one = np.sort(whole[start:end - k + 1])
            fresh = one[1:] != one[:-1]
            out.append(one if fresh.all() else one[np.concatenate(([True], fresh))])
        elif n:
            one = h[start:start + 1]
            for at in range(start + 1, end):
                one = chained(one, h[at:at + 1])
            out.append(one)
        else:
            out.append(h[:0])
    return out


def _key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes())


def _row_hash(doc_id: int | None, key: bytes) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(f"{doc_id},".encode() + key))


def parities(shingles: np.ndarray) -> np.ndarray:
    """PARITIES bits as longs: whether an odd number of the shingles falls on each. Two sets' bits differ in no more
    places than the sets differ in shingles."""
    odd = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _signed(hashes) -> pa.Array:
    return pa.array(np.asarray(hashes, np.uint64).view(np.int64))


def _narrow(counts: np.ndarray) -> bytes:
    """SKETCH_ROW counters in as few bytes each as the largest needs."""
    return counts.astype(f"<u{next(width for width in (1, 2, 4, 8) if int(counts.max()) < 1 << 8 * width)}").tobytes()


def _wide(counts: bytes) -> np.ndarray:
    return np.frombuffer(counts, f"<u{len(counts) // SKETCH_ROW}").astype(np.int64)


def described(rows: DataFrame, k: int) -> tuple[DataFrame, Broadcast]:
    """``(doc_id, n, key, row_hash, bits)`` of every row (bits: its set's parities), and the counters of how often shingles occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        counters = np.zeros(SKETCH, np.int64)
        for ids, texts in rows_of(batches, "doc_id", "text"):
            sets = shingle_sets(texts, k)
            counters += np.bincount((np.concatenate(sets) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            keys = [_key(one) for one in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n": pa.array([len(one) for one in sets], pa.int64()),
                "key": pa.array(keys, pa.binary()), "row_hash": _signed([_row_hash(i, x) for i, x in zip(ids, keys)]),
                "bits": pa.array([parities(one) for one in sets], pa.list_(pa.int64())),
                "block": pa.nulls(len(ids), pa.int32()), "counts": pa.nulls(len(ids), pa.binary())})
        blocks = counters.reshape(-1, SKETCH_ROW)
        full = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.nulls(len(full), pa.int64()), "n": pa.nulls(len(full), pa.int64()),
            "key": pa.nulls(len(full), pa.binary()), "row_hash": pa.nulls(len(full), pa.int64()),
            "bits": pa.nulls(len(full), pa.list_(pa.int64())),
            "block": pa.array(full.astype(np.int32)), "counts": pa.array([_narrow(blocks[i]) for i in full], pa.binary())})

    def added(block: pa.Table) -> pa.Table:
        total = sum(_wide(x) for x in block.column("counts").to_pylist())
        return pa.table({"block": block.column("block")[:1], "counts": pa.array([_narrow(total)], pa.binary())})

    both = stored(rows.mapInArrow(run, "doc_id long, n long, key binary, row_hash long, bits array<long>, block int, counts binary"), "jaccard-sets")
    totals = (both.filter("block IS NOT NULL").select("block", "counts").groupBy("block")
              .applyInArrow(added, "block int, counts binary"))
    counters = np.zeros((SKETCH // SKETCH_ROW, SKETCH_ROW), np.int64)
    for row in totals.collect():  # SKETCH counters; an iterator would run a job for every partition
        counters[row.block] = _wide(bytes(row.counts))
    return (both.filter("block IS NULL").select("doc_id", "n", "key", "row_hash", "bits"),
            rows.sparkSession.sparkContext.broadcast(counters.ravel()))


def listings(rows: DataFrame, chosen: Broadcast, often: Broadcast, k: int, percent: int, most_small: int) -> DataFrame:
    """``(token, o, key, n, place)``: under which subsets (o > 0) and shingles (o = 0) each set is listed.

    ``chosen`` lets one row of each set pass, and a few more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        counters = often.value
        from_size = least_listed(most_small, percent)
        for ids, texts in rows_of(batches, "doc_id", "text"):
            sets = shingle_sets(texts, k)
            keys = [_key(one) for one in sets]
            passed = hit(chosen.value, np.array([_row_hash(i, x) for i, x in zip(ids, keys)], np.uint64))
            tokens, os, own, places = [], [], [], []
            for at in np.flatnonzero(passed):
                one, n = sets[at], len(sets[at])
                if n and n <= most_small:
                    for o in subset_sizes(n, percent, most_small):
                        which = np.array(list(combinations(range(n), o)))
                        h = np.full(len(which), mix(np.array([o], np.uint64))[0])
                        for column in which.T:
                            h = chained(h, one[column])
                        tokens.append(h)
                        os.append(np.full(len(h), o))
                        places.append(np.zeros(len(h), np.int64))
                        own.append(np.full(len(h), at))
                if n and n >= from_size:
                    order = np.lexsort((one, counters[(one & np.uint64(SKETCH - 1)).astype(np.int64)]))[:listed(n, percent)]
                    tokens.append(one[order])
                    os.append(np.zeros(len(order), np.int64))
                    places.append(np.arange(len(order)))
                    own.append(np.full(len(order), at))
            if tokens:
                own = np.concatenate(own)
                yield pa.RecordBatch.from_pydict({
                    "token": _signed(np.concatenate(tokens)), "o": pa.array(np.concatenate(os), pa.int32()),
                    "key": pa.array(keys, pa.binary()).take(pa.array(own)),
                    "n": pa.array(np.array([len(one) for one in sets], np.int64)[own]),
                    "place": pa.array(np.concatenate(places), pa.int64())})

    return rows.mapInArrow(run, "token long, o int, key binary, n long, place long")


def _shared(postings: DataFrame) -> DataFrame:
    """The listings of tokens that several sets have, each once; ``members``: how many listings that were at most."""
    rows = postings.count()
    tokens = stored(gathered(postings.groupBy("token", "o").agg(F.count("*").alias("members")).filter("members > 1"), rows), "jaccard-tokens")
    bits = hash_bits(tokens.select("token"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = batch.column(batch.schema.get_field_index("token")).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(hit(bits.value, own)))

    some = postings.mapInArrow(run, postings.schema).join(tokens, ["token", "o"]).distinct()
    return stored(gathered(some, rows), "jaccard-lists")


def _stars(lists: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` of small sets that list one subset: to its smallest set."""
    subsets = lists.filter("o > 0")
    least = subsets.groupBy("token", "o").agg(F.min(F.struct("n", "key")).alias("least"))
    return (subsets.join(least, ["token", "o"])
            .filter(f"key != least.key AND {percent} * (n + least.n) <= {100 + percent} * o")
            .select(F.col("key").alias("a"), F.col("least.key").alias("b")).distinct())


def _pairs(lists: DataFrame, pivots: DataFrame, percent: int, *more: str) -> DataFrame:
    """``(a, n, b)``: sets to be compared with the pivots (b) of their lists."""
    other = pivots.select("token", *(F.col(c).alias(f"p_{c}") for c in pivots.columns if c != "token"))
    fits = [f"{percent} * greatest(n, p_n) <= 100 * least(n, p_n)",
            f"{100 + percent} * least(n - place, p_n - p_place) >= {percent} * (n + p_n)", "key != p_key", *more]
    return (lists.join(other, "token").filter(" AND ".join(fits))
            .select(F.col("key").alias("a"), "n", F.col("p_key").alias("b")).distinct())


def _may_link(percent: int, bits: str, p_bits: str) -> str:
    """Whether the parities of two sets of n and p_n shingles differ in few enough places for a link."""
    differ = " + ".join(f"bit_count({bits}[{i}] ^ {p_bits}[{i}])" for i in range(PARITIES // 64))
    shared = f"(({percent} * (n + p_n) + {99 + percent}) div {100 + percent})"  # `needed`
    return f"{differ} <= n + p_n - 2 * {shared}"


def _near(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs but those whose parities show that their sets differ in too many shingles to link."""
    a = points.select(F.col("key").alias("a"), F.col("bits").alias("a_bits"))
    b = points.select(F.col("key").alias("b"), F.col("n").alias("p_n"), F.col("bits").alias("b_bits"))
    return pairs.join(a, "a").join(b, "b").filter(_may_link(percent, "a_bits", "b_bits")).select("a", "n", "b")


def _ends(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The points of the pairs' sets."""
    keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    return points.join(keys, "key", "left_semi")


def _some(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``(key, packed)`` once for each key of ``keys``: others are passed over before the shuffle."""
    bits = hash_bits(keys.select(F.xxhash64("key").alias("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            h = batch.column(batch.schema.get_field_index("h")).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(hit(bits.value, h))).select(["key", "packed"])

    near = texts.withColumn("h", F.xxhash64("key")).mapInArrow(run, "key binary, packed binary")
    return near.groupBy("key").agg(F.first("packed").alias("packed"))


def compared(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those ``(a, b)`` of the pairs whose sets link. A pivot with many sets is compared in stretches of bounded size."""
    stretches = pairs.groupBy("b").agg(F.ceil(F.sum("n") / CHUNK_SHINGLES).cast("int").alias("stretches"))
    dealt = pairs.join(stretches, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("stretches")).alias("stretch"))
    sets = (dealt.withColumnRenamed("a", "key").join(_some(texts, pairs.select(F.col("a").alias("key")).distinct()), "key")
            .select("b", "stretch", "key", "packed"))
    pivots = (dealt.select(F.col("b").alias("key"), "stretch").distinct()
              .join(_some(texts, pairs.select(F.col("b").alias("key")).distinct()), "key")
              .select(F.col("key").alias("b"), "stretch", F.lit(None).cast("binary").alias("key"), "packed"))
    laid = sets.unionByName(pivots).repartition("b", "stretch").sortWithinPartitions("b", "stretch", F.asc_nulls_first("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        pivot, unpack = None, zstandard.ZstdDecompressor().decompress
        for bs, keys, own in rows_of(batches, "b", "key", "packed"):
            found = []
            for b, key, one in zip(bs, keys, shingle_sets([unpack(x) for x in own], k)):
                if key is None:
                    pivot = one
                    continue
                both = len(np.intersect1d(pivot, one, assume_unique=True))
                if 100 * both >= percent * (len(pivot) + len(one) - both):
                    found.append((key, b))
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.binary()),
                                              "b": pa.array([b for _, b in found], pa.binary())})

    return gathered(laid.mapInArrow(run, "a binary, b binary"), pairs.count(), PAIRS_EACH)


def _texts_of(rows: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``(key, packed)``: the compressed texts of ``wanted`` (key, doc_id, row_hash: its chosen row; rows may repeat)."""
    by_id, by_row = hash_bits(wanted.select(F.xxhash64("doc_id").alias("h"))), hash_bits(wanted.select("row_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches):
            h = batch.column(batch.schema.get_field_index("h")).to_numpy(zero_copy_only=False).view(np.uint64)
            near = batch.filter(pa.array(hit(by_id.value, h)))
            ids, texts = (near.column(near.schema.get_field_index(n)).to_pylist() for n in ("doc_id", "text"))
            keys = [_key(one) for one in shingle_sets(texts, k)] if texts else []
            chosen = hit(by_row.value, np.array([_row_hash(i, x) for i, x in zip(ids, keys)], np.uint64)).tolist()
            some = [(key, pack(text.encode())) for key, text in {x: t for x, t, ok in zip(keys, texts, chosen) if ok}.items()]
            yield pa.RecordBatch.from_pydict({"key": pa.array([x for x, _ in some], pa.binary()),
                                              "packed": pa.array([x for _, x in some], pa.binary())})

    return stored(rows.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(run, "key binary, packed binary"),
                  "jaccard-texts")


def linked_sets(rows: DataFrame, points: DataFrame, often: Broadcast, k: int, percent: int) -> DataFrame:
    """``(node, root)`` of every linked set's key but the roots. ``points``: (key, n, doc_id, row_hash, bits) of each set."""
    sizes = {r.n: r["count"] for r in points.filter(F.col("n").between(1, MOST_SMALL)).groupBy("n").count().collect()}
    most_small = boundary(sizes, percent)
    chosen = hash_bits(points.select("row_hash"))
    postings = stored(listings(rows, chosen, often, k, percent, most_small), "jaccard-postings")
    lists = _shared(postings)
    rows_of_lists = lists.count()
    links = stored(gathered(_stars(lists, percent), rows_of_lists), "jaccard-links")
    lists = lists.filter("o = 0").drop("o")
    first = lists.groupBy("token").agg(F.min(F.struct("key", "n", "place")).alias("one")).select("token", "one.*")
    tried = stored(gathered(_pairs(lists, first, percent), rows_of_lists), "jaccard-pairs")
    near = done = stored(gathered(_near(tried, points, percent), tried.count()), "jaccard-near")
    lists = lists.filter("members > 2").drop("members")  # of two sets one is the other's pivot
    texts = _texts_of(rows, _ends(near, points), k)
    fresh = stored(compared(near, texts, k, percent), "jaccard-links")
    roots, pivots_of_list = connected(links.unionByName(fresh), links.count() + fresh.count()), 1
    while True:
        marked = lists.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("root", "key")).drop("root")
        still = (marked.groupBy("token").agg(F.count("*").alias("members"), F.min("component").alias("x"), F.max("component").alias("y"))
                 .filter(f"x != y AND members > 2 AND members > {pivots_of_list}").select("token", "members"))
        marked = stored(gathered(marked.join(still, "token"), rows_of_lists), "jaccard-open")
        if marked.isEmpty():
            return roots
        pivots_of_list *= PIVOTS_GROW
        # a list's pivots are its sets with the lowest hashes of their keys: about so many of its members
        low = f"CAST(pmod(xxhash64(key), 1000003) AS BIGINT) * members < {pivots_of_list} * 1000003L"
        lists = marked.drop("component", "members")
        # parities are looked at where a member meets a pivot: only pairs that may link are made
        marked = marked.join(points.select("key", "bits"), "key")
        pairs = _pairs(marked, marked.filter(low).drop("members"), percent, "component != p_component", _may_link(percent, "bits", "p_bits"))
        near = stored(pairs.join(done, ["a", "b"], "left_anti"), "jaccard-near")
        if near.isEmpty():
            continue
        done = done.unionByName(near)
        texts = texts.unionByName(_texts_of(rows, _ends(near, points).join(texts.select("key"), "key", "left_anti"), k))
        fresh = stored(compared(near, texts, k, percent), "jaccard-links")
        if not fresh.isEmpty():  # stars so far and the new links between them
            roots = connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(fresh), roots.count() + fresh.count())


def components(docs: DataFrame, *, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: doc_id, n_shingles and component_id (the smallest doc_id that links reach)."""
    rows = id_text(docs, id_col, text_col)
    sets, often = described(rows, k)
    points = stored(gathered(sets.filter("n > 0").groupBy("key").agg(
        F.first("n").alias("n"), F.first("bits").alias("bits"), F.min(F.struct("doc_id", "row_hash")).alias("row"), F.min("doc_id").alias("smallest"))
        .select("key", "n", "bits", "row.doc_id", "row.row_hash", "smallest"), sets.count()), "jaccard-points")
    roots = linked_sets(rows, points, often, k, percent)
    rooted = points.join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "key", F.coalesce("root", "key").alias("root"), "smallest")
    ids = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = rooted.join(ids, "root").select("key", "component_id")
    full = sets.filter("n > 0").join(named, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = sets.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return gathered(full.unionByName(empty), sets.count())
