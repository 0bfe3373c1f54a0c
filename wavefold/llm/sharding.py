"""Balanced shards by label propagation under quotas (operator 2).

Documents that share a link key (here: equal texts) are linked. Law ``rows``:
shard sizes differ by at most one row; within that, as few links as possible
are cut.

Method: every document starts in a shard dealt by a hash of its id, and each
linked key counts its documents by shard. A key then moves as a whole to the
shard where most of its documents are, among the shards that still have room
for all of it; ties, and keys whose own shards are full, go by a hash weighted
by the rooms. Rooms are the exact sizes of the shards. Each round a shard admits
keys by steps of a hash, as many steps as fit; refused keys wish again among the
shards that have room left. Keys move in classes of halved size, largest first,
and the rounds of a class go on while a key of it fits anywhere. They are the
same rounds for a table of any size. Unlinked documents carry no cut and fill
what the keys leave.

The driver sees a histogram of shards x steps each round, and the keys larger
than a room (fewer than there are shards), which must be cut: it lays them over
the shards with most room before the rounds. A key below a room is only cut
where the rooms left are all smaller than the key. Hashes are of ids and keys and
rows that tie in id, key, size and CRC are alike, so the layout of the input does
not matter: the same rows give the same result.

At the end rows are numbered in the order (rank, key, id), in the cluster, where
the rank tells cut keys, keys without a shard, unlinked rows and each shard's keys apart; ranges of the
numbers are the shards. That makes the sizes exact.

A document's links are never listed in pairs: a key's documents are counted by
shard (at most k rows for a key), and that table is joined to the documents.

Defined cases: a null text has size 1 and is linked to other null texts only,
apart from empty ones; null ids are placed like others; repeated rows are rows;
fewer rows than shards leave shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavefold.llm.common import stored

#: Steps in which a shard's quota is dealt to movers.
QUOTA_STEPS = 256
#: Rounds in which keys wish for their own shards first; later ones go by the rooms alone.
OWN_ROUNDS = 4
#: Rounds in a row that may place nothing before the rest of a class is left to the numbering.
IDLE_ROUNDS = 3
#: Classes of size: keys above a half of a room, above a quarter, and so on; the last has all smaller ones.
CLASSES = 9


def text_key(text: Column) -> Column:
    """A key that equal texts share: 64-bit hash, CRC-32 and length; null for null."""
    return F.when(text.isNotNull(), F.struct(F.xxhash64(text).alias("h"), F.crc32(text).alias("c"), F.octet_length(text).alias("n")))


class _Rooms:
    """What the driver knows of the shards: rows left and placed, and the keys that are cut."""

    def __init__(self, total: int, shards: int):
        borders = [-(-s * total // shards) for s in range(shards + 1)]
        self.left = [hi - lo for lo, hi in zip(borders, borders[1:])]
        self.room = max(self.left)
        self.placed = [0] * shards
        self.cut: list[list[tuple[int, int]]] = []  # per cut key its (shard, rows)

    def take(self, shard: int, n: int) -> None:
        self.left[shard] -= n
        self.placed[shard] += n

    def lay(self, keys: list) -> list[tuple[int, int | None, int | None]]:
        """(kid, no home, cut) of keys larger than a room, largest first."""
        out = []
        for r in sorted(keys, key=lambda r: (-r["size"], r["hid"], r["kid"])):
            pieces, n = [], r["size"]
            while n:
                fits = [s for s, left in enumerate(self.left) if left >= n]
                s = min(fits, key=lambda s: self.left[s]) if fits else max(range(len(self.left)), key=lambda s: self.left[s])
                part = min(n, self.left[s])
                self.left[s] -= part
                pieces.append((s, part))
                n -= part
            out.append((r["kid"], None, len(self.cut)))
            self.cut.append(pieces)
        return out

    def ranges(self) -> list[tuple[int, int, int, int]]:
        """(from, to, shard, slot of the first) over the row numbers: cut keys, free rows, each shard's keys."""
        free = sorted(((s, n) for s, n in enumerate(self.left)), key=lambda x: -x[1])
        out, at, used = [], 0, [0] * len(self.left)
        for s, n in [*(x for pieces in self.cut for x in pieces), *free, *enumerate(self.placed)]:
            if n:
                out.append((at, at + n, s, used[s]))
            at, used[s] = at + n, used[s] + n
        return out


def _dealt(shards: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")


def _wish(left: list[int], round_: int) -> Column:
    """The shard a key asks for: one with room for all of it, by its own rows there, then by a hash weighted by room."""
    lefts = F.array(*(F.lit(n).cast("long") for n in left))
    own = (lambda s: F.coalesce(F.get(F.filter("at", lambda x: x["label"] == s), 0)["n"], F.lit(0))) if round_ < OWN_ROUNDS else (
        lambda s: F.lit(0).cast("long"))
    chance = lambda s: F.log((F.pmod(F.xxhash64("hid", s, F.lit(round_)), F.lit(1 << 30)) + 1) / F.lit(float((1 << 30) + 1)))
    open_ = F.filter(F.sequence(F.lit(0), F.lit(len(left) - 1)), lambda s: F.get(lefts, s) >= F.col("size"))
    return F.array_max(F.transform(open_, lambda s: F.struct(
        own(s).alias("n"), (chance(s) / F.get(lefts, s)).alias("chance"), s.alias("s"))))["s"]


def _class(room: int) -> Column:
    """How often a key's size can be doubled within a room, up to the last class."""
    return sum((F.col("size") * (1 << j) <= room).cast("int") for j in range(1, CLASSES))


def _place(rows: DataFrame, shards: int, rounds: int | None) -> tuple[DataFrame, _Rooms]:
    """Linked keys with their ``home`` shard or ``cut`` number, and the rooms. Neither: no shard had room for the key."""
    spark = rows.sparkSession
    rooms = _Rooms(rows.count(), shards)
    keys = stored(rows.groupBy("key", _dealt(shards).alias("label")).agg(F.count("*").alias("n"))
                  .groupBy("key").agg(F.sum("n").alias("size"), F.collect_list(F.struct("n", "label")).alias("at"))
                  .filter("size > 1").withColumn("class", _class(rooms.room)).withColumn("hid", F.xxhash64("key"))
                  .withColumn("kid", F.monotonically_increasing_id()), "shard-keys")
    homes, laid, classes = [], [], []
    if rounds != 0:
        fit = keys.filter(F.col("size") <= rooms.room)
        laid = rooms.lay(keys.filter(F.col("size") > rooms.room).select("kid", "hid", "size").collect())
        classes = sorted(r["class"] for r in fit.select("class").distinct().collect())
    for class_ in classes:
        waiting = fit.filter(F.col("class") == class_).select("kid", "hid", "size", "at")
        round_ = idle = 0
        while (rounds is None or round_ < rounds) and idle < IDLE_ROUNDS:
            wishes = waiting.withColumn("best", _wish(rooms.left, round_)).withColumn(
                "step", F.pmod(F.xxhash64("hid", F.lit(17 + round_)), F.lit(QUOTA_STEPS)).cast("int"))
            asked = wishes.filter("best is not null").groupBy("best", "step").agg(F.sum("size").alias("n")).collect()
            if not asked:
                break
            admitted = []
            for r in sorted(asked, key=lambda r: (r["best"], r["step"])):
                if r["n"] <= rooms.left[r["best"]]:
                    rooms.take(r["best"], r["n"])
                    admitted.append((r["best"], r["step"], r["best"]))
            if admitted:
                quota = spark.createDataFrame(admitted, "best int, step int, home int")
                decided = stored(wishes.join(F.broadcast(quota), ["best", "step"], "left").select(
                    "kid", "hid", "size", "at", "home"), "shard-wishes")
                homes.append(decided.filter("home is not null").select("kid", "home", F.lit(None).cast("int").alias("cut")))
                waiting = decided.filter("home is null").drop("home")
            idle = 0 if admitted else idle + 1
            round_ += 1
    settled = spark.createDataFrame(laid, "kid long, home int, cut int")
    for part in homes:
        settled = settled.union(part)
    # written before the join, so that a join of a hot key has two plain sides and can be split
    return stored(keys.select("key", "kid").join(settled, "kid", "left").drop("kid"), "shard-homes"), rooms


def _with_homes(rows: DataFrame, homes: DataFrame) -> DataFrame:
    known = homes.select(F.col("key").alias("__key"), "home", "cut", F.lit(True).alias("__linked"))
    return rows.join(known, F.col("key").eqNullSafe(F.col("__key")), "left").withColumn(
        "linked", F.col("__linked").isNotNull()).drop("__key", "__linked")


def propagate(rows: DataFrame, shards: int, rounds: int | None = None) -> DataFrame:
    """Adds ``label`` to rows of ``(row, key)``: linked rows drawn together within the rooms.

    ``row`` is the rows' id, whose hash deals them; ``key`` links them. Rows of keys that are cut, and
    unlinked ones, keep the shard they were dealt. ``rounds`` bounds the rounds;
    0 leaves all rows as dealt.
    """
    homes, _ = _place(rows, shards, rounds)
    return _with_homes(rows.select("row", "key"), homes).select(
        "row", "key", "linked", F.coalesce("home", _dealt(shards)).alias("label"))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``number``, 0.. in the given order, without bringing the rows to one task."""
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(ranged.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "numbers")
    sums = sorted((r["__part"], r["n"], r["first"]) for r in kept.groupBy("__part").agg(
        F.count("*").alias("n"), F.min("__at").alias("first")).collect())  # a row for each range
    before, bases = 0, []
    for part, n, first in sums:
        bases.append((part, before - first))
        before += n
    base = spark.createDataFrame(bases, "__part int, __base long")
    return kept.join(F.broadcast(base), "__part").select(
        *(c for c in kept.columns if not c.startswith("__")), (F.col("__base") + F.col("__at")).alias("number"))


def shard(docs: DataFrame, shards: int, *, rounds: int | None = None, id_col: str = "doc_id", text_col: str = "text",
          key: Column | None = None) -> DataFrame:
    """Per document row: doc_id, size, text_crc32, shard and slot (its place in the shard).

    ``key`` links documents; by default equal texts are linked.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = docs[text_col].cast("string")
    rows = stored(docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        (text_key(text) if key is None else key).alias("key"), F.monotonically_increasing_id().alias("row")), "shard-rows")
    homes, rooms = _place(rows.select(F.col("doc_id").alias("row"), "key"), shards, rounds)
    cuts = len(rooms.cut)
    rank = F.coalesce("cut", F.col("home") + F.lit(cuts + 2), F.when(F.col("linked"), F.lit(cuts)).otherwise(F.lit(cuts + 1)))
    placed = _numbered(_with_homes(rows, homes).withColumn("rank", rank), ["rank", "key", "doc_id", "size", "text_crc32", "row"])
    ranges = rows.sparkSession.createDataFrame(rooms.ranges(), "lo long, hi long, shard int, first long")
    return (placed.join(F.broadcast(ranges), (F.col("number") >= F.col("lo")) & (F.col("number") < F.col("hi")))
            .withColumn("slot", F.col("number") - F.col("lo") + F.col("first"))
            .select("doc_id", "size", "text_crc32", "shard", "slot", "linked", "key"))
