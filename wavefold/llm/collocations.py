"""Phrase collocations by SON partitioning (operator 13).

A-Z is lower-cased; texts are cut at ``[.,;:!?`` and line ends ``]`` into pieces and those at
spaces and tabs into words. Phrases are two to MAX_WORDS words that follow each
other in a piece; everything is counted per language (null: ``und``).

Method:

1. Every document goes to one of SHARDS shards by a hash of its id and text. A phrase
   found ``support`` times in N words is found at least ``ceil(support * n / N)`` times in
   some shard of n words: that is the shard's own, proportionally lowered support.
2. Each shard is mined completely, level by level: words, then pairs of frequent words,
   then phrases of three and four words whose pairs are all frequent. A phrase is never
   more frequent than a part of it, so nothing is lost. Tasks count a few million words
   at a time in numpy; Spark adds the counts up by (shard, 64-bit hash of the phrase). Equal
   hashes only make a count larger, so a collision can add a candidate, never lose one.
3. What is frequent in any shard is a candidate. A last pass counts the candidates in the
   whole corpus, by the phrases themselves: those counts are exact.

What a level has found reaches the next pass as a bitmap of hashes (``bitmaps``), of a checked size;
a full bitmap lets more phrases pass to be counted, with the same result. No counts and no phrases go through the driver.

Score: the lowest over the cuts of a phrase, ``floor(2000000 * a / (l + r))``, in decimals.
A phrase inside a longer candidate that is (nearly) as frequent is dropped.

Defined cases: null and empty texts have no words; repeated rows count every time; null
ids are ids like others; ties rank by count, then by phrase in byte order; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavefold.llm.bitmaps import hash_bits, hit
from wavefold.llm.common import drop_worker_state, rows_of, stored
from wavefold.llm.words import Vocabulary, chained

SHARDS, MAX_WORDS = 3, 4
#: Words counted at once in a task.
CHUNK_WORDS = 2_000_000
#: Parts of a phrase are looked up under so many copies, so that phrases with one common part spread.
SALTS = 8

#: Bytes that end a piece; the byte that stands for them is in no UTF-8 text.
_END = b"\xff"
_CUT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _END * 10 + b" ")

#: What a pass does: count words, pairs, or phrases of three and four words, or count candidates.
WORDS, PAIRS, PHRASES, CANDIDATES = range(4)


def words_of(text: str) -> list[bytes]:
    """The text's words in order, with ``_END`` wherever a piece ends."""
    return text.encode().lower().translate(_CUT).replace(_END, b" \xff ").split(b" ")


class _Counter:
    """Counts phrases of a few million words of one group at a time."""

    def __init__(self, what: int, word_bits, pair_bits, phrase_bits):
        self.what, self.word_bits, self.pair_bits, self.phrase_bits = what, word_bits, pair_bits, phrase_bits
        self.clear()

    def clear(self) -> None:
        self.vocabulary = Vocabulary()
        self.vocabulary[_END], self.vocabulary[b""]  # numbers 0 and 1
        self.parts: dict[tuple, list[np.ndarray]] = {}
        self.size = 0

    def add(self, key: tuple, text: str) -> None:
        x = self.vocabulary.numbers(words_of(text))
        x = x[x != 1]
        self.parts.setdefault(key, [np.zeros(1, np.int64)]).extend((x, np.zeros(1, np.int64)))
        self.size += len(x)

    def counts(self) -> Iterator[tuple[tuple, int, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """(group, number of words, hashes, counts, the words' numbers place by place)."""
        spelled = self.vocabulary.hashes()
        v = len(spelled)
        for key, parts in self.parts.items():
            lang, shard = key[0], key[1]
            x = np.concatenate(parts)
            g1 = chained(np.full(v, xxhash.xxh64_intdigest(lang.encode()), np.uint64), spelled)
            counted = np.bincount(x, minlength=v)
            ok = hit(self.word_bits, g1 ^ np.uint64(shard)) & (counted > 0)
            ok[:2] = False
            if self.what in (WORDS, CANDIDATES):
                own = np.flatnonzero(ok)
                yield key, 1, g1[own], counted[own], [own]
                if self.what == WORDS:
                    continue
            at = np.flatnonzero(ok[x[:-1]] & ok[x[1:]])
            code, place, count = np.unique(x[at] * v + x[at + 1], return_inverse=True, return_counts=True)
            a, b = code // v, code % v
            g2 = chained(g1[a], spelled[b])
            if self.what == PAIRS:
                yield key, 2, g2, count, [a, b]
                continue
            ok = hit(self.pair_bits, g2 ^ np.uint64(shard))
            if self.what == CANDIDATES:
                yield key, 2, g2[ok], count[ok], [a[ok], b[ok]]
            pair = np.full(len(x), -1)
            keep = ok[place]
            pair[at[keep]] = place[keep]
            at = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
            code, count = np.unique(pair[at] * v + x[at + 2], return_counts=True)
            p, c = code // v, code % v
            g3 = chained(g2[p], spelled[c])
            ok = hit(self.phrase_bits, g3 ^ np.uint64(shard))
            yield key, 3, g3[ok], count[ok], [a[p[ok]], b[p[ok]], c[ok]]
            at = at[:-1][at[1:] == at[:-1] + 1]
            code, count = np.unique(pair[at] * len(g2) + pair[at + 2], return_counts=True)
            p, q = code // max(1, len(g2)), code % max(1, len(g2))
            g4 = chained(chained(g2[p], spelled[a[q]]), spelled[b[q]])
            ok = hit(self.phrase_bits, g4 ^ np.uint64(shard))
            p, q = p[ok], q[ok]
            yield key, 4, g4[ok], count[ok], [a[p], b[p], a[q], b[q]]


def _counted(texts: DataFrame, what: int, bits: dict[int, Broadcast | None]) -> DataFrame:
    """Partial counts of a pass: (g, shard, need, c) of hashes, or (lang, words, phrase, c) of candidates."""
    by_phrase = what == CANDIDATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        loaded = [bits[k].value if bits.get(k) is not None else None for k in (WORDS, PAIRS, PHRASES)]
        counter = _Counter(what, *loaded)

        def flushed() -> Iterator[pa.RecordBatch]:
            names = np.array(counter.vocabulary.words, object)
            for (lang, shard, need), n, g, c, places in counter.counts():
                if not len(g):
                    continue
                if by_phrase:
                    phrases = [b" ".join(ws).decode() for ws in zip(*(names[p].tolist() for p in places))]
                    made = {"lang": pa.array([lang] * len(c)), "words": pa.array(np.full(len(c), n, np.int32)),
                            "phrase": pa.array(phrases)}
                else:
                    made = {"g": pa.array(g.view(np.int64)), "shard": pa.array(np.full(len(c), shard, np.int32)),
                            "need": pa.array(np.full(len(c), need, np.int64))}
                    if what == WORDS:
                        made["lang"] = pa.array([lang] * len(c))
                yield pa.RecordBatch.from_pydict(made | {"c": pa.array(c.astype(np.int64))})
            counter.clear()

        for langs, shards, needs, own in rows_of(batches, "lang", "shard", "need", "text"):
            for lang, shard, need, text in zip(langs, shards, needs, own):
                counter.add((lang, 0 if by_phrase else shard, need), text)
                if counter.size >= CHUNK_WORDS:
                    yield from flushed()
        yield from flushed()

    schema = "lang string, words int, phrase string, c long" if by_phrase else (
        "g long, shard int, need long, lang string, c long" if what == WORDS else "g long, shard int, need long, c long")
    return texts.select("lang", "shard", "need", "text").mapInArrow(run, schema)


def _in_shard(mined: DataFrame) -> DataFrame:
    return mined.select(F.col("g").bitwiseXOR(F.col("shard").cast("long")).alias("g"))


def phrase_counts(docs: DataFrame, support: int = 30, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """Exact counts of all words and phrases found ``support`` times or more, and the number of words.

    Returns ``(lang, words, phrase, a)`` with words from one to MAX_WORDS, and ``(lang, n)``.
    """
    texts = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
        F.pmod(F.xxhash64(docs[id_col].cast("long"), docs[text_col].cast("string")), F.lit(shards)).cast("int").alias("shard"))
    # no supports are known before the words are counted
    first = _counted(texts.withColumn("need", F.lit(0).cast("long")), WORDS, {})
    words = stored(first.groupBy("lang", "shard", "g").agg(F.sum("c").alias("c")), "son-words")
    sizes = words.groupBy("lang", "shard").agg(F.sum("c").alias("n_shard"))
    totals = stored(sizes.groupBy("lang").agg(F.sum("n_shard").alias("n")), "son-totals")
    needs = stored(sizes.join(totals, "lang").select(
        "lang", "shard", F.ceil(F.expr(f"({support} * n_shard + n - 1) div n")).cast("long").alias("need")), "son-needs")
    ready = texts.join(needs, ["lang", "shard"])
    mined = {WORDS: stored(words.join(needs, ["lang", "shard"]).filter("c >= need").select("g", "shard"), "son-1")}
    bits = {WORDS: hash_bits(_in_shard(mined[WORDS]))}
    for level in (PAIRS, PHRASES):
        level_counts = _counted(ready, level, bits).groupBy("g", "shard").agg(F.sum("c").alias("c"), F.min("need").alias("need"))
        mined[level] = stored(level_counts.filter("c >= need").select("g", "shard"), f"son-{level + 1}")
        if level == PAIRS:
            bits[PAIRS] = hash_bits(_in_shard(mined[PAIRS]))
    union = {k: hash_bits(m.select("g").distinct()) for k, m in mined.items()}
    counted = (_counted(texts.withColumn("need", F.lit(0).cast("long")), CANDIDATES, union)
               .groupBy("lang", "words", "phrase").agg(F.sum("c").alias("a")).filter(F.col("a") >= support))
    counts = stored(counted, "son-counts")
    for b in (*bits.values(), *union.values()):
        b.unpersist()
    return counts, totals


def _slice(start, length):
    return F.array_join(F.slice("ws", start, length), " ")


def collocations(docs: DataFrame, *, support: int = 30, top: int = 2000, inside_percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text", lang_col: str = "lang", shards: int = SHARDS) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = phrase_counts(docs, support, id_col, text_col, lang_col, shards)
    split = counts.withColumn("ws", F.split("phrase", " "))
    longer = split.filter("words > 2")
    parts = F.array_distinct(F.concat(
        F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda i: F.array_join(F.slice("ws", i, 2), " ")),
        F.when(F.col("words") == 4, F.array(_slice(1, 3), _slice(2, 3))).otherwise(F.array().cast("array<string>"))))
    around = (longer.select("lang", F.explode(parts).alias("phrase"), F.col("a").alias("around"))
              .groupBy("lang", "phrase").agg(F.max("around").alias("around")))
    left = (split.filter("words > 1").join(around, ["lang", "phrase"], "left")
            .filter(f"around IS NULL OR 100 * around < {inside_percent} * a"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    cuts = left.select("lang", "phrase", "a", "words", salt.alias("salt"), "ws",
                       F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "salt", "k", _slice(1, F.col("k")).alias("first"),
        _slice(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    known = counts.filter(f"words < {MAX_WORDS}").select(
        "lang", F.col("phrase").alias("part"), F.col("a").alias("f"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    scored = (cuts
              .join(known.withColumnsRenamed({"part": "first", "f": "l"}), ["lang", "first", "salt"])
              .join(known.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest", "salt"])
              .withColumn("score", F.expr("CAST((CAST(a AS DECIMAL(20, 0)) * 2000000) div CAST(l + r AS DECIMAL(20, 0)) AS BIGINT)"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each language are among the first of its parts, so no task sorts a whole language
    for parts_of in (1024, 16):
        part = F.pmod(F.xxhash64("phrase", F.lit(parts_of)), F.lit(parts_of))
        within = Window.partitionBy("lang", "part").orderBy(*best)
        scored = (scored.withColumn("part", part).withColumn("rank", F.row_number().over(within))
                  .filter(F.col("rank") <= top).drop("rank", "part"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
