"""Line deduplication within one edit, by a deletion-neighbourhood join (operator 4).

Lines are what ``\\n`` separates, compared without outer ASCII white space and in
lower case. A line is dropped if an earlier line is equal or one edit (a
character inserted, deleted or replaced) away; earlier is by document id, then
line number. Lines of fewer than ``min_chars`` characters say too little to be
compared within an edit; of them, those of at least ``fold_chars`` characters (by
default all but blank ones) are dropped if an earlier line is equal, and shorter ones
always stay.

Method, DataFrame functions only:

1. Equal lines are folded to their first place by a partial aggregate over
   hashes, so a line that a third of all documents share is one row.
2. Halving, which loses no pair: of two lines one edit apart the longer is what
   stands before the edit, the edit, and what stands behind it, so with the shorter
   cut in two, one half is the same in both. Each line sends the hash of either half
   (for its own length, and as the longer of a pair for one less); a line whose
   halves nobody shares has no neighbour. The texts of the few left are cut
   further, eight parts at a time, down to regions of at most REGION_CHARS.
3. Deletion neighbourhood of the regions: every variant with one character
   deleted is emitted as a hashed key, with its place for replacements, and
   joined to equal variants. The lines under such a key are all one edit from
   each other (or, for insertions, from the one shorter line), so the key's
   earliest line settles all of them, and no pairs are listed.
4. Each line is verified against that earliest partner by its edit distance.
5. The places that stay are gathered by document and the texts cut down to them.

Defined cases: a null text has no lines and stays null; an empty text stays
empty; a document may lose all its lines, its text is then empty; null ids come
first; of rows equal in id and text, one keeps its lines; an empty table stays
empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavefold.llm.common import stored

MIN_CHARS = 16
REGION_CHARS = 32
#: Parts into which a region is cut per round.
PARTS = 8
#: Candidate lines whose places (24 bytes each) are broadcast; more are shuffled.
MAX_BROADCAST_LINES = 500_000

LINE = ["k1", "k2"]
PLACE = ["doc_id", "h", "line_no"]


def _norm(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h, line_no, norm, n) of the lines that are compared; h stands for the whole text."""
    # normalised before they are dealt out, so that no later step computes it again
    each = docs.select("doc_id", F.xxhash64("text").alias("h"),
                       F.posexplode(F.transform(F.split("text", "\n"), _norm)).alias("line_no", "norm"))
    return each.withColumn("n", F.length("norm")).filter(F.col("n") >= min_chars)


def _region_key(m: Column, a: Column, b: Column) -> Column:
    """Hash of all but the region [a, b) of a line of n characters, seen as one of a pair whose shorter has m."""
    return F.xxhash64(m, a, b, F.substring(F.col("norm"), F.lit(1), a),
                      F.substring(F.col("norm"), F.col("n") - m + b + 1, m - b))


def _first_places(lines: DataFrame) -> DataFrame:
    """Each distinct line: key, first place, length and the hashes of its halves."""
    n = F.col("n")
    halves = []
    for m in (n, n - 1):
        c = F.floor(m / 2).cast("int")
        halves += [_region_key(m, F.lit(0), c), _region_key(m, c, m)]
    keyed = lines.select(F.xxhash64("norm").alias("k1"), F.hash("norm", F.lit(7)).alias("k2"),
                         F.struct(*PLACE).alias("place"), "n", *(x.alias(f"r{i}") for i, x in enumerate(halves)))
    rest = ["n", "r0", "r1", "r2", "r3"]
    return keyed.groupBy(*LINE).agg(F.min(F.struct("place", *rest)).alias("f")).select(
        *LINE, F.col("f.place").alias("first"), *(F.col(f"f.{c}").alias(c) for c in rest))


def _shared(rows: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose key another line has as well."""
    known = rows.groupBy(key).agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo != hi").select(
        F.col(key).alias("__key"))
    return rows.join(known, rows[key] == known["__key"], "left_semi")


def _candidates(firsts: DataFrame, docs: DataFrame, min_chars: int) -> DataFrame:
    """Lines that share a half: (k1, k2, first, n, norm, m, a, b), a row for each shared half."""
    halves = F.array(*(F.struct(F.col(f"r{k}").alias("key"), F.lit(k).alias("half")) for k in range(4)))
    shared = _shared(firsts.select(*LINE, F.inline(halves))).drop("key")
    # half 0 and 1 as a line of its own length, 2 and 3 as the longer of a pair
    m = F.col("n") - F.when(F.col("half") >= 2, F.lit(1)).otherwise(F.lit(0))
    c, second = F.floor(m / 2).cast("int"), F.col("half") % 2 == 1
    found = stored(shared.join(firsts.select(*LINE, "first", "n"), LINE).select(
        *LINE, "first", "n", m.alias("m"), F.when(second, c).otherwise(F.lit(0)).alias("a"),
        F.when(second, m).otherwise(c).alias("b")), "line-candidates")
    # the texts of the candidates, from their first places
    places = found.select(*LINE, "first").distinct().select(
        *(F.col(f"first.{c}").alias(f"__{c}") for c in PLACE), F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
    if places.limit(MAX_BROADCAST_LINES + 1).count() <= MAX_BROADCAST_LINES:
        places = F.broadcast(places)
    here = docs.join(places, docs["doc_id"].eqNullSafe(F.col("__doc_id")) & (F.xxhash64(docs["text"]) == F.col("__h")), "left_semi")
    texts = _lines(here, min_chars).join(places, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("h") == F.col("__h"))
                                         & (F.col("line_no") == F.col("__line_no")))
    texts = texts.select(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), "norm").dropDuplicates(LINE)
    return stored(found.join(texts, LINE), "line-texts")


def _narrowed(rows: DataFrame) -> DataFrame:
    """Regions cut into parts until they are short; parts that no two lines share go."""
    longest = rows.agg(F.max(F.expr("b - a"))).first()[0] or 0
    while longest > REGION_CHARS:
        width = F.ceil((F.col("b") - F.col("a")) / PARTS).cast("int")
        cut = F.when(F.col("b") - F.col("a") <= REGION_CHARS, F.array(F.struct("a", "b"))).otherwise(
            F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.struct(
                F.least(F.col("a") + i * F.col("w"), F.col("b")).alias("a"),
                F.least(F.col("a") + (i + 1) * F.col("w"), F.col("b")).alias("b"))))
        parts = (rows.withColumn("w", width).withColumn("cut", cut).drop("a", "b", "w")
                 .select("*", F.inline("cut")).drop("cut").distinct())
        keyed = parts.withColumn("key", _region_key(F.col("m"), F.col("a"), F.col("b")))
        rows = stored(_shared(keyed).drop("key"), "line-regions")
        longest = -(-longest // PARTS)
    return rows


def _earlier_neighbours(rows: DataFrame) -> DataFrame:
    """(k1, k2, first, partner): an earlier place whose line shares a variant."""
    mid = rows.withColumn("key", _region_key(F.col("m"), F.col("a"), F.col("b"))).withColumn(
        "mid", F.expr("substring(norm, a + 1, b - a + n - m)"))
    places = F.when(F.length("mid") > 0, F.sequence(F.lit(1), F.length("mid"))).otherwise(F.array().cast("array<int>"))
    without = lambda p: F.concat(F.expr("mid").substr(F.lit(1), p - 1), F.expr("mid").substr(p + 1, F.length("mid")))
    # role 0: one of equal lengths that differ at p; role 1: the shorter itself; role 2: the longer without a character
    variants = F.when(F.col("n") == F.col("m"), F.concat(
        F.transform(places, lambda p: F.struct(F.lit(0).alias("role"), F.xxhash64("key", p, without(p)).alias("variant"))),
        F.array(F.struct(F.lit(1).alias("role"), F.xxhash64("key", F.lit(0), "mid").alias("variant"))))
    ).otherwise(F.array_distinct(F.transform(
        places, lambda p: F.struct(F.lit(2).alias("role"), F.xxhash64("key", F.lit(0), without(p)).alias("variant")))))
    sent = stored(mid.select(*LINE, "first", F.inline(variants)), "line-variants")
    of = lambda r: F.min(F.when(F.col("role") == r, F.col("first")))
    line = F.struct(*LINE)
    known = (sent.groupBy("variant").agg(of(0).alias("e0"), of(1).alias("e1"), of(2).alias("e2"),
                                         F.min(line).alias("lo"), F.max(line).alias("hi"))
             .filter("lo != hi").drop("lo", "hi"))
    partner = F.when(F.col("role") == 0, F.col("e0")).when(F.col("role") == 1, F.col("e2")).otherwise(F.col("e1"))
    return (sent.join(known, "variant").withColumn("partner", partner).filter("partner < first")
            .select(*LINE, "first", "partner").distinct())


def near_lines(docs: DataFrame, min_chars: int = MIN_CHARS, fold_chars: int = 1) -> tuple[DataFrame, DataFrame]:
    """Distinct lines with their first places, and those of them with an earlier line one edit away.

    ``docs`` has ``(doc_id, text)``; texts without nulls.
    """
    lines = _lines(docs, min(fold_chars, min_chars))
    firsts = stored(_first_places(lines), "line-firsts")
    candidates = _candidates(firsts.filter(F.col("n") >= min_chars), docs, min_chars)
    found = _earlier_neighbours(_narrowed(candidates))
    texts = candidates.select(*LINE, "first", "norm").dropDuplicates(LINE)
    checked = (found.drop("first").join(texts.select(*LINE, "norm"), LINE)
               .join(texts.select(F.col("first").alias("partner"), F.col("norm").alias("other")), "partner")
               .filter(F.levenshtein("norm", "other", 1) == 1))
    return firsts, stored(checked.select(*LINE).distinct(), "line-near")


def kept_lines(docs: DataFrame, min_chars: int = MIN_CHARS, fold_chars: int = 1) -> DataFrame:
    """(doc_id, h, keep): per document the numbers of its compared lines that stay."""
    firsts, near = near_lines(docs, min_chars, fold_chars)
    kept = firsts.select(*LINE, "first").join(near, LINE, "left_anti")
    return kept.groupBy("first.doc_id", "first.h").agg(F.collect_list("first.line_no").alias("keep"))


def dedup(docs: DataFrame, *, min_chars: int = MIN_CHARS, fold_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, same columns, its texts without the dropped lines, and ``__n_lines`` and ``__n_kept`` (long)."""
    text = F.col(f"`{text_col}`").cast("string")
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    keep = kept_lines(base, min_chars, fold_chars).select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), F.col("keep").alias("__keep"))
    marked = docs.withColumn("__own_id", F.col(f"`{id_col}`").cast("long")).withColumn(
        "__own_h", F.xxhash64(F.coalesce(text, F.lit(""))))
    joined = marked.join(keep, F.col("__own_id").eqNullSafe(F.col("__id")) & (F.col("__own_h") == F.col("__h")), "left")
    # of rows equal in id and text only one keeps its lines
    same = Window.partitionBy("__own_id", "__own_h").orderBy("__own_h")
    numbered = joined.withColumn("__first", F.row_number().over(same) == 1)
    floor = min(fold_chars, min_chars)
    lines = F.split(text, "\n")
    keep_here = F.when(F.col("__first"), F.coalesce("__keep", F.array().cast("array<int>"))).otherwise(F.array().cast("array<int>"))
    # places to keep (tag 0) sorted in before their lines (tag 1)
    merged = F.array_sort(F.concat(
        F.transform(keep_here, lambda i: F.struct(i.alias("i"), F.lit(0).alias("tag"), F.lit("").alias("line"))),
        F.transform(lines, lambda x, i: F.struct(i.alias("i"), F.lit(1).alias("tag"), x.alias("line")))))
    stays = lambda all_: F.filter(all_, lambda s, k: (s["tag"] == 1) & (
        (F.length(_norm(s["line"])) < floor) | ((k > 0) & (F.get(all_, k - 1)["i"] == s["i"]))))
    left = F.transform(F.array(merged), stays)[0]
    out = numbered.withColumn("__left", left)
    columns = [F.array_join(F.col("__left.line"), "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns, F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("__n_lines"),
                      F.coalesce(F.size("__left"), F.lit(0)).cast("long").alias("__n_kept"))
