import re
from collections import Counter

from pyspark.sql import Row
from pyspark.sql import functions as F

from wavefold.llm import quality_rules as q


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {p for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)),
            len(covered), sum(a == b for a, b in zip(w, w[1:])), text.count("!"))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutter", "n_exclaims")
TEXTS = [None, "", " \n\t ", "one", " lead and trail ", "a b c d e f g h", "a b c d e f g h a b c d e f g h",
         "x " * 30, "a b c d e f g h i " * 3 + "z", "#*$%&|<> a#b", "wow! " * 25, "é日🙂 ß\x0bq\x0cr\rs\x1ct u",
         "l one\n\nl one\n  \nl one \nl two", " ".join(f"w{i}" for i in range(30_000)) + " w5 w6 w7 w8 w9 w10 w11 w12",
         "same words here " * 9 + "but then others " * 2]


def test_measurements_match_plain(spark):
    df = spark.createDataFrame([Row(doc_id=i % 5, text=t, n_words="clash") for i, t in enumerate(TEXTS)])
    got = sorted((r.doc_id, *(r[c] for c in COLUMNS)) for r in q.measure(df).collect())
    assert got == sorted((i % 5, *plain(t)) for i, t in enumerate(TEXTS))


def test_ledger_policies_and_ablations(spark):
    rows = q.ledger(spark.createDataFrame([Row(doc_id=i, text=t) for i, t in enumerate(TEXTS)])).cache()
    got = rows.collect()
    for r in got:
        failed = {name for name in q.RULES if r.failures & q.bit(name)}
        assert ("few_words" in failed) == (r.n_words < 20)
        assert ("repeated_windows" in failed) == (100 * r.n_repeat_words > 30 * r.n_words)
    for policy in q.POLICIES:
        kept = {r.doc_id for r in rows.filter(q.passes(policy)).collect()}
        assert kept == {r.doc_id for r in got if not r.failures & q.mask(policy)}
        for a in q.ablations(rows, policy).collect():
            b = q.bit(a.rule)
            here = [r.failures & q.mask(policy) for r in got]
            assert (a.n_fail, a.n_only, a.n_kept_without) == (
                sum(bool(f & b) for f in here), sum(f == b for f in here), sum(f in (0, b) for f in here))
    rows.unpersist()


def test_native_plan_and_empty_table(spark):
    empty = q.ledger(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.collect() == [] and q.ablations(empty).collect() == []
    plan = q.ledger(spark.createDataFrame([Row(doc_id=1, text="a")]).select("doc_id", F.col("text")))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan
