import re

import corpus_pipeline
import pytest
from pyspark.sql import Row

from wavefold.llm import line_dedup

SPACE = " \t\n\r\x0b\x0c"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def plain(rows, min_chars=16, fold_chars=1):
    """rows: (doc_id, text) in the order of documents; equal rows in any order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = [], {}
    for i in order:
        text = rows[i][1]
        if text is None:
            out[i] = (None, 0, 0)
            continue
        kept = []
        for line in text.split("\n"):
            norm = line.strip(SPACE).lower()
            if len(norm) < fold_chars:
                kept.append(line)
                continue
            if not any(norm == s or len(norm) >= min_chars <= len(s) and one_edit(norm, s) for s in seen):
                kept.append(line)
            if norm not in seen:
                seen.append(norm)
        out[i] = ("\n".join(kept), len(text.split("\n")), len(kept))
    return sorted(((rows[i][0], *out[i]) for i in out), key=repr)


def collected(df):
    return sorted(((r.doc_id, r.text, r["__n_lines"], r["__n_kept"]) for r in df.collect()), key=repr)


BASE = "the quick brown fox jumps over the lazy dog and runs away from the wolf in the dark forest at night"


def edits(s):
    yield from (s[:i] + s[i + 1:] for i in range(0, len(s), 5))
    yield from (s[:i] + "#" + s[i:] for i in range(0, len(s) + 1, 5))
    yield from (s[:i] + "%" + s[i + 1:] for i in range(0, len(s), 5))


@pytest.mark.parametrize("base", [BASE, "sixteen chars ok", BASE * 12])
def test_every_single_edit_is_found(spark, base):
    rows = [(0, base)] + [(i + 1, e) for i, e in enumerate(edits(base))]
    got = collected(line_dedup.dedup(spark.createDataFrame([Row(doc_id=d, text=t) for d, t in rows])))
    assert got == plain(rows)


def test_rules_and_odd_rows(spark):
    far = BASE[:30] + "zz" + BASE[32:]
    rows = [
        (5, None), (6, ""), (None, "a line under a null id, long enough"), (7, "A LINE under a null id, long enougH \nshort\n\nshort"),
        (1, f"{BASE}\n  {BASE.upper()}  \n{far}"), (2, f"head line that stays here\n{BASE}x\ntail"),
        (3, "repeat this row exactly please\nand this"), (3, "repeat this row exactly please\nand this"),
        (4, "chain aaaaaaaaaaaaaaaa\nchain aaaaaaaaaaaaaaab\nchain aaaaaaaaaaaaaabb\nchain aaaaaaaaaaaaabbb"),
        (8, "éèàüß " * 6 + "日本"), (9, "éèàüß " * 6 + "日本語"), (10, "long line " * 4000), (11, "long line " * 3999 + "long lime "),
        (12, "\n".join(f"line number {i:05d} of a very long text {i * i}" for i in range(400))),
        (13, "\n".join(f"line number {i:05d} of a very long text {i * i}" for i in range(400))),
        (14, "aaaaaaaaaaaaaaaaaaaa"), (15, "aaaaaaaaaaaaaaaaaaaaa"), (16, "baaaaaaaaaaaaaaaaaaa")]
    df = spark.createDataFrame([Row(doc_id=d, text=t, h="clash", line_no=1, keep="x", n=2) for d, t in rows])
    out = line_dedup.dedup(df)
    assert out.columns[:len(df.columns)] == df.columns
    assert collected(out) == plain(rows)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert collected(line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)


def test_empty_table_and_native_plan(spark):
    out = line_dedup.dedup(spark.createDataFrame([], "doc_id long, text string"))
    assert out.collect() == []
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def plain_folded(rows, min_chars=16):
    """As plain(), but equal lines of any length but blank ones are folded."""
    seen, near, out = set(), [], []
    for i, text in rows:
        kept = []
        for line in text.split("\n"):
            norm = line.strip(SPACE).lower()
            far = len(norm) < min_chars or not any(one_edit(norm, s) for s in near)
            if not norm or norm not in seen and far:
                kept.append(line)
            seen.add(norm)
            if len(norm) >= min_chars:
                near.append(norm)
        out.append((i, "\n".join(kept), len(text.split("\n")), len(kept)))
    return sorted(out, key=repr)


def test_short_lines_are_folded_when_equal(spark):
    rows = [(1, "Menu\n\nmenu \nx\nfifteen chars ok\nsixteen chars ok"), (2, " MENU\nmenus\n\n}\nfifteen chars o\nSixteen chars oj"),
            (3, "x\n}\n\nfifteen chars o\nseventeen chars k")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(line_dedup.dedup(df)) == plain_folded(rows) == plain(rows)
    assert collected(line_dedup.dedup(df, fold_chars=16)) == plain(rows, fold_chars=16)


def test_pipeline_stage_folds_short_lines(spark):
    rows = [(1, "Menu\nonly here", 14), (2, "menu\nother", 10), (3, " MENU", 5), (4, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = corpus_pipeline.drop_repeated_lines(spark, df, None).collect()
    assert sorted(map(tuple, out)) == [(1, "Menu\nonly here", 14), (2, "other", 5), (4, "", 0)]
