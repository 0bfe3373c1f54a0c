import numpy as np
from pyspark.sql import Row
from pyspark.sql import functions as F

from wavefold.llm import queries, toxicity

SF01 = "/root/testdata/sf0.1"


def test_the_verdict_comes_last_in_the_chain(spark):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    assert [*queries.toxicity_categories(labels)][-1] == "toxic"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    odd = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    fit_on = labels.filter(~odd)
    chain = toxicity.fit(docs, fit_on, queries.toxicity_categories(fit_on))
    held = toxicity.score(docs, chain).join(labels.filter(odd), "doc_id").toPandas()
    flagged = held.p_toxic >= toxicity.THRESHOLD
    assert flagged[held.toxic == 1].mean() > 0.9
    good = held.quality == 1  # junk made of toxic texts has lost the words
    assert flagged[(held.toxic == 1) & good].mean() > 0.95
    assert flagged[held.toxic == 0].mean() < 0.005


def made(n=400):
    rows, labels = [], []
    for i in range(n):
        bad, worse = i % 4 == 0, i % 8 == 0
        rows.append(Row(doc_id=i, text=f"plain words {'w' + 'abcdefgh'[i % 8]} {'nasty' if bad else 'nice'} number {'vile' if worse else ''} {i}"))
        labels.append(Row(doc_id=i, bad=int(bad), worse=int(worse)))
    return rows, labels


def test_chain_learns_and_scores_odd_rows(spark):
    rows, labels = made()
    labels += [Row(doc_id=None, bad=1, worse=1), Row(doc_id=1, bad=None, worse=0), Row(doc_id=0, bad=0, worse=0)]
    docs, given = spark.createDataFrame(rows), spark.createDataFrame(labels)
    chain = toxicity.fit(docs, given, {"bad": given["bad"] == 1, "worse": given["worse"] == 1})
    assert chain.names == ("bad", "worse") and len(chain.models[1][2]) == 1
    asked = [(1, None), (2, ""), (None, "nasty"), (3, "NASTY vile"), (3, "NASTY vile"), (4, "nice " * 50_000)]
    df = spark.createDataFrame([Row(doc_id=d, text=t, p_bad="clash") for d, t in asked])
    got = {(r.doc_id, i): (r.p_bad, r.p_worse) for i, r in enumerate(toxicity.score(df, chain).collect())}
    assert len(got) == 6
    by_id = sorted(got.items(), key=repr)
    p = {k[0]: v for k, v in by_id}
    assert p[1] == p[2] and p[1][0] < 0.5 and p[None][0] > 0.5 and p[3][1] > 0.5 and p[4][0] < 0.1
    kept = toxicity.keep_civil(df, chain, "bad")
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


def test_out_of_fold_probabilities_are_not_the_labels(monkeypatch):
    rng = np.random.default_rng(0)
    n = 300
    y = np.column_stack([rng.integers(0, 2, n), rng.integers(0, 2, n)])
    # every row has a feature of its own: only a model that saw the label could tell it
    chain = toxicity._fit_chain(["a", "b"], {str(k): k for k in range(n)}, np.arange(n), np.arange(n), y)
    assert abs(chain.models[1][2][0]) < 3


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([Row(doc_id=1, text="nasty words")])
    labels = spark.createDataFrame([], "doc_id long, bad int")
    chain = toxicity.fit(docs, labels, {"bad": labels["bad"] == 1})
    assert toxicity.keep_civil(docs, chain, "bad").count() == 1
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, labels, {"bad": labels["bad"] == 1})).collect() == []
