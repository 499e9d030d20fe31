import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import quality_model, toxicity
from strata.llm.quality_model import counts, op4_quality_model, score_quality
from strata.llm.toxicity import FOLDS, Marks, Trees, features, hidden_insults, isotonic, op6_toxicity, part_of, score_toxicity

SF = "/root/testdata/sf0.1"


def auc(y, p):
    y, p = np.asarray(y), np.asarray(p)
    a, b = p[y == 1], p[y == 0]
    return ((a[:, None] > b).sum() + 0.5 * (a[:, None] == b).sum()) / (len(a) * len(b))


@pytest.mark.parametrize("query, label, parts, held, least", [(op4_quality_model, "quality", 3, 1, 0.97),
                                                              (op6_toxicity, "toxic", 4, 2, 0.9)])
def test_held_out_accuracy(spark, query, label, parts, held, least):
    label = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= (0.5 if parts == 3 else 0.3))
    test = [(label[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in label]
    assert auc(*zip(*test)) > least
    if parts == 4:                                          # calibrated on rows that taught nothing
        y, p = (np.array(v, float) for v in zip(*sorted(test, key=lambda t: t[1])))
        error = sum(abs(p[k].mean() - y[k].mean()) * len(k) for k in np.array_split(np.arange(len(y)), 10)) / len(y)
        assert error < 0.03


def test_the_parts_of_the_toxicity_sample(spark):
    docs = spark.createDataFrame([(i, f"zapper{'x' * (i % 5)} plain") for i in range(200)], "doc_id long, text string")
    chosen = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("y"), part_of(F.col("doc_id")).alias("part"))
    assert {r.part for r in chosen.collect()} == set(range(FOLDS + 1))
    counts = toxicity.beginning_counts(docs, chosen)
    got = {(r.part, r.stem): (r.a, r.b) for r in counts.collect()}
    taught = {r.part: (r.a, r.b) for r in chosen.groupBy("part").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).collect()}
    assert not any(k[0] == 0 for k in got)                  # calibration teaches nothing
    for k in range(1, FOLDS + 1):
        assert got[k, "zappe"] == got[k, "=plain"] == taught[k]
    # a word of one part only is learned by all parts but that one
    marked = docs.join(chosen, "doc_id").withColumn("text", F.expr("if(part = 1 and y = 1, 'quixotic words', text)")).select("doc_id", "text")
    counts = toxicity.beginning_counts(marked, chosen)
    assert "=quixotic" in toxicity.learned_beginnings(counts, chosen)
    assert "=quixotic" not in toxicity.learned_beginnings(counts, chosen, without=1)


@pytest.mark.parametrize("score, most", [(score_quality, quality_model), (score_toxicity, toxicity)])
def test_edges(spark, edge_rows, no_rows, score, most):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (9, 1, 0), (9, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], labels.schema)
    assert score(no_rows, labels).collect() == []
    for y in (labels, none):
        rows = score(edge_rows, y).collect()
        assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
        assert not any(r.held_out for r in rows if r.doc_id is None)


def test_subword_counts_are_those_of_single_words():
    rnd = random.Random(2)
    text = " ".join("".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 9))) for _ in range(300))
    idx, share = counts(text.encode())
    assert abs(share.sum() - 1) < 1e-4 and len(set(idx.tolist())) == len(idx)
    again, same = counts(text.replace(" ", "  \n").encode())      # blanks do not matter
    assert len(counts(b" \n ")[0]) == 0 and len(counts(None)[0]) == 0
    assert (again == idx).all() or len(again) >= len(idx)
    assert same.sum() > 0.99


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"w{i % 91}x{i % 17}" for i in range(4000)).encode()
    whole = counts(text)
    monkeypatch.setattr(quality_model, "SEGMENT", 1000)
    parts = counts(text)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1], atol=1e-4)


def test_trees_and_isotonic():
    rnd = np.random.default_rng(1)
    x = rnd.random((2000, 3))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.5)).astype(float)
    t = Trees(x, y)
    assert auc(y, t.margin(x)) > 0.99
    knots, fit = isotonic(t.margin(x), y)
    assert (np.diff(fit) >= 0).all() and len(knots) == len(fit)
    m, v = np.array([1.0, 2, 3, 4]), np.array([0, 1, 0, 1])
    assert isotonic(m, v)[1].tolist() == [0, 0.5, 0.5, 1]


def test_toxic_features():
    marks = Marks(["lowei", "=zap"])
    f = dict(zip(toxicity.FEATURES, features("You are an IDIOT, loweischaft zap zapped".encode(), marks)))
    assert f["lexicon"] == 1 / 7 and f["learned"] == 2 / 7 and f["near_second"] > 0
    assert hidden_insults("1d1ot m*ron i d i o t plain")[0] == 3
    assert features(None, marks) == features(b" \n", marks) == (0.0,) * len(toxicity.FEATURES)


def test_features_do_not_depend_on_the_size_of_the_text():
    marks = Marks()
    f = lambda t: dict(zip(toxicity.FEATURES, features(t.encode(), marks)))
    shouted = " ".join(["SHOUT"] * 30)
    assert f(shouted)["capital_words"] == 1
    assert f(" ".join(["lower"] * 1970) + " " + shouted)["capital_words"] == 30 / 2000


@pytest.mark.parametrize("gap", " .-_")
def test_insults_with_gaps_are_found(gap):
    f = dict(zip(toxicity.FEATURES, features(f"what an {gap.join('idiot')} é said".encode(), Marks())))
    assert f["hidden"] > 0


def test_a_score_does_not_depend_on_the_batch():
    """A row alone, beside any other row, repeated, and in another order gets the same score."""
    table = np.random.default_rng(5).normal(size=1 << quality_model.BITS)

    class Shared:
        value = table, 0.1

    fn = quality_model._maker(Shared)()
    texts = [b"foo bar foo", b"foo bar foo", b"", None, b" \n", b"foo", b"foo foo", b"x y z", b"z", b"end with blank ", b" begin", b"a" * 50]
    alone = [fn([t])[0][0].as_py() for t in texts]
    assert alone[0] == alone[1] and alone[2] == alone[3] == alone[4]
    rnd = random.Random(9)
    for _ in range(30):
        order = [rnd.randrange(len(texts)) for _ in range(15)]
        assert [v.as_py() for v in fn([texts[i] for i in order])[0]] == [alone[i] for i in order]


def test_long_texts_score_alike_alone_and_in_a_batch(monkeypatch):
    monkeypatch.setattr(quality_model, "SEGMENT", 500)
    test_a_score_does_not_depend_on_the_batch()
    table = np.random.default_rng(6).normal(size=1 << quality_model.BITS)
    fn = quality_model._maker(type("Shared", (), {"value": (table, 0.0)}))()
    long = " ".join(f"w{i % 37} w{i % 37}" for i in range(900)).encode()
    assert fn([long])[0][0] == fn([b"short", long, b"w1"])[0][1]


def test_mixed_words_in_linear_time():
    import re
    import time

    literal = re.compile(r"[a-z]+[013457@$*][a-z013457@$*]*|[013457@$]+[a-z*][a-z013457@$*]*")
    rnd = random.Random(12)
    for _ in range(3000):
        text = "".join(rnd.choice("ab01*@2 -\u00e9") for _ in range(rnd.randint(0, 14)))
        assert hidden_insults(text)[1] == len(literal.findall(text)), text
    began = time.process_time()
    features(b"x" * 2_000_000 + b" 1 " + b"0" * 1_000_000, Marks())
    assert time.process_time() - began < 20
