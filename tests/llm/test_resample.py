import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import resample as r
from tests.llm import plain


def test_ngrams_against_plain_hashes():
    texts = ["Alpha beta ++ gamma", "", "é ÜBER alles, x2", "one", " .. ", "a b" * 30]
    for t in texts:
        h = [plain.word_hash(w) for w in plain.runs(t)]
        want = [x >> 50 for x in h] + [plain.pair_hash(a, b) >> 50 for a, b in zip(h, h[1:])]
        got = [r.ngrams(b, off)[0].tolist() for _, _, b, off in r.tv.slices(pa.array([t]))][0]
        assert got == want
    raw, target = np.array([3.0, 0.0, 5.0]), np.array([1.0, 0.0, 0.0])
    ratio = r.log_ratio(np.pad(raw, (0, r.BUCKETS - 3)), np.pad(target, (0, r.BUCKETS - 3)))
    assert ratio[0] == pytest.approx(np.log(2 / (1 + r.BUCKETS)) - np.log(4 / (8 + r.BUCKETS))) and ratio[2] == pytest.approx(np.log(1 / (1 + r.BUCKETS)) - np.log(6 / (8 + r.BUCKETS)))


def test_noise_against_plain_python(spark):
    """Gumbel noise of an id, drawn from its hash."""
    df = spark.createDataFrame([(7, "a b"), (10**12, "c"), (-3, "")], "doc_id long, text string")
    for x in r.resample(df, spark.createDataFrame([], "doc_id long"), keep=0.5).collect():
        u = ((plain.mix((plain.mix(x["doc_id"] & plain.M) + 5) & plain.M) >> 12) + 0.5) / 2.0**52
        assert x["gumbel_key"] == pytest.approx(-math.log(-math.log(u)), rel=1e-12) and x["log_weight"] == 0


def test_long_texts_and_ties(spark):
    """A long text counts whole; texts that tie in key go by id, then by hash."""
    long = " ".join(["good"] * 30_000 + ["bad"] * 30_000)
    rows = [(1, "good good good"), (2, "bad bad bad"), (3, long), (5, "x"), (5, "x"), (5, "y"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = r.resample(df, spark.createDataFrame([(1,)], "doc_id long"), keep=0.6).collect()
    by = {x["doc_id"]: x["log_weight"] for x in got}
    assert len(got) == 7 and sum(x["selected"] for x in got) == 5 and by[2] / 5 < by[3] / r.LENGTH < by[1] / 5


def test_counts_and_weights_against_plain_python(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices(["alpha", "beta", "Gamma", "%%%", "é"], k=rng.randint(0, 40)))) for i in range(80)] + [(900, None), (901, "")]
    good = {i for i in range(0, 80, 3)}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    raw, target = r.counts(df.select("text", F.col("doc_id").isin(*good).alias("m")))

    def grams(text):
        for _, _, b, off in r.tv.slices(pa.array([text or ""])):
            return r.ngrams(b, off)[0]
        return np.zeros(0, np.int64)

    want = np.zeros((2, r.BUCKETS))
    for i, t in docs:
        g = np.bincount(grams(t), minlength=r.BUCKETS)
        want[0] += g
        want[1] += g * (i in good)
    assert (raw == want[0]).all() and (target == want[1]).all() and raw.sum() == sum(max(0, 2 * len((t or "").split()) - 1) for _, t in docs)
    got = {x["doc_id"]: x for x in r.resample(df, spark.createDataFrame([(i,) for i in good] + [(None,), (3,)], "doc_id long"), keep=0.5).collect()}
    ratio = r.log_ratio(raw, target)
    for i, t in docs:
        g = grams(t)
        assert got[i]["log_weight"] == pytest.approx(ratio[g].mean() * min(len(g), r.LENGTH) if len(g) else 0.0)
    order = sorted(got.values(), key=lambda x: -x["gumbel_key"])
    assert [x["selected"] for x in order] == [True] * 41 + [False] * 41


@pytest.mark.parametrize("k", [1, 37, 500, 1000])
def test_threshold_is_exact(spark, k):
    rng = np.random.default_rng(k)
    x = np.concatenate([rng.normal(0, 1e3, 600), rng.integers(-3, 3, 400)]).astype(float)
    ords = r._order(x)
    assert (np.argsort(ords, kind="stable") == np.argsort(x, kind="stable")).all()
    at, take = r.threshold(spark.createDataFrame([(int(o),) for o in ords], "ord long"), k)
    s = sorted(ords.tolist(), reverse=True)
    assert at == s[k - 1] and take == s[:k].count(at)


def test_gumbel_top_k_follows_the_weights(spark):
    """Texts whose weights are a log(3) apart are drawn first in proportion."""
    ids = np.arange(20_000, dtype=np.int64).view(np.uint64)
    u = ((r.tv.mix(r.tv.mix(ids) + np.uint64(5)) >> np.uint64(12)).astype(float) + 0.5) / 2.0**52
    key = np.where(np.arange(20_000) % 2, np.log(3.0), 0.0) - np.log(-np.log(u))
    first = key.reshape(-1, 2).argmax(axis=1)
    assert abs(first.mean() - 0.75) < 0.02


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, "a b", "x"), (2, None, "x")], "doc_id long, text string, ord string")
    none = spark.createDataFrame([], "doc_id long")
    got = r.resample(df, none, keep=0.5).collect()
    assert sorted(x["selected"] for x in got) == [False, False, True, True] and {x["log_weight"] for x in got} == {0.0}
    assert r.resample(df.limit(0), none).count() == 0
