import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import langid, queries
from tests.llm import plain

EN = "the quick brown fox and the lazy dog were walking through this little town because they wanted something different"
DE = "der schnelle braune fuchs und der faule hund gingen durch diese kleine stadt weil sie etwas anderes wollten"
RU = "быстрая лиса и ленивая собака гуляли по маленькому городу потому что хотели чего нибудь другого"


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    mix = lambda t: pa.array([" ".join(rng.permutation(t.split())) for _ in range(30)])
    return langid.Model(["de", "en", "ru"], [mix(DE), mix(EN), mix(RU)])


def viterbi(score):
    """Best path by trying every switch point, plainly."""
    n, k = score.shape
    best = score[0].astype(float)
    back = []
    for x in score[1:]:
        prev, step = best.copy(), []
        for i in range(k):
            options = [prev[j] - (langid.SWITCH if j != i else 0) for j in range(k)]
            j = i if options[i] >= max(options) else int(np.argmax(options))
            step.append(j)
            best[i] = x[i] + options[j]
        back.append(step)
    return best.max(), back


def value(score, path):
    return sum(float(score[i, p]) for i, p in enumerate(path)) - langid.SWITCH * sum(a != b for a, b in zip(path, path[1:]))


def test_labels_are_a_best_path(model):
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 60):
        for _ in range(20):
            s = -rng.random((n, 3)).astype(np.float32) * 8
            s[: n // 2, 1] = 0
            s[n // 2 :, 2] = 0
            assert abs(value(s, model.label(s).tolist()) - viterbi(s)[0]) < 1e-3


def test_word_scores_against_plain_python(model):
    """Trigrams and words of a text, hashed and looked up one by one."""
    text = "The quick Fuchs ging because x2 Ärger"
    names = [w for w in plain.only_words(text) if any(chr(b).isalpha() for b in w if b < 128) or any(b >= 0xC2 for b in w)]
    w = next(langid.words(raw, off) for _, _, raw, off in langid.tv.slices(pa.array([text]), lower=False))
    got = model.scores(w)
    assert len(got) == len(names)
    for row, name in zip(got, names, strict=True):
        low = name.decode().lower().encode()
        padded = b" " + low + b" "
        grams = [((padded[i - 1] << 16 | padded[i] << 8 | padded[i + 1]) * 0x9E3779B1 & 0xFFFFFFFF) >> 15 for i in range(1, len(padded) - 1)]
        raw = [sum(float(model.gram[g, k]) for g in grams) + float(model.word[plain.word_hash(low) >> 47, k]) for k in range(3)]
        raw[2] = -np.inf if name.isascii() or "\u00c4" in name.decode() else raw[2]
        best = max(raw)
        assert np.allclose(row, [max(x - best, -langid.FLOOR) for x in raw], atol=1e-3)


def test_texts_and_spans(model):
    got = list(model.predict(pa.array([EN, DE.upper(), RU, None, "", "123 ...", f"{EN}. {RU}", "日本語"]), spans=True))
    assert [g[0] for g in got[:6]] == ["en", "de", "ru", "und", "und", "und"] and all(0 <= g[1] <= 1 for g in got)
    mixed = f"{EN}. {RU}"
    assert [(mixed[a:b], k) for a, b, k in got[6][2]] == [(EN, "en"), (RU, "ru")]
    assert got[7][0] in ("de", "en", "ru", "und")


def test_scripts_narrow_candidates(model):
    w = None
    for _, _, raw, off in langid.tv.slices(pa.array(["собака dog"]), lower=False):
        w = langid.words(raw, off)
    s = model.scores(w)
    assert s[0, 2] == 0 and s[0, 0] == s[0, 1] == -langid.FLOOR
    assert s[1, 2] == -langid.FLOOR


def test_slices_do_not_change_results(model, monkeypatch):
    texts = pa.array([EN, None, DE, "", RU + " " + DE, "x"] * 5)
    want = list(model.predict(texts, spans=True))
    monkeypatch.setattr(langid.tv, "SLICE_BYTES", 64)
    assert list(model.predict(texts, spans=True)) == want
    assert list(model.predict(texts.slice(7, 9), spans=True)) == want[7:16]


def test_operator_edges(spark, model):
    df = spark.createDataFrame([(1, EN, 0.5, "a"), (1, EN, 0.5, "a"), (None, DE, 0.1, "b"), (2, None, None, None), (3, (DE + " ") * 3000, 1.0, "c")], "doc_id long, text string, score double, lang_pred string")
    got = sorted((str(r["doc_id"]), r["lang_pred"]) for r in langid.identify(df, model).collect())
    assert got == [("1", "en"), ("1", "en"), ("2", "und"), ("3", "de"), ("None", "de")]
    kept = langid.accepted(df, model)
    assert kept.schema == df.schema and kept.count() == 4
    assert langid.identify(df.limit(0), model).count() == 0
    assert langid.spans(df, model).where("doc_id = 1").first()["spans"][0]["lang"] == "en"


def test_learning_without_labels(spark):
    df = spark.createDataFrame([(1, EN, None)], "doc_id long, text string, lang string")
    model = langid.learn(df)
    assert [r["lang_pred"] for r in langid.identify(df, model).collect()] == ["und"]
    assert [r["h"] for r in spark.createDataFrame([(None,), (7,)], "d long").select(langid.held_out(F.col("d")).alias("h")).collect()] == [False, zlib.crc32(b"7") % 5 == 0]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op4_language(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150 and sum(r["lang_pred"] == r["lang"] for r in got) / len(got) > 0.97


def test_learning_gives_its_memory_back(spark):
    """Training texts of 40 MB leave the driver once a model is made."""
    at = Path("/proc/self/smaps_rollup")
    if not at.exists():
        pytest.skip("memory can't be read here")
    held = lambda: sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", at.read_text()))) / 1024
    k = F.col("id").cast("string")
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("the word "), k, F.lit(" and "), F.sha2(k, 256), F.lit("\n")), 120).alias("text"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("lang"))
    langid.learn(docs.limit(20))
    before = held()
    model = langid.learn(docs)
    assert model.langs == ["a", "b"] and held() - before < 25
