import random
import re

import pyarrow as pa
import pytest

from lodestrata.llm import decontaminate as d


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def grams(w, k):
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items, share=0.8):
    out = set()
    for i, t in items:
        w = words(t)
        if not w:
            continue
        k = min(5, len(w))
        need = grams(w, k)
        for j, x in docs:
            c = len(need & grams(words(x), k)) / len(need)
            if c >= share:
                out.add((j, i, round(c, 9)))
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(6)
    vocab = [f"word{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, say(n)) for i, n in enumerate([1, 2, 4, 5, 6, 12, 13, 14, 20, 21, 36, 37, 60, 70, 130, 300, 900])]
    items += [(100, None), (101, "... !!"), (102, "Été à la plage, naïve Straße öffnet früh heute morgen schon wieder sehr gern")]
    docs = []
    for n, (_, t) in enumerate(items * 3):
        w = words(t)
        for _ in range(rng.choice([0, 0, 1, 3])):
            if w:
                w[rng.randrange(len(w))] = "changed"
        docs.append((n, f"{say(rng.choice([0, 3, 50, 3000]))}. {' '.join(w).upper()}, {say(rng.choice([0, 7, 200]))}"))
    docs += [(1000 + i, say(200)) for i in range(60)] + [(2000, None), (2001, ""), (2002, "word1")]
    return docs, items


def test_equals_brute_force(data, monkeypatch):
    docs, items = data
    want = brute(docs, items)
    index = d.Index(items, 5)
    ids = [i for i, _ in docs]
    for size in (1 << 20, 500):
        monkeypatch.setattr(d.tv, "SLICE_BYTES", size)
        assert {(ids[r], i, round(c, 9)) for r, i, c in index.matches(pa.array([t for _, t in docs]), 0.8)} == want
    assert len(want) > 25


def test_operator_in_blocks(spark, data, monkeypatch):
    docs, items = data
    df, bench = spark.createDataFrame([(i, t, i) for i, t in docs], "doc_id long, text string, item_id long"), spark.createDataFrame(items + items[:3], "item_id long, text string")
    monkeypatch.setattr(d, "BLOCK_ITEMS", 8)
    got = {(r["doc_id"], r["item_id"], round(r["containment"], 9)) for r in d.contaminated(df, bench).collect()}
    assert got == brute(docs, items)
    kept = d.clean(df, bench)
    assert kept.schema == df.schema and {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {x for x, _, _ in got}


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "A b, c d e F")], "item_id long, text string")
    assert sorted(str(r["doc_id"]) for r in d.contaminated(df, bench).collect()) == ["1", "1", "None"]
    assert d.contaminated(df, bench.limit(0)).count() == 0 and d.contaminated(df.limit(0), bench).count() == 0
    assert d.clean(df, bench.limit(0)).count() == 4 and [r["doc_id"] for r in d.clean(df, bench).collect()] == [2]
