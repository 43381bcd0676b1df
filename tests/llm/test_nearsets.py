"""Near copies by 5-word shingles against brute force, alone and as the pipeline's stage."""

import os
import random
import re

import corpus_pipeline
from lodestrata.llm import nearsets, scratch


def brute_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    """component_id of each (doc_id, text); ids are distinct."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x == y or (x and y and len(x & y) / len(x | y) >= 0.8):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(rows)}


def corpus():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(60, 200))]
        texts.append(base)
        for _ in range(4):
            edit = list(base)
            for _ in range(rng.randint(1, 6)):
                edit[rng.randrange(len(edit))] = word().upper()
            texts.append(edit)
    # A chain: each links to the next, the ends don't link.
    chain = [word() for _ in range(150)]
    for i in range(8):
        texts.append(chain[i * 8 :] + [word() for _ in range(i * 8)])
    rows = [" ".join(t) for t in texts]
    rows += [rows[0], rows[0].upper().replace(" ", "\n"), None, "", " \n", "one two", "ONE  two", "two one", "one two three four five"]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows, strict=True))


def test_classes_are_those_of_brute_force(spark):
    rows = corpus()
    want = brute_classes(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in nearsets.near_duplicates(df.repartition(5)).collect()} == want
    assert 5 < len(rows) - len(set(want.values())) < len(rows) - 5
    again = nearsets.near_duplicates(df.union(spark.createDataFrame([(None, rows[0][1]), (rows[0][0], rows[0][1])], df.schema))).collect()
    assert len(again) == len(rows) + 2 and {r["component_id"] for r in again if r["doc_id"] is None} == {want[rows[0][0]]}
    assert nearsets.near_duplicates(df.limit(0)).count() == 0


def test_the_stage_drops_near_copies_whose_fingerprints_differ(spark):
    rows = corpus()
    want = brute_classes(rows)
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r["doc_id"] for r in got.collect()} == set(want.values())


def test_small_tables_take_few_tasks(spark, many_partitions):
    rng = random.Random(9)
    base = rng.choices("abcdefghijklmnop", k=120)
    rows = [(i, " ".join(base[:i] + ["zz"] + base[i:] if i else base)) for i in range(60)] + [(100 + i, " ".join(rng.choices("qrstuvwxyz", k=60))) for i in range(60)]
    mark = scratch.Scratch.mark()
    got = {r["doc_id"]: r["component_id"] for r in nearsets.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect()}
    assert got == {i: 0 if i < 100 else i for i, _ in rows}
    tables = [f for s in scratch.Scratch._made[mark:] for f in os.listdir(s.root.removeprefix("file://"))]
    files = [f for s in scratch.Scratch._made[mark:] for _, _, names in os.walk(s.root.removeprefix("file://")) for f in names if f.endswith(".parquet")]
    assert len(files) <= len(tables) * 2 * spark.sparkContext.defaultParallelism
    assert max(int(f.split("-")[1]) for f in files) < 2 * spark.sparkContext.defaultParallelism
    scratch.Scratch.close_since(mark)
