import random

from pyspark.sql import functions as F

from lodestrata.llm import linededup


def brute(docs, window=3):
    """docs: (id, text) with distinct ids, in order of id."""
    seen, out = {}, {}
    for d, text in sorted((x for x in docs if x[1] is not None), key=lambda x: x[0]):
        lines = text.split("\n")
        solid = [i for i, s in enumerate(lines) if s.strip(" \t\r\f\x0b")]
        cover = set()
        for p in range(len(solid) - window + 1):
            key = tuple(lines[i].strip(" \t\r\f\x0b") for i in solid[p : p + window])
            if key in seen:
                cover |= set(range(solid[p], solid[p + window - 1] + 1))
            else:
                seen[key] = (d, p)
        out[d] = "\n".join(s for i, s in enumerate(lines) if i not in cover), len(cover)
    return out


def run(spark, docs, window=3):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r["doc_id"]: (r["text"], r["n_removed"]) for r in linededup.dedup_lines(df, window).collect()}


def test_equals_brute_force(spark):
    """Small alphabets, so that windows repeat within and across texts; one run for all cases."""
    rng = random.Random(8)
    docs = []
    for case in range(60):
        names = [f"{case}{x}" for x in "abcd"] + ["", "\t", f" {case}a "]
        docs += [(case * 10 + i, "\n".join(rng.choices(names, k=rng.randint(0, 14)))) for i in range(rng.randint(1, 6))]
    # Merging, blank lines inside, a text that is a copy throughout, one that is too short.
    docs += [(9001, "x\na\nb\nc\nd\ny"), (9002, "p\na\n\nb\nc\n\nd\nq"), (9003, "a\nb"), (9004, "a\nb\nc")]
    # A window that hundreds of texts share, and a very long text that repeats itself.
    docs += [(10_000 + i, f"one\ntwo\nthree\n{i}") for i in range(300)] + [(20_000, "\n".join(f"line {i % 2000}" for i in range(12_000)))]
    got = run(spark, docs)
    assert got == brute(docs)
    assert got[9002] == ("p\nq", 6) and got[9004] == ("", 3) and got[10_299] == ("299", 3) and got[20_000][1] == 10_000


def test_another_window(spark):
    docs = [(i, t) for i, t in enumerate(["a\nb\nc\nd\ne", "z\nb\nc\nd\ne\na\nb", "c\nd"])]
    assert run(spark, docs, 2) == brute(docs, 2)


def test_nulls_repeats_clashes_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a\nb\nc", "z"), (1, "a\nb\nc", "z"), (None, "a\nb\nc", "z"), (0, None, None), (2, "", "w")], "doc_id long, text string, row_key string").withColumn("n_lines", F.lit("old"))
    out = linededup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "row_key", "n_lines", "n_removed"]
    got = sorted((str(r["doc_id"]), str(r["text"]), str(r["row_key"]), r["n_lines"], r["n_removed"]) for r in out.collect())
    assert got == [("0", "None", "None", 0, 0), ("1", "a\nb\nc", "z", 3, 0), ("1", "a\nb\nc", "z", 3, 0), ("2", "", "w", 1, 0), ("None", "", "z", 3, 3)]
    assert linededup.dedup_lines(df.limit(0)).count() == 0
