"""The pipeline on a small corpus, each stage against a plain version of it on its own input."""

import random

import pytest

import corpus_pipeline
from lodestrata.llm import scratch
from tests.llm import test_decontaminate, test_linededup, test_mixing, test_nearsets

EN = "the quick brown fox and lazy dog were walking through this little town because they wanted something different today while other people stayed home reading old books about distant places where nobody had ever been before".split()
DE = "der schnelle braune fuchs und faule hund gingen durch diese kleine stadt weil sie etwas anderes wollten während andere leute daheim blieben alte bücher lasen über ferne orte wo niemand jemals gewesen war".split()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(5)
    say = lambda w, n: " ".join(rng.choices(w, k=n))
    item = say([f"item{i}" for i in range(90)], 40)
    docs = []
    for i in range(120):
        w, lang = (EN, "en") if i % 3 else (DE, "de")
        docs.append([i, "\n".join(say(w, 12) for _ in range(rng.randint(1, 6))), lang, f"s{i % 4}" if i % 2 else "hot"])
    shared = "\n".join(say(EN, 12) for _ in range(4))
    for i in (3, 40, 41, 77):
        docs[i][1] += "\n" + shared
    for i, j in ((50, 5), (51, 5), (60, 10)):
        docs[i][1] = docs[j][1]
    for i in (20, 21):
        docs[i][1] += f"\n{item.upper()}\n{say(EN, 10)}"
    docs += [[200, None, "en", "s0"], [201, "", "en", "s0"], [202, "12345 %%% 67", "en", None], [203, shared, "en", None], [204, "der fuchs und the dog", None, None]]
    once = rng.choices(EN, k=60)
    docs += [[205, " ".join(once), "en", "s1"], [206, " ".join([*once[:30], "nowhere", *once[31:]]), "en", "s2"]]
    root = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, k, s, len(t or "")) for i, t, k, s in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "unseen words only here and nowhere else at all")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, item


def test_stages(spark, tables, tmp_path):
    root, item = tables
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        stage(spark, docs, root).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "mixing":
            assert docs.columns == columns
        seen[name] = before, {r["doc_id"]: r for r in docs.collect()}

    before, after = seen["language"]
    assert before.keys() - after.keys() == {200, 201, 202}

    before, after = seen["line_dedup"]
    want = test_linededup.brute([(i, r["text"]) for i, r in before.items()])
    want = {i: t for i, (t, n) in want.items() if not n or t.strip()}
    assert {i: r["text"] for i, r in after.items()} == want and 203 not in after
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())

    before, after = seen["near_dedup"]
    classes = test_nearsets.brute_classes([(i, r["text"]) for i, r in before.items()])
    assert set(after) == set(classes.values()) and len(after) < len(before) and all(after[i] == before[i] for i in after)

    before, after = seen["decontamination"]
    leaks = {j for j, _, _ in test_decontaminate.brute([(i, r["text"]) for i, r in before.items()], [(1, item)])}
    assert before.keys() - after.keys() == leaks == {20, 21} & before.keys()

    before, after = seen["mixing"]
    _, _, taken = test_mixing.brute([(i, r["source"], r["text"]) for i, r in before.items()])
    assert {i: r["taken"] for i, r in after.items()} == taken and all(after[i]["text"] == before[i]["text"] for i in before)


def test_run_is_the_stages_in_turn_and_reruns_agree(spark, tables):
    root, _ = tables
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, root).select("doc_id", "taken").collect())) for _ in range(2))
    assert a == b and len(a) > 90


def test_stages_on_an_empty_table(spark, tables):
    root, _ = tables
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), root).count() == 0


def test_clashing_columns_repeats_null_ids_and_long_texts(spark, tables):
    """Columns of any name pass through; repeated rows share a fate; null ids stay; a long text is a text."""
    root, item = tables
    long = "\n".join(" ".join(EN[(i * 7 + j) % len(EN)] + str(i % 97) for j in range(12)) for i in range(8000))
    rows = [(1, long), (2, "the quick brown fox and lazy dog were walking through this little town"), (2, "the quick brown fox and lazy dog were walking through this little town"), (None, "nobody had ever been before in this little town because they wanted something"), (3, " ".join(EN * 2)), (5, " ".join(EN * 2) + " extra"), (4, None)]
    names = ["n_lines", "n_removed", "size", "taken", "k", "s", "doc_id_", "component_id", "fp", "gone", "n_lines_own", "m", "lang_pred"]
    docs = spark.createDataFrame([(i, t, "en", None, 0, *[f"{n}-{j}" for n in names]) for j, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    kept = {"language": 6, "line_dedup": 6, "near_dedup": 5, "decontamination": 5}
    both = spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs.unionByName(both, allowMissingColumns=True), root) if name == "language" else stage(spark, docs, root)
        assert got.columns == docs.columns
        own = [r for r in got.collect() if r["n_lines"] is not None]
        assert len(own) == kept[name], name
        assert all(r[n].startswith(n + "-") for r in own for n in names)
        by = {r["n_lines"][-1]: r for r in own}
        assert len({r["n_lines"] for r in own}) == len(own) and by["3"]["doc_id"] is None
        docs = spark.createDataFrame([tuple(r) for r in own], docs.schema)
    got = corpus_pipeline.mix(spark, docs, root)
    assert {r["k"][:2] for r in got.collect()} == {"k-"} and set(got.columns) >= set(docs.columns) | {"size", "source_size", "target", "taken"}


def test_ids_that_are_no_integers(spark, tables):
    root, _ = tables
    docs = spark.read.parquet(f"{root}/documents.parquet").selectExpr("concat('x', doc_id) AS doc_id", "text", "lang", "source", "n_chars")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([tuple(r) for r in stage(spark, docs, root).collect()], stage(spark, docs, root).schema)
        assert 90 < docs.count() <= n and docs.where("doc_id like 'x%'").count() == docs.count(), name


def test_a_run_leaves_only_its_result(spark, tables):
    root, _ = tables
    mark = scratch.Scratch.mark()
    got = corpus_pipeline.run(spark, root)
    assert got.count() > 90 and scratch.Scratch.mark() == mark + 1
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(scratch.Scratch._made[-1].root)
    assert len(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)) == 1
