import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lodestrata.llm import tokencount as t

WORD = str(P.path("word_bpe_49k.json"))
ODD = ["", " ", "<|endoftext|> a <|startoftext|>b<|endoftext|>", "İstanbul ΣΑΣ Σ ς́ a ́b", "don't I'LL we've x\x85y z", "é é ẛ̣", "日本語 テスト 123 4５", "\x1c\x1d a\x85b​", "\U0001f600\U0001f601!!", "<|ENDOFTEXT|> <|end of text|>", "a\n\n\tb" * 300]


def _texts():
    rng = random.Random(2)
    return ODD + ["".join(rng.choices("abcé'’ \n\tSΣ1,.<|>́", k=rng.randint(0, 80))) for _ in range(300)]


def test_pieces_add_up():
    lib, own = Tokenizer.from_file(WORD), t.Counter(WORD)
    assert own.blank_free
    assert own.counts([x.encode() for x in _texts()]) == [len(lib.encode(x, add_special_tokens=False).ids) for x in _texts()]


def test_full_piece_cache(monkeypatch):
    monkeypatch.setattr(t, "PIECES", 10)
    own, plain = t.Counter(WORD), t.Counter(WORD)
    plain.blank_free = False
    data = [x.encode() for x in _texts()]
    assert [n for i in range(0, len(data), 7) for n in own.counts(data[i : i + 7])] == plain.counts(data)
    assert len(own.known) < 200


@pytest.mark.parametrize("name, free", [("byte_bpe_50k.json", False), ("piece_bpe_32k.model", False)])
def test_other_tokenizers_take_whole_texts(name, free):
    own = t.Counter(str(P.path(name)))
    assert own.blank_free is free and own.counts([b"a  b", b"a b"])[1] >= 2


def test_cache_encodes_each_content_once(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "a b", 0), (2, " a\n b ", 0), (3, None, 0), (3, None, 0), (None, "c d e", 0), (4, "c d e", 0)], "doc_id long, text string, n_tokens int")
    cache = f"file://{tmp_path}/cache"
    first = {(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in t.count_tokens(df, WORD, cache).collect()}
    assert first == {(1, 3, 2), (2, 6, 2), (3, 0, 0), (None, 5, 3), (4, 5, 3)}
    assert spark.read.parquet(cache).count() == 3
    more = df.union(spark.createDataFrame([(9, "c  d e", 0), (10, "new words", 0)], df.schema))
    got = {r["doc_id"]: r["n_tokens"] for r in t.count_tokens(more, WORD, cache).collect()}
    assert got[9] == 3 and got[10] == 2 and spark.read.parquet(cache).count() == 4
    t.count_tokens(df, str(P.path("piece_bpe_32k.model")), cache)
    assert spark.read.parquet(cache).select("version").distinct().count() == 2
    assert t.count_tokens(df.limit(0), WORD).count() == 0


def test_a_process_keeps_its_counter_for_later_tasks():
    blob = open(WORD, "rb").read()
    first = t.kept_counter(WORD, blob, "v1")
    first.counts([b"some words"])
    again = t.kept_counter(WORD, blob, "v1")
    assert again is first and b"words" in again.known
    assert t.kept_counter(WORD, blob, "v2") is not first and len(t._last) == 1
