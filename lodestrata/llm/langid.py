"""Language of texts and of spans in them.

A word's score for a language is the log-likelihood of its byte trigrams and of
its hash. Script ranges narrow the candidates first: a language of whose learned
scripts the word has none is out. Viterbi with a penalty for each switch then
labels the words; the language with most labelled letters is the text's.

Where no other language gains more than the penalty over any run of words, the
best path can't switch, which one running sum shows; only other texts (mixed
ones) go through Viterbi word by word. Everything else is numpy over whole
slices of a column.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

#: Labelled texts that are learned from: at most so many and about so many bytes a language, chosen by a hash of the id;
#: none of more than so many bytes itself; of the languages with most rows at most so many.
TRAIN_ROWS, TRAIN_BYTES, TEXT_BYTES, LANGS = 3000, 1 << 24, 1 << 16, 64
#: Buckets of trigrams and of words; the most that one word may speak against a language; the cost of a switch.
BUCKETS, FLOOR, SWITCH = 1 << 17, 8.0, 16.0
#: Share of a language's letters from which a script is one of its own.
SCRIPT_SHARE = 0.01

# First code points of script ranges, by Unicode block; "" is no script.
SCRIPTS = (
    (0x0041, "Latin"), (0x0250, "IPA"), (0x02B0, ""), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Syriac"),
    (0x0750, "Arabic"), (0x0780, "Thaana"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, ""), (0x3040, "Hiragana"), (0x30A0, "Katakana"), (0x3100, "Bopomofo"), (0x3130, "Hangul"), (0x3190, ""), (0x3400, "Han"), (0xA000, "Yi"), (0xAC00, "Hangul"),
    (0xD800, ""), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, ""), (0x20000, "Han"), (0x30000, ""),
)
_NAMES = sorted({n for _, n in SCRIPTS if n})
_FROM = np.array([c for c, _ in SCRIPTS])
_BIT = np.array([np.uint64(1) << np.uint64(_NAMES.index(n)) if n else np.uint64(0) for _, n in SCRIPTS], np.uint64)
_LATIN = np.uint64(1) << np.uint64(_NAMES.index("Latin"))
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def held_out(rid: Column, parts: int = 5, left_out: int = 0) -> Column:
    return F.coalesce(F.crc32(rid.cast("string").cast("binary")) % parts == left_out, F.lit(False))


def _lower(raw: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals in lower case, byte for byte."""
    out = tv._LOWER[raw]
    if len(raw) > 1:
        at = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)) + 1
        out[at] += 32
    return out


@dataclass
class Words:
    """The words of a slice: runs of letters, digits and non-ASCII characters that have a letter."""

    s: np.ndarray
    e: np.ndarray
    row: np.ndarray
    word: np.ndarray
    gram: np.ndarray
    edge: np.ndarray
    script: np.ndarray
    letters: np.ndarray


def words(raw: np.ndarray, off: np.ndarray) -> Words:
    s, e, row = tv.spans(raw, off, _ONLY_WORDS)
    n = len(raw)
    letter = np.concatenate([[0], np.cumsum(_LETTER[raw] | (raw >= 0xC2))])
    has = letter[e] > letter[s]
    s, e, row = s[has], e[has], row[has]
    low = np.where(_ONLY_WORDS[raw] == tv.WORD, _lower(raw), 0x20).astype(np.uint32)
    pad = np.concatenate([[0x20], low, [0x20]]).astype(np.uint32)
    before, after = pad[:-2].copy(), pad[2:].copy()
    before[s], after[e - 1] = 0x20, 0x20
    inside = np.zeros(n + 1, np.int8)
    inside[s] += 1
    inside[e] -= 1
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    gram = ((before[at] << np.uint32(16)) | (pad[1:-1][at] << np.uint32(8)) | after[at]) * np.uint32(0x9E3779B1) >> np.uint32(15)
    edge = np.searchsorted(at, s)
    script = np.zeros(n, np.uint64)
    script[_LETTER[raw]] = _LATIN
    lead = np.flatnonzero(raw >= 0xC2)
    if len(lead):
        x = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.int64)
        b0, b1, b2, b3 = (x[lead + k] for k in range(4))
        cp = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1 & 63, np.where(b0 < 0xF0, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63, (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63))
        script[lead] = _BIT[np.maximum(np.searchsorted(_FROM, cp, "right") - 1, 0)]
    bits = np.bitwise_or.reduceat(script[at], edge) if len(s) else np.zeros(0, np.uint64)
    hashes = tv.word_hashes(low.astype(np.uint8), s, e) >> np.uint64(47)
    return Words(s, e, row, hashes.astype(np.int64), gram.astype(np.int64), edge, bits, letter[e] - letter[s])


_ONLY_WORDS = np.where(tv.CLASSES == tv.WORD, tv.WORD, tv.SPACE).astype(np.uint8)


class Model:
    """Learned languages: trigram and word tables, and each language's scripts."""

    def __init__(self, langs: list[str], texts: Iterable[pa.Array]):
        self.langs = langs
        k = len(langs)
        grams, seen, self.scripts = np.full((BUCKETS, k), 0.2), np.zeros((BUCKETS, k)), np.zeros(k, np.uint64)
        for i, text in enumerate(texts):
            script = np.zeros(64)
            for _, _, raw, off in tv.slices(text, lower=False):
                w = words(raw, off)
                grams[:, i] += np.bincount(w.gram, minlength=BUCKETS)
                seen[:, i] += np.bincount(w.word, minlength=BUCKETS)
                for b in range(len(_NAMES)):
                    script[b] += w.letters[(w.script >> np.uint64(b)) & np.uint64(1) == 1].sum()
            own = script >= SCRIPT_SHARE * max(script.sum(), 1)
            self.scripts[i] = sum(1 << b for b in range(64) if own[b] and script[b])
        # Words speak only as far as they're commoner in one language than in others.
        seen = seen / np.maximum(seen.sum(axis=0), 1) + 2e-5
        self.gram = np.log(grams / grams.sum(axis=0)).astype(np.float32)
        self.word = np.log(seen).astype(np.float32)

    def scores(self, w: Words) -> np.ndarray:
        """Of each word and language, 0 for the best and -FLOOR at least."""
        k = len(self.langs)
        if not len(w.s) or not k:
            return np.zeros((len(w.s), k), np.float32)
        out = np.empty((len(w.s), k), np.float32)
        for i in range(k):
            out[:, i] = np.add.reduceat(self.gram[:, i][w.gram], w.edge) + self.word[:, i][w.word]
        fits = (w.script[:, None] & self.scripts[None, :]) != 0
        out[~fits] = -np.inf
        best = out.max(axis=1, keepdims=True)
        none = ~np.isfinite(best[:, 0])
        best[none] = 0
        out = np.maximum(out - best, -FLOOR)
        out[none] = 0
        return out

    def label(self, score: np.ndarray) -> np.ndarray:
        """The best path's language for each word of one text."""
        total = score.sum(axis=0, dtype=np.float64)
        main = int(total.argmax())
        run = np.concatenate([np.zeros((1, score.shape[1])), np.cumsum(score - score[:, main : main + 1], axis=0, dtype=np.float64)])
        if (run - np.minimum.accumulate(run, axis=0)).max() <= SWITCH:
            return np.full(len(score), main, np.int8)
        rows = score.tolist()
        now, back = rows[0], []
        for x in rows[1:]:
            best = max(now)
            top = now.index(best)
            best -= SWITCH
            back.append([top if best > v else i for i, v in enumerate(now)])
            now = [s + (best if best > v else v) for s, v in zip(x, now, strict=True)]
        at = now.index(max(now))
        out = [at]
        for b in reversed(back):
            at = b[at]
            out.append(at)
        return np.array(out[::-1], np.int8)

    def predict(self, text: pa.Array, spans: bool = False) -> Iterator[tuple]:
        """(language, score 0 to 1) of each text, with ``spans`` also its [(first, end, language)] in characters."""
        for at, end, raw, off in tv.slices(text, lower=False):
            w = words(raw, off)
            score = self.scores(w)
            edge = tv.bounds(w.row, end - at)
            char = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)]) if spans else None
            for r in range(end - at):
                a, b = edge[r], edge[r + 1]
                own = raw[off[r] : off[r + 1]]
                if not self.langs or a == b or not (_LETTER[own].any() or any(c.isalpha() for c in own.tobytes().decode())):
                    yield ("und", 0.0, []) if spans else ("und", 0.0)
                    continue
                x = score[a:b]
                path = self.label(x)
                share = np.bincount(path, weights=w.letters[a:b], minlength=len(self.langs))
                share /= share.sum()
                pred = int(share.argmax())
                total = x.sum(axis=0, dtype=np.float64)
                rest = np.delete(total, pred)
                margin = max(0.0, total[pred] - rest.max()) if len(rest) else np.inf
                sure = float(share[pred] / (1 + (len(self.langs) - 1) * np.exp(-min(margin, 50.0))))
                if not spans:
                    yield self.langs[pred], sure
                    continue
                cut = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
                last = np.append(cut[1:], len(path)) - 1
                base = char[off[r]]
                yield self.langs[pred], sure, [(int(char[w.s[a + i]] - base), int(char[w.e[a + j]] - base), self.langs[path[i]]) for i, j in zip(cut, last, strict=True)]


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_ROWS) -> Model:
    """A model of at most ``most`` texts of each language of ``labelled`` (see ``TRAIN_ROWS`` for all bounds), chosen by a hash of the id."""
    rows = labelled.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    size = F.octet_length("text")
    rows = rows.where(size <= TEXT_BYTES)
    most_rows = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(size).alias("b")).orderBy(F.desc("n"), "lang").limit(LANGS).collect()
    share = {r["lang"]: min(1.0, most / r["n"], TRAIN_BYTES / max(r["b"], 1)) for r in most_rows}
    langs = sorted(share)
    if not langs:
        return Model([], [])
    part = F.pmod(F.xxhash64("i"), F.lit(1 << 20))
    share = F.element_at(F.create_map(*[F.lit(x) for k in langs for x in (k, int(share[k] * (1 << 20)))]), F.col("lang"))
    rows = rows.where(F.col("lang").isin(langs))
    got = rows.where(part < share).select("lang", "text").toArrow()
    model = Model(langs, (got.filter(pa.compute.equal(got["lang"], k))["text"].combine_chunks() for k in langs))
    del got
    tv.give_back()
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, lang_pred string, score double) of each row of ``docs``.

    ``und`` with score 0 where the text is null, empty or has no letter, or no
    language was learned. Repeated rows and null ids keep their rows. An empty
    table gives an empty one; other columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(shared.value.predict(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    own = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, lang_pred string, score double")


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, spans array<struct<first int, end int, lang string>>): runs of one language, in characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [[{"first": f, "end": e, "lang": k} for f, e, k in x[2]] for x in shared.value.predict(b.column(1), spans=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, kind)], ["doc_id", "spans"])

    own = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, spans array<struct<first int, end int, lang string>>")


def accepted(docs: DataFrame, model: Model, least: float = 0.0, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known with a score above ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch], at=docs.columns.index(text_col)) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([k != "und" and s > least for k, s in shared.value.predict(b.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
