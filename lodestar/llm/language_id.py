"""Language of every whole text: script ranges narrow the candidates, Viterbi over word scores labels spans.

*Training.* Per language, hashed letter trigrams (and word ends) of a bounded sample: at most ``sample_docs`` labelled documents of each
language, those of smallest id hash. Only one table of 2**16 log-probabilities a language reaches the driver.

*Words.* A word is a run of letters. Its script is that of its first letter, by code-point ranges; languages that do not write that script (under 1% of
their sampled letters) cannot label it, and a word in a script no
language writes says nothing: its letters count in a text's total, but for no language. Its score in a language is the sum of
its trigrams' log-probabilities, bounded to ``word_cap`` below the best language so that one odd word cannot force a switch.

*Spans.* The best labelling of a text's words under a cost for every switch (Viterbi) gives the spans. ``lang_pred`` is the language with most
letters, ``score`` its share of all letters. All texts of an Arrow batch advance together, longest first, one word a step.

Defined results: null text, or text without a letter, is ``und`` with score 0; a text wholly in scripts that no learned language writes gets the first language
with score 0 (``accepted_documents`` drops it); without any training row every text is ``und``; rows with a null language or
text teach nothing; ties go to the language that sorts first; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling as R
from .packing import bounded_sample

TABLE_BITS = 16
MAX_LANGS = 1000
POINTS = 0x20000
FLUSH_WORDS = 200_000

# First and last code points of scripts (Unicode blocks); 0 is "other letters".
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF),
    ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F), ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x137F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF), ("han", 0xF900, 0xFAFF),
)
SCRIPT_NAMES = ("other", *sorted({s for s, _, _ in SCRIPTS}))


@functools.cache
def _point_tables():
    """Per code point below POINTS: is a letter, simple lower case, script number."""
    letter = np.zeros(POINTS, dtype=bool)
    lower = np.arange(POINTS, dtype=np.uint32)
    for c in range(POINTS):
        s = chr(c)
        if s.isalpha():
            letter[c] = True
            low = s.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    script = np.zeros(POINTS, dtype=np.uint8)
    for name, a, b in SCRIPTS:
        script[a : b + 1] = SCRIPT_NAMES.index(name)
    return letter, lower, script


class _Words:
    """Letters and words of a slice of texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        letter, lower, script = _point_tables()
        cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
        lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        edges = lead[off]  # code points before each text
        if edges[-1] != len(cp):  # replaced bytes: count text by text
            raw = data.tobytes()
            edges = np.concatenate(([0], np.cumsum([len(raw[a:b].decode("utf-8", "replace")) for a, b in zip(off[:-1], off[1:], strict=True)])))
            cp = np.frombuffer("".join(raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:], strict=True)).encode("utf-32-le"), dtype=np.uint32)
        small = np.minimum(cp, POINTS - 1)
        is_letter = letter[small] | (cp >= POINTS)  # planes 2 and 3 hold ideographs only
        at = np.flatnonzero(is_letter)
        text = np.searchsorted(edges, at, side="right") - 1
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (np.diff(at) != 1) | (np.diff(text) != 0)
        self.start = np.flatnonzero(fresh)  # among letters
        self.letters = np.diff(np.append(self.start, len(at)))
        self.text = text[self.start]
        self.first = np.searchsorted(self.text, np.arange(len(off)))
        self.script = script[small[at[self.start]]]
        c0 = lower[small[at]].astype(np.uint64)
        c1, c2 = np.zeros_like(c0), np.zeros_like(c0)
        c1[1:] = np.where(fresh[1:], 0, c0[:-1])
        c2[1:] = np.where(fresh[1:], 0, c1[:-1])
        h = (c0 * R.U64(0x9E3779B97F4A7C15)) ^ (c1 * R.U64(0xC2B2AE3D27D4EB4F)) ^ (c2 * R.U64(0x165667B19E3779F9))
        self.gram = (R.mix(h) >> R.U64(64 - TABLE_BITS)).astype(np.int64)
        last = np.append(self.start[1:], len(at)) - 1
        end = (c0[last] * R.U64(0xFF51AFD7ED558CCD)) ^ (c1[last] * R.U64(0xC4CEB9FE1A85EC53)) if len(at) else c0
        self.end_gram = (R.mix(end + R.U64(1)) >> R.U64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class LanguageModel:
    langs: list[str]
    scores: np.ndarray  # (2**TABLE_BITS, languages) log-probabilities
    writes: np.ndarray  # (scripts, languages) whether the language writes the script


def train_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = 2000) -> LanguageModel:
    """Learn from the rows given (the caller leaves held-out rows away)."""
    ok = docs.select(F.col(id_col).alias("_did"), F.col(lang_col).alias("_dlang"), F.col(text_col).alias("_t")).dropna()
    ids = ok.select(F.col("_did").alias("_lid"), F.col("_dlang").alias("_lang")).distinct()
    names = [r["_lang"] for r in ids.select("_lang").distinct().limit(MAX_LANGS + 1).collect()]
    if len(names) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    ids = bounded_sample(ids, "_lang", "_lid", sample_docs)
    names.sort(key=lambda s: s.encode())
    # at most sample_docs rows a language
    rows = ok.join(F.broadcast(ids), (F.col("_did") == F.col("_lid")) & (F.col("_dlang") == F.col("_lang"))).select("_lang", "_t")
    n_scripts = len(SCRIPT_NAMES)

    def count(batches):
        sums = {}
        for batch in batches:
            lang = np.array(batch.column(0).to_pylist(), dtype=object)
            for i, j, data, off in R.text_slices(batch.column(1)):
                words = _Words(data, off)
                own = lang[i:j][words.text] if len(words.text) else lang[:0]
                per_letter = np.repeat(own, words.letters)
                for name in set(own.tolist()):
                    n = np.bincount(words.gram[per_letter == name], minlength=1 << TABLE_BITS) + np.bincount(words.end_gram[own == name], minlength=1 << TABLE_BITS)
                    s = np.bincount(words.script[own == name], weights=words.letters[own == name], minlength=n_scripts)
                    a, b = sums.get(name, (0, 0))
                    sums[name] = (a + n, b + s)
        names_ = list(sums)
        yield pa.record_batch([pa.array(names_, pa.string()), pa.array([np.concatenate(sums[k]).astype(np.float64).tobytes() for k in names_], pa.binary())], names=["lang", "counts"])

    def add(table):
        total = sum(np.frombuffer(x, dtype=np.float64) for x in table["counts"].to_pylist())
        return pa.table([table["lang"][:1], pa.chunked_array([[total.tobytes()]], pa.binary())], names=["lang", "counts"])

    got = {r["lang"]: np.frombuffer(r["counts"], dtype=np.float64) for r in rows.mapInArrow(count, "lang string, counts binary").groupBy("lang").applyInArrow(add, "lang string, counts binary").collect()}
    names = [n for n in names if n in got]
    size = 1 << TABLE_BITS
    grams = np.array([got[n][:size] for n in names]).reshape(-1, size)
    prob = (grams + 0.1) / (grams.sum(1, keepdims=True) + 0.1 * size)
    scripts = np.array([got[n][size:] for n in names]).reshape(-1, n_scripts)
    writes = scripts >= 0.01 * np.maximum(scripts.sum(1, keepdims=True), 1)
    return LanguageModel(names, np.log(prob).T.astype(np.float32).copy(), writes.T.copy())


def word_scores(model: LanguageModel, words: _Words, word_cap: float):
    """(words, languages): score below the best language of the word, at least -word_cap; all 0 in an unknown script. And which words' script is known."""
    if not len(words.start):
        return np.zeros((0, len(model.langs)), dtype=np.float32), np.zeros(0, dtype=bool)
    s = np.add.reduceat(model.scores[words.gram], words.start, axis=0) + model.scores[words.end_gram]
    can = model.writes[words.script]
    known = can.any(1)
    s = np.where(can, s, -np.inf)
    s[~known] = 0
    return np.maximum(s - s.max(1, keepdims=True), -word_cap).astype(np.float32), known


def viterbi(scores: np.ndarray, first: np.ndarray, n: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word. Text k has words first[k] : first[k] + n[k]; texts advance together, longest first."""
    langs = scores.shape[1]
    label = np.zeros(len(scores), dtype=np.int16)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    if not len(order) or langs == 1:
        return label
    first, n = first[order], n[order]
    alive = np.searchsorted(-n, -np.arange(1, n[0] + 1), side="right")  # texts with a t-th word
    back = np.zeros((len(scores), langs), dtype=np.int16)
    v = scores[first]
    own = np.arange(langs, dtype=np.int16)
    for t in range(1, int(n[0])):
        k = alive[t]
        at = first[:k] + t
        v_k = v[:k]
        best = v_k.argmax(1)
        jump = v_k[np.arange(k), best][:, None] - switch
        stay = v_k >= jump
        back[at] = np.where(stay, own, best[:, None])
        v[:k] = np.where(stay, v_k, jump) + scores[at]
    last = v.argmax(1).astype(np.int16)
    label[first + n - 1] = last
    cur = last
    for t in range(int(n[0]) - 1, 0, -1):
        k = alive[t]
        at = first[:k] + t
        cur[:k] = back[at, cur[:k]]
        label[at - 1] = cur[:k]
    return label


def _decide(model: LanguageModel, parts, texts: int, switch: float):
    """Language and share of each text, and label, text and first word of every word, of the held ``parts`` of ``texts`` texts."""
    scores, words_of, letters, known = (np.concatenate([p[k] for p in parts]) for k in range(4))
    first = np.concatenate(([0], np.cumsum(words_of)))[:-1]
    label = viterbi(scores, first, words_of, switch)
    text = np.repeat(np.arange(texts), words_of)
    share = np.zeros((texts, max(1, len(model.langs))))
    np.add.at(share, (text, label), letters * known)
    total = np.bincount(text, letters, minlength=texts)  # letters of an unknown script count for no language
    top = share.argmax(1)
    pred = [model.langs[k] if t else "und" for k, t in zip(top.tolist(), total.tolist(), strict=True)]
    score = np.where(total > 0, share[np.arange(texts), top] / np.maximum(total, 1), 0.0)
    return pred, score, label, text, first


def _labelled_parts(model: LanguageModel, column, switch: float, word_cap: float):
    """(first text, end, decision) over a column of texts: parts of a bounded number of words advance together."""
    held, begin, n_words = [], 0, 0
    for i, j, data, off in R.text_slices(column):
        words = _Words(data, off)
        if not model.langs:  # nothing learned: no word counts
            held.append((np.zeros((0, 1), dtype=np.float32), np.zeros(j - i, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=bool)))
        else:
            scores, known = word_scores(model, words, word_cap)
            held.append((scores, np.diff(words.first), words.letters, known))
        n_words += len(held[-1][0])
        if n_words >= FLUSH_WORDS:
            yield begin, j, _decide(model, held, j - begin, switch)
            held, begin, n_words = [], j, 0
    if held:
        yield begin, len(column), _decide(model, held, len(column) - begin, switch)


def label_languages(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", switch: float = 8.0, word_cap: float = 12.0, prefix: str = "", spans: bool = False
) -> DataFrame:
    """All columns of ``docs`` and lang_pred, score (names after ``prefix``); with ``spans`` also an array of (first word, end word, lang).

    Only the texts go to the Python workers and only the decisions come back.
    """
    m = docs.sparkSession.sparkContext.broadcast(model)  # 2**16 numbers a language
    span = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def label(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = m.value
        for column in columns:
            preds, scores, found = [], [], []
            for _, _, (pred, score, words, text, first) in _labelled_parts(model, column, switch, word_cap):
                preds += pred
                scores.append(score)
                if spans:
                    per = [[] for _ in pred]
                    s, e = R.runs_of(words.astype(np.int64) + text * (len(model.langs) + 1), np.ones(len(words), dtype=bool))
                    for x, y in zip(s.tolist(), e.tolist(), strict=True):
                        k = int(text[x])
                        per[k].append({"first": x - int(first[k]), "end": y - int(first[k]), "lang": model.langs[words[x]]})
                    found += per
            cols = [pa.array(preds, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            names = ["lang_pred", "score"]
            if spans:
                cols.append(pa.array(found, pa.list_(span)))
                names.append("spans")
            yield pa.StructArray.from_arrays(cols, names=names)

    types = "lang_pred string, score double" + (", spans array<struct<first:int,end:int,lang:string>>" if spans else "")
    held = "_label"
    while held in docs.columns:
        held += "_"
    x = docs.withColumn(held, F.arrow_udf(label, types)(F.col(text_col).cast("string")))
    return x.select(*docs.columns, *[F.col(held)[c].alias(prefix + c) for c in ("lang_pred", "score", "spans")[: 2 + spans]])


def _held_out(c: str):
    return F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = 2000) -> DataFrame:
    """The query's fold: learn from rows whose crc32(id as text) mod 3 is not 1, predict all from their texts."""
    model = train_languages(docs.where(~_held_out(id_col)), id_col, text_col, lang_col, sample_docs)
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    out = label_languages(x, model, "_text").select(F.col("_id").alias(id_col), "lang_pred", "score")
    return out.withColumn("held_out", _held_out(id_col))


def accepted_documents(docs: DataFrame, min_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows with a language: those without a letter, or without a language of at least ``min_share`` of the letters, go."""
    model = train_languages(docs.where(~_held_out(id_col)), id_col, text_col, lang_col)
    x = label_languages(docs, model, text_col, prefix="_li_")
    return x.where((F.col("_li_lang_pred") != "und") & (F.col("_li_score") >= min_share)).select(*docs.columns)
