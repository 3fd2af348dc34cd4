"""Find benchmark passages in documents: a prefix-filtered join of item windows with document words.

A window is ``length`` consecutive words of an item (10); a shorter item is one window. A document contains a window if all its words occur there in
order, so the containment is exact and the necessary prefix of a window, ordered by rarity, is its rarest word:

1. *Rarity.* The words of the item windows are counted over all documents (one number a word of the items).
2. *Join.* Windows are indexed by their rarest word. Document words that are such a word are joined with its windows.
3. *Bounds.* The rarest word's place in the window fixes where the window would start; it must start and end inside the document.
4. *Verification.* The span of exactly that many words is compared, first by hash, then word by word.

Items are taken in blocks of at most ``block_windows`` windows in id order; each block is broadcast (bounded by that number) and is one pass over the
documents, chained without a shuffle. Documents are never shuffled, so no passage is too frequent.

Defined results: null texts and texts without a word have no words and no hits; items without a word are no items; items with a null id
mark their words like any other and count as one item together, which the list of ids leaves out; repeated items of one id count once; repeated rows are judged one by one; empty tables give no rows, or rows without hits. Columns that are
not named pass through :func:`mark_documents` unchanged, whatever their names: the prefix of the new columns gets underscores until none clashes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling as R

LENGTH = 10
MARKS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
_WORDS, _GRAMS = R.SpanHash(401), R.SpanHash(402)


def split_words(raw: bytes) -> list[bytes]:
    low = R.LOWER[np.frombuffer(raw, dtype=np.uint8)]
    return np.where(R.ALNUM[low], low, 32).astype(np.uint8).tobytes().split()


def _word_hash(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    end = np.cumsum([len(w) for w in words])
    return _WORDS.spans(_WORDS.prefix(data), end - [len(w) for w in words], end)


def _scan(data, off):
    """Lower-cased bytes, word starts and ends, word hashes, first words of a slice."""
    low = R.LOWER[data]
    s, e, first = R.find_words(low, off, R.ALNUM)
    wh = _WORDS.spans(_WORDS.prefix(low), s, e) if len(s) else np.zeros(0, dtype=np.uint64)
    return low, s, e, wh, first


def item_windows(items: DataFrame, id_col: str, text_col: str, length: int, block_windows: int):
    """Blocks of (item id as string, list of window words); an item's windows stay in one block unless they exceed it."""
    kind = "item string, words binary"

    def cut(batches):
        for batch in batches:
            words = [b" ".join(split_words(t.as_buffer().to_pybytes())) if t.is_valid else b"" for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(words, pa.binary())], names=["item", "words"])

    x = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("_t"))
    block: list[tuple[str, list[bytes]]] = []
    for row in x.mapInArrow(cut, kind).where("length(words) > 0").distinct().orderBy("item", "words").toLocalIterator():
        words = bytes(row["words"]).split()
        for i in range(max(1, len(words) - length + 1)):
            block.append((row["item"], words[i : i + length]))
            if len(block) >= block_windows:
                yield block
                block = []
    if block:
        yield block


@dataclass
class WindowIndex:
    """Windows of a block by their rarest word: rows of one word are windows[first[k]:first[k + 1]]."""

    tokens: np.ndarray  # sorted hashes of the rarest words
    first: np.ndarray
    place: np.ndarray  # the rarest word's place in each window
    size: np.ndarray
    hash: np.ndarray
    words: list
    item: list


def word_counts(texts: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences over all documents of the words with these (sorted) hashes."""
    v = texts.sparkSession.sparkContext.broadcast(vocabulary)  # words of one block of windows

    def scan(batches):
        n = np.zeros(len(v.value), dtype=np.int64)
        for batch in batches:
            for _, _, data, off in R.text_slices(batch.column(0)):
                wh = _scan(data, off)[3]
                at = np.minimum(np.searchsorted(v.value, wh), len(v.value) - 1)
                n += np.bincount(at[v.value[at] == wh], minlength=len(n))
        k = np.flatnonzero(n)
        yield pa.record_batch([pa.array(k, pa.int64()), pa.array(n[k], pa.int64())], names=["k", "n"])

    out = np.zeros(len(vocabulary), dtype=np.int64)
    for r in texts.mapInArrow(scan, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["k"]] = r["n"]
    return out


def index_windows(texts: DataFrame, block: list[tuple[str, list[bytes]]]) -> WindowIndex:
    hashes = _word_hash([w for _, words in block for w in words])
    vocabulary, inv = np.unique(hashes, return_inverse=True)
    count = word_counts(texts, vocabulary)
    size = np.array([len(words) for _, words in block])
    begin = np.cumsum(size) - size
    place = np.empty(len(block), dtype=np.int64)
    whole = np.empty(len(block), dtype=np.uint64)
    prefix = _GRAMS.prefix(hashes)
    for k, (b, n) in enumerate(zip(begin.tolist(), size.tolist(), strict=True)):
        ids = inv[b : b + n]
        place[k] = np.lexsort((np.arange(n), vocabulary[ids], count[ids]))[0]
    whole = _GRAMS.spans(prefix, begin, begin + size)
    token = hashes[begin + place]
    o = np.argsort(token, kind="stable")
    tokens, first = np.unique(token[o], return_index=True)
    return WindowIndex(tokens, np.append(first, len(o)), place[o], size[o], whole[o], [block[k][1] for k in o], [block[k][0] for k in o])


def find_windows(ix: WindowIndex, data, off):
    """Occurrences in a slice: (word starts, ends of the windows, their index rows, words per text offsets)."""
    low, s, e, wh, first = _scan(data, off)
    none = np.zeros(0, dtype=np.int64)
    if not len(wh):
        return none, none, none, first
    t = np.minimum(np.searchsorted(ix.tokens, wh), len(ix.tokens) - 1)
    at = np.flatnonzero(ix.tokens[t] == wh)
    t = t[at]
    n = ix.first[t + 1] - ix.first[t]
    row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ix.first[t], n)
    start = np.repeat(at, n) - ix.place[row]
    end = start + ix.size[row]
    text = np.repeat(np.searchsorted(first, at, side="right") - 1, n)
    ok = (start >= first[text]) & (end <= first[text + 1])  # length and place
    start, end, row = start[ok], end[ok], row[ok]
    ok = _GRAMS.spans(_GRAMS.prefix(wh), start, end) == ix.hash[row]
    start, end, row = start[ok], end[ok], row[ok]
    raw = low.tobytes()
    same = [[raw[s[i] : e[i]] for i in range(a, b)] == ix.words[r] for a, b, r in zip(start.tolist(), end.tolist(), row.tolist(), strict=True)]
    same = np.array(same, dtype=bool)
    return start[same], end[same], row[same], first


def free_prefix(columns, prefix: str, names=MARKS) -> str:
    """``prefix`` with as many underscores as it takes for none of ``names`` to be a column already (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return prefix


def mark_documents(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", length: int = LENGTH,
    block_windows: int = 500_000, prefix: str = "",
) -> DataFrame:
    """All columns of ``docs`` and n_words, n_hit, n_items, items_sha256, contaminated (names after ``prefix``, see ``free_prefix``)."""
    prefix = free_prefix(docs.columns, prefix)
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.col(text_col).alias("_text"))
    at_text = docs.columns.index(text_col)
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    indexes = [sc.broadcast(index_windows(texts, block)) for block in item_windows(items, item_id, item_text, length, block_windows)]

    def mark(batches):
        for batch in batches:
            spans: list[bytes | None] = [None] * batch.num_rows
            names: list[set] = [set() for _ in spans]
            for index in indexes:
                _mark_block(index.value, batch.column(at_text), spans, names)
            n_words, n_hit, n_items, sha, hit = [], [], [], [], []
            for text, span, found in zip(batch.column(at_text), spans, names, strict=True):
                covered = 0
                if span:
                    s, e = R.merge_spans(*np.frombuffer(span, dtype=np.int64).reshape(2, -1))
                    covered = int((e - s).sum())
                n_words.append(len(split_words(text.as_buffer().to_pybytes())) if text.is_valid else 0)
                n_hit.append(covered)
                n_items.append(len(found))
                sha.append(hashlib.sha256(",".join(sorted(found - {None})).encode()).hexdigest())
                hit.append(covered > 0)
            cols = [*batch.columns, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha, pa.string()), pa.array(hit, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, *(prefix + c for c in MARKS)])

    # one pass for all blocks: every further Python step would hold a worker of its own in each running task
    return docs.mapInArrow(mark, f"{base}, `{prefix}n_words` bigint, `{prefix}n_hit` bigint, `{prefix}n_items` bigint, `{prefix}items_sha256` string, `{prefix}contaminated` boolean")


def _mark_block(ix: WindowIndex, texts: pa.Array, spans: list, names: list) -> None:
    """Add the words hit by the windows of a block to each text's ``spans``, and the windows' items to its ``names``."""
    for i, _, data, off in R.text_slices(texts):
        start, end, row, first = find_windows(ix, data, off)
        text = np.searchsorted(first, start, side="right") - 1
        for k in np.unique(text).tolist():
            own = text == k
            s, e = R.merge_spans(*(v[own] - first[k] for v in (start, end)))
            old = spans[i + k]
            if old:
                a, b = np.frombuffer(old, dtype=np.int64).reshape(2, -1)
                s, e = np.concatenate((a, s)), np.concatenate((b, e))
            spans[i + k] = np.concatenate((s, e)).astype(np.int64).tobytes()
            names[i + k].update(ix.item[r] for r in row[own])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    x = mark_documents(x, items, "_text", **kw)
    return x.select(F.col("_id").alias(id_col), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs."""
    x = mark_documents(docs, items, text_col, prefix="_dc_", **kw)
    return x.where(~F.col(free_prefix(docs.columns, "_dc_") + "contaminated")).select(*docs.columns)
