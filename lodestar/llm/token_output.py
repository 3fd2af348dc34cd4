"""Token ids as Parquet lists in id order, written for selective reads, and read back.

*Layout.* One folder of Parquet files; shard k (one file) holds the documents of the k-th id range, ascending. Columns: the id, ``tokens`` (a list
of INT32, dictionary encoded: a vocabulary of 49k ids packs to 16 bits), ``n_tokens``, ``local_start`` (ids of the shard before the document) and
``shard``. Row groups, pages and the dictionary have set sizes and the writer adds page indexes, so a reader of a few documents, or of
the counts alone, touches only their pages.

*Encoding.* Under a vocabulary with the rules of ``WORD_RULES`` (lower case, blanks dropped, letters parted from punctuation) texts are cut into pieces that
no token spans, in lower case, and every distinct piece is encoded once per worker by the tokenizers library; a bounded cache in two generations
keeps the pieces in use. Under any other vocabulary the library encodes each whole text. The end id closes every document.

*Order.* Rows are range-partitioned by (id, CRC and hash of the text, place in the scan), so a shard is even however often an id or null occurs, and sorted inside
its task. Starts are running sums within a shard plus the totals of the shards before it (one row a shard).

Defined results: null is the empty text (only the end id); repeated ids lie side by side, each row a document of its own; null ids come first; an empty table
writes an empty folder and gives no rows. Only id and text are read.
"""

from __future__ import annotations

import functools
import json
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .rolling import LOWER, NOT_BLANK, find_words, release_memory, text_slices
from .terms import word_codes

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
CACHE = 250_000  # pieces a generation
FEW = 40_000
SLICE = 1 << 21

# The normaliser and pre-tokenizer under which pieces may be encoded apart and in lower case.
WORD_RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}

#: row groups of 32 MB, pages of at most 256 KB or 2,000 documents, dictionary pages up to 1 MB
WRITE_OPTIONS = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.writer.version": "v2",
    "compression": "zstd",
}


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable Latin-1 as itself, the others from code point 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [c for c in range(256) if c not in plain]
    return {c: chr(c) if c in plain else chr(256 + rest.index(c)) for c in range(256)}


#: ASCII letters and digits are 1, ASCII punctuation but the apostrophe (which may open a suffix) 2, all else 0
CLASS = np.zeros(256, dtype=np.uint8)
CLASS[[c for c in range(128) if chr(c).isalnum()]] = 1
CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = 2


def loosened(data: np.ndarray, off: np.ndarray):
    """Lower-cased bytes with a blank wherever ASCII letters or digits touch punctuation, and the new offsets: tokens part there anyway."""
    low = LOWER[data]
    c = CLASS[low]
    at = np.flatnonzero((c[1:] ^ c[:-1]) == 3) + 1  # 1 beside 2
    return np.insert(low, at, 32), off + np.searchsorted(at, off, side="left")


class _Encoder:
    """Texts -> little-endian uint32 ids.

    With ``WORD_RULES``, pieces (runs without ASCII blanks of the loosened text) are encoded once and kept in two generations: a piece of the older
    one that occurs again moves to the younger, and when that is full the older one is dropped. A piece of Latin letters closed by ASCII
    punctuation is the letters' ids and the punctuation's; such letters are one pre-token, which the library's model encodes without
    running the rules again. Texts with a bracket of a special token, or with marks that may combine with a letter before it is lowered, are
    cut at blanks only, as they are.
    """

    PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
    LETTERS = _byte_letters()

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        own = json.loads(definition)
        self.by_piece = all(own.get(k) == v for k, v in WORD_RULES.items())
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, body: bytes) -> bytes:
        """Ids of lower-case letters."""
        word = body.decode("latin-1")
        if not body.isascii():
            word = word.translate(self.LETTERS)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def kept(self, key: bytes, make) -> bytes:
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            self.young[key] = got = make(key) if got is None else got
            if len(self.young) > CACHE:
                self.old, self.young = self.young, {}
        return got

    def piece(self, p: bytes) -> bytes:
        body = p.rstrip(self.PUNCTUATION)
        if body.isascii():
            low, ok = body.lower(), body.isalpha()
        else:
            text = body.decode("utf-8", "replace")
            low, ok = text.lower().encode(), text.isalpha() and max(text) <= "\xff"
        if not ok:
            return self.ids(p.decode("utf-8", "replace"))
        if low == p:
            return self.letters(low)
        got = self.kept(low, self.letters)
        if len(body) < len(p):
            got += self.kept(p[len(body) :], lambda tail: self.ids(tail.decode()))
        return got

    def forget(self) -> None:
        self.young, self.old = {}, {}
        release_memory()

    def documents(self, raws: list[bytes]) -> list[bytes]:
        ids, n = self.slice(np.frombuffer(b"".join(raws), dtype=np.uint8), np.cumsum([0, *map(len, raws)]))
        at = np.concatenate(([0], np.cumsum(n)))
        return [ids[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]

    def cut(self, data: np.ndarray, off: np.ndarray):
        """The bytes whose blanks part the pieces, and the texts' offsets in them."""
        loose, at = loosened(data, off)
        odd = (data == 0xCC) | (data == 0xCD)
        odd[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
        keep = np.unique(np.searchsorted(off, np.flatnonzero(odd), side="right") - 1).tolist()
        if not keep:
            return loose, at
        parts = [loose[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
        for k in keep:
            parts[k] = data[off[k] : off[k + 1]]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def slice(self, data: np.ndarray, off: np.ndarray):
        """(ids of all texts of a slice, number of ids of each): each distinct piece of the slice is looked up once."""
        if not self.by_piece:
            got = [self.ids(data[a:b].tobytes().decode("utf-8", "replace")) for a, b in zip(off[:-1], off[1:], strict=True)]
            return np.frombuffer(b"".join(got), dtype="<u4"), np.array([len(x) // 4 for x in got], dtype=np.int64)
        data, off = self.cut(data, off)
        s, e, first = find_words(data, off, NOT_BLANK)
        code, pieces = word_codes(data, s, e, NOT_BLANK, pa.binary())
        words = pieces.to_pylist()
        got = list(map(self.young.get, words))
        for k in [k for k, x in enumerate(got) if x is None]:
            got[k] = self.kept(words[k], self.piece)
        flat, size = np.frombuffer(b"".join(got), dtype="<u4"), np.array([len(x) // 4 for x in got], dtype=np.int64)
        begin, n = (np.cumsum(size) - size)[code], size[code]
        upto = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(int(upto[-1])) + np.repeat(begin - upto[:-1], n)
        return flat[at], np.diff(upto[first])


@functools.lru_cache(maxsize=1)
def _encoder(definition: str) -> _Encoder:
    """The worker process's encoder: its pieces serve the tasks that follow there."""
    return _Encoder(definition)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def output_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"


def write_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID, shard_docs: int = 50_000,
    keep_pieces: bool = True,
) -> int:
    """Write the token files; returns the number of shards asked for.

    Encoded pieces stay with a worker for the tasks that follow there. Where other stages will run in the same workers,
    ``keep_pieces=False`` keeps at most about FEW of them and gives their memory back after every task, at the price of encoding common pieces again.
    """
    spark = docs.sparkSession
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())  # one vocabulary file
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // shard_docs))

    def encode(batches):
        enc, shard, start = _encoder(definition.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            for i, j, data, off in text_slices(batch.column(1), SLICE if keep_pieces else SLICE >> 2):
                if not keep_pieces and len(enc.young) > FEW:
                    enc.forget()
                ids, n = enc.slice(data, off)
                closed = np.full(len(ids) + len(n), end_id, dtype=np.int32)
                closed[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
                n = n + 1
                at = np.concatenate(([0], np.cumsum(n)))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(closed))
                own = pa.array(np.full(j - i, shard, dtype=np.int32))
                yield pa.record_batch([batch.column(0).slice(i, j - i), lists, pa.array(n), pa.array(start + at[:-1]), own], names=["id", "tokens", "n_tokens", "local_start", "shard"])
                start += int(at[-1])
        if not keep_pieces:
            enc.forget()

    text = F.coalesce(F.col(text_col), F.lit(""))
    order = ["id", "crc", "hash", "place"]
    x = docs.select(
        F.col(id_col).cast("bigint").alias("id"), text.alias("t"),
        F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("place"),
    )
    x = x.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("id", "t")
    x = x.mapInArrow(encode, "id bigint, tokens array<int>, n_tokens bigint, local_start bigint, shard int")
    x.withColumnRenamed("id", id_col).write.options(**WRITE_OPTIONS).parquet(path)
    return shards


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens, ids_crc32 of every document, from the files."""
    x = spark.read.parquet(path)
    totals = x.groupBy("shard").agg(F.sum("n_tokens").alias("t"))
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("shard", F.coalesce(F.sum("t").over(w), F.lit(0)).alias("before"))  # one row a shard
    x = x.join(F.broadcast(before), "shard")

    def check(batches):
        for batch in batches:
            lists = batch.column(3)
            off = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.record_batch([*batch.columns[:3], pa.array(crc, pa.int64())], names=["_id", "start", "n_tokens", "ids_crc32"])

    x = x.select(F.col(id_col).alias("_id"), (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "tokens")
    return x.mapInArrow(check, "_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint").withColumnRenamed("_id", id_col)


def token_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, vocabulary: str | None = None, keep_pieces: bool = True) -> DataFrame:
    """Write the files (to a new shared folder unless ``path`` is given) and describe them by reading them back."""
    spark = docs.sparkSession
    path = path or output_folder(spark)
    write_tokens(docs, path, id_col, text_col, vocabulary, keep_pieces=keep_pieces)
    return read_tokens(spark, path, id_col).withColumn(id_col, F.col(id_col).cast(dict(docs.dtypes)[id_col]))
