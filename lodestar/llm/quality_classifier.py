"""Quality score from compressed sizes: zstandard dictionaries of good and of bad labelled text.

Training uses a bounded sample of labelled rows: at most ``sample_docs`` documents of each label, those of smallest id hash. Half of them
(by another bit of the hash) feed the two dictionaries with pieces of ``piece`` bytes, at most ``pieces_per_doc`` a
document, chosen by hash over the whole text; the other half calibrates. What reaches the driver is bounded by these parameters.

A text is scored whole: it is cut into pieces, each compressed with either dictionary and with none, and the sizes are summed.
The difference (bad - good) over the raw size, with the plain compression ratio (and its square) beside it, goes through a logistic
calibration fitted on the held-back half of the sample. Labels, language, source and id are not inputs of a score.

Defined results: null and empty texts have difference 0 and ratio 1 and get that point's score; rows with a null id may be scored but are never
learned from; a sample without both labels gives every text the share of label 1 (0.5 without labels); repeated label rows of one id count
once if they agree, and an id with both labels is not learned from; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import bounded_sample

LEVEL = 3


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the scaled features, the constant last


class _Sizes:
    def __init__(self, good: bytes, bad: bytes, piece: int):
        self.piece = piece
        make = lambda d: zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
        dicts = [zstandard.ZstdCompressionDict(x) for x in (good, bad)]
        for d in dicts:
            d.precompute_compress(level=LEVEL)
        self.by = [make(d) for d in dicts] + [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)]

    def features(self, raw: bytes) -> tuple[float, float, float]:
        if not raw:
            return 0.0, 0.0, 0.0
        parts = [raw[i : i + self.piece] for i in range(0, len(raw), self.piece)]
        good, bad, plain = (sum(len(c.compress(p)) for p in parts) for c in self.by)
        ratio = float(np.log((plain + 8) / (len(raw) + 8)))
        return (bad - good) / len(raw), ratio, ratio * ratio


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_docs: int) -> DataFrame:
    """(label, order, text) of at most ``sample_docs`` documents of each label; ids first, so only their texts move."""
    lab = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_lid"))
    lab = lab.agg(F.min(label_col).alias("label"), F.max(label_col).alias("_top")).where("label = _top").drop("_top")
    ids = bounded_sample(lab, "label", "_lid", sample_docs)
    # at most 2 * sample_docs rows
    x = docs.select(F.col(id_col).alias("_did"), F.col(text_col).alias("text"))
    return x.join(F.broadcast(ids), F.col("_did") == F.col("_lid")).select("label", F.xxhash64("_lid").alias("order"), "text")


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2):
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w += np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * w)
    return mean, scale, w


def train_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_docs: int = 4000, piece: int = 1024, pieces_per_doc: int = 6, dict_bytes: int = 65536,
) -> QualityModel:
    rows = labelled_sample(docs, labels, id_col, text_col, label_col, sample_docs)

    def cut(batches):
        """Dictionary half: chosen pieces, as they are."""
        for batch in batches:
            label, order, text = (batch.column(k) for k in range(3))
            lab, key, got = [], [], []
            for k in range(batch.num_rows):
                o = order[k].as_py()
                if o & 64 or not text[k].is_valid:
                    continue
                raw = text[k].as_buffer().to_pybytes()
                n = -(-len(raw) // piece)
                pick = range(n) if n <= pieces_per_doc else sorted(np.random.Generator(np.random.PCG64(o & (2**63 - 1))).choice(n, pieces_per_doc, replace=False))
                for i in pick:
                    lab.append(label[k].as_py())
                    key.append(o)
                    got.append(raw[i * piece : (i + 1) * piece])
            yield pa.record_batch([pa.array(lab, pa.int32()), pa.array(key, pa.int64()), pa.array(got, pa.binary())], names=["label", "order", "bytes"])

    parts = rows.mapInArrow(cut, "label int, order bigint, bytes binary").collect()
    parts.sort(key=lambda r: (r["order"], bytes(r["bytes"])))
    dicts = []
    for q in (1, 0):
        raw = [bytes(r["bytes"]) for r in parts if r["label"] == q and r["bytes"]]
        try:
            dicts.append(zstandard.train_dictionary(dict_bytes, raw).as_bytes())
        except (zstandard.ZstdError, ValueError):  # too few samples to train on: the samples themselves serve
            dicts.append(b"".join(raw)[:dict_bytes] or b"\0" * 8)
    good, bad = dicts

    def measure(batches):
        sizes = _Sizes(good, bad, piece)
        for batch in batches:
            at = [k for k in range(batch.num_rows) if batch.column(1)[k].as_py() & 64]
            f = [sizes.features(batch.column(2)[k].as_buffer().to_pybytes() if batch.column(2)[k].is_valid else b"") for k in at]
            y = [batch.column(0)[k].as_py() for k in at]
            yield pa.record_batch([pa.array(y, pa.int32()), *[pa.array([v[i] for v in f], pa.float64()) for i in range(3)]], names=["y", "a", "b", "c"])

    got = sorted(tuple(r) for r in rows.mapInArrow(measure, "y int, a double, b double, c double").collect())
    y, x = np.array([r[0] for r in got], dtype=float), np.array([r[1:] for r in got], dtype=float).reshape(-1, 3)
    if len(set(y)) < 2:
        share = y.mean() if len(y) else 0.5
        bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return QualityModel(good, bad, np.zeros(3), np.ones(3), np.array([0.0, 0.0, 0.0, bias]))
    return QualityModel(good, bad, *_fit(x, y))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", piece: int = 1024, threshold: float = 0.7) -> DataFrame:
    """id, score (0 to 1) and predicted (1 from ``threshold`` on) of every row."""
    m = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries and a few numbers
    kind = dict(docs.dtypes)[id_col]

    def scan(batches):
        sizes, mod = _Sizes(m.value.good, m.value.bad, piece), m.value
        for batch in batches:
            f = np.array([sizes.features(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(1)]).reshape(-1, 3)
            z = np.c_[(f - mod.mean) / mod.scale, np.ones(len(f))] @ mod.weights
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.record_batch([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["_id", "score", "predicted"])

    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).mapInArrow(scan, f"_id {kind}, score double, predicted int")
    return out.withColumnRenamed("_id", id_col)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The query's fold: learn from rows whose crc32(id as text) mod 4 is not 2, score all."""
    fold = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = train_quality(docs, labels.where(~fold(id_col)), id_col, **kw)
    return score_quality(docs, model, id_col).withColumn("held_out", fold(id_col))
