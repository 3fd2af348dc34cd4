"""Secrets in whole texts: strong patterns, and weak parts of a credential that are reported only next to their complements.

*Strong kinds* stand alone: ``assign`` (a named value), ``access`` (an access key id) and ``hex`` (a long run of hex digits).

*Parts.* A credential has an identifier (``access``, or the weak ``ident``: a named user, client or account), a secret (``assign``, ``hex``, or the weak ``key``:
a run of 20+ characters with upper-case, lower-case letters and digits, apart from all strong spans and addresses) and often an endpoint (the weak
``endpoint``: an address with a scheme).

*Linking.* Parts are joined by interval within their scope: a scope is a paragraph (no empty line lies between two of its parts), and two parts
meet if at most ``reach`` code points lie between them. A weak ``ident`` is reported if it meets a secret, a weak ``key`` if it meets an identifier, an ``endpoint``
if it meets an identifier and a secret. Every kind's spans are disjoint and sorted, so a part's partners are a range of them: the join costs two binary searches
a part, however many parts a scope holds, and no pairs are listed.

Texts are read in slices of consecutive rows; rows are never shuffled, so no source and no group of copies is hot.

Defined results: null and empty texts have no spans; patterns know ASCII letters only; spans are in code points, end exclusive, ordered by start, then kind;
rows are judged one by one, repeated rows and ids too; an empty table gives no rows. ``mark_secrets`` and ``redacted_documents`` keep all columns, whatever their names
(the new column's name is a parameter).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling as R

KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
BASE = KINDS[:3]
IDENTIFIERS, SECRETS = ("access", "ident"), ("assign", "hex", "key")
REACH = 200
LEAST = {"assign": 6, "access": 20, "hex": 24, "ident": 4, "key": 20}
SEPARATOR = b"\x00"  # belongs to no pattern

# Patterns over lower-cased bytes. The value is a group of its own: its length decides.
NAMED = rb"""["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)" + NAMED)
IDENT = re.compile(rb"(?:access_?key_?id|client_?id|user_?name|account_?id|login)" + NAMED)
ENDPOINT = re.compile(rb"""[a-z][a-z0-9+.-]*://[^\x00-\x20"'<>\\^`{|}\x7f]+""")
# over the bytes as they are
ACCESS = re.compile(rb"AKIA([A-Z0-9]+)")


def _class(chars: bytes) -> np.ndarray:
    return ~R.byte_class(chars)


UPPER, LOWER, DIGIT = _class(bytes(range(0x41, 0x5B))), _class(bytes(range(0x61, 0x7B))), _class(bytes(range(0x30, 0x3A)))
HEX = DIGIT | _class(b"abcdef")
KEY = UPPER | LOWER | DIGIT | _class(b"+/_=-")


def _runs(data, off, wanted, least: int):
    s, e, _ = R.find_words(data, off, wanted)
    long = e - s >= least
    return s[long], e[long]


def _matches(pattern, joined: bytes, least: int, shift: np.ndarray):
    """Spans of a pattern whose value has ``least`` bytes; ``shift`` holds where each text starts in ``joined``."""
    at = [(m.start(), m.end()) for m in pattern.finditer(joined) if not least or m.end(1) - m.start(1) >= least]
    s, e = np.array(at, dtype=np.int64).reshape(-1, 2).T
    text = np.searchsorted(shift, s, side="right") - 1
    return s - text, e - text  # one separator before each text but the first


def _meets(s, e, others_s, others_e, low, high, reach: int):
    """Which spans have one of the other spans (disjoint, sorted) within reach, inside their scope [low, high)."""
    last = np.searchsorted(others_s, np.minimum(e + reach, high - 1), side="right")
    first = np.searchsorted(others_e, np.maximum(s - reach, low + 1), side="left")
    return last > first


def _free(s, e, others_s, others_e):
    """Which spans overlap none of the other spans (disjoint, sorted)."""
    return np.searchsorted(others_s, e, side="left") <= np.searchsorted(others_e, s, side="right")


def scan_slice(data: np.ndarray, off: np.ndarray, reach: int = REACH):
    """(text, kind number, start, end) of all spans of a slice, in code points of their text, ordered."""
    low = R.LOWER[data]
    texts = [low[a:b].tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]
    joined = SEPARATOR.join(texts)
    shift = off[:-1] + np.arange(len(texts))
    raw = data.tobytes()
    spans = {"assign": _matches(ASSIGN, joined, LEAST["assign"], shift), "hex": _runs(data, off, HEX, LEAST["hex"])}
    none = (np.zeros(0, dtype=np.int64),) * 2
    spans["ident"] = _matches(IDENT, joined, LEAST["ident"], shift)
    spans["endpoint"] = _matches(ENDPOINT, joined, 0, shift) if b"://" in joined else none
    spans["access"] = none
    if b"AKIA" in raw:
        cased = SEPARATOR.join(raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True))
        spans["access"] = _matches(ACCESS, cased, LEAST["access"] - 4, shift)
    s, e = _runs(data, off, KEY, LEAST["key"])
    if len(s):
        has = [np.concatenate(([0], np.cumsum(c[data]))) for c in (UPPER, LOWER, DIGIT)]
        ok = np.logical_and.reduce([h[e] > h[s] for h in has])
        for kind in (*BASE, "endpoint"):
            ok &= _free(s, e, *spans[kind])
        s, e = s[ok], e[ok]
    spans["key"] = (s, e)
    if not any(len(x[0]) for x in spans.values()):
        return (np.zeros(0, dtype=np.int64),) * 4

    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # code points before each byte
    spans = {k: (chars[s], chars[e]) for k, (s, e) in spans.items()}
    starts = chars[off[:-1]]
    empty = np.flatnonzero((data[1:] == 10) & (data[:-1] == 10)) + 1
    edges = np.unique(np.concatenate((starts, chars[empty], [chars[-1]])))

    def meets(kind, others):
        s, e = spans[kind]
        at = np.searchsorted(edges, s, side="right")
        lo, hi = edges[at - 1], edges[np.minimum(at, len(edges) - 1)]
        return np.logical_or.reduce([_meets(s, e, *spans[o], lo, hi, reach) for o in others])

    keep = {k: np.ones(len(spans[k][0]), dtype=bool) for k in BASE}
    keep["ident"] = meets("ident", SECRETS)
    keep["key"] = meets("key", IDENTIFIERS)
    keep["endpoint"] = meets("endpoint", IDENTIFIERS) & meets("endpoint", SECRETS)
    kind = np.concatenate([np.full(int(keep[k].sum()), n) for n, k in enumerate(KINDS)])
    s, e = (np.concatenate([spans[k][side][keep[k]] for k in KINDS]) for side in range(2))
    order = np.lexsort((kind, s))
    kind, s, e = kind[order], s[order], e[order]
    text = np.searchsorted(starts, s, side="right") - 1
    return text, kind, s - starts[text], e - starts[text]


SPANS = "array<struct<kind: string, start: int, end: int>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_NAMES = pa.array(KINDS)


def _scan(docs: DataFrame, keep, text_col: str, out: str, reach: int, mask: str | None) -> DataFrame:
    """Columns ``keep`` and ``out``: the spans, or with a ``mask`` the text with every covered stretch replaced by it."""
    x = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))

    def scan(batches):
        for batch in batches:
            column = batch.column(1)
            results = []
            for i, j, data, off in R.text_slices(column):
                text, kind, s, e = scan_slice(data, off, reach)
                at = np.searchsorted(text, np.arange(j - i + 1))
                if mask is None:
                    rows = pa.StructArray.from_arrays([_NAMES.take(pa.array(kind)), pa.array(s, pa.int32()), pa.array(e, pa.int32())], fields=list(_SPAN))
                    results.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows))
                    continue
                texts = column.slice(i, j - i).to_pylist()
                for k in np.unique(text):
                    a, b = R.merge_spans(s[at[k] : at[k + 1]], e[at[k] : at[k + 1]])
                    cut = np.concatenate(([0], np.column_stack((a, b)).ravel(), [len(texts[k])])).tolist()
                    texts[k] = mask.join(texts[k][p:q] for p, q in zip(cut[::2], cut[1::2], strict=True))
                results.append(pa.array(texts, pa.string()))
            got = pa.concat_arrays(results) if results else pa.array([], pa.list_(_SPAN) if mask is None else pa.string())
            yield pa.record_batch([batch.column(0), got], names=["row", "found"])

    types = x.select("row").schema[0].dataType.simpleString()
    y = x.mapInArrow(scan, f"row {types}, found {SPANS if mask is None else 'string'}")
    return y.select("row.*", F.col("found").alias(out))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """id and ``spans``, an array of (kind, start, end), of every document."""
    return _scan(docs, [F.col(id_col)], text_col, "spans", reach, None)


def mark_secrets(docs: DataFrame, text_col: str = "text", out: str = "secret_spans", reach: int = REACH) -> DataFrame:
    """All columns and ``out`` with the spans."""
    return _scan(docs, ["*"], text_col, out, reach, None)


def redacted_documents(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """All columns, in the text every stretch covered by spans replaced by ``mask``."""
    other = "_redacted"
    while other in docs.columns:
        other += "_"
    x = _scan(docs, ["*"], text_col, other, reach, mask)
    return x.select(*[F.col(other).alias(c) if c == text_col else F.col(c) for c in docs.columns])


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """id, the number of strong spans a kind, a digest of them, and all spans as text."""
    x = find_secrets(docs, id_col, text_col, reach)
    named = lambda s: F.transform(s, lambda v: F.concat_ws(":", v["kind"], v["start"].cast("string"), v["end"].cast("string")))
    count = lambda kind: F.size(F.filter("spans", lambda v: v["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda v: v["kind"].isin(*BASE))
    return x.select(
        id_col, *[count(k) for k in BASE], F.sha2(F.array_join(named(base), ","), 256).alias("base_sha256"), F.array_join(named("spans"), ",").alias("spans")
    )
