"""Near duplicates, repeated passages and contamination against brute force over small tables with odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import frame

from lodestar.llm import rolling as R
from lodestar.llm.components import connected_components
from lodestar.llm.decontaminate import clean_documents, contamination
from lodestar.llm.ngram_join import near_duplicate_components, one_per_component
from lodestar.llm.substring_dedup import remove_repeated_windows
from lodestar.llm.suffix_dedup import BlindTrie, remove_repeated_bytes, repeated_windows

WORD = re.compile("[^\x20\x09-\x0d]+")


def low(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def key(x):
    return tuple((v is None, v) for v in x)


def brute_windows(rows, length):
    ws = [WORD.findall(t or "") for _, t, _ in rows]
    n = Counter(tuple(w[i : i + length]) for w in ws for i in range(len(w) - length + 1))
    out = []
    for (i, _, _), w in zip(rows, ws, strict=True):
        gone = {k for a in range(len(w) - length + 1) if n[tuple(w[a : a + length])] > 1 for k in range(a, a + length)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=key)


def test_substring_dedup(docs, rows):
    got = [tuple(r) for r in remove_repeated_windows(docs).collect()]
    assert sorted(got, key=key) == brute_windows(rows, 35)


def brute_bytes(rows, length=50):
    inf = float("inf")
    first = {}
    raws = [(t or "").encode() for _, t, _ in rows]
    ids = [inf if i is None else i for i, _, _ in rows]
    for i, b in zip(ids, raws, strict=True):
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            first[s] = min(first.get(s, inf), i)
    out = []
    for (doc, _, _), i, b in zip(rows, ids, raws, strict=True):
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        edges = np.diff(np.concatenate(([0], gone.astype(int))))
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((doc, len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=key)


def test_suffix_dedup(docs, rows):
    got = [tuple(r) for r in remove_repeated_bytes(docs).collect()]
    assert sorted(got, key=key) == brute_bytes(rows)


def test_blind_trie_orders_and_groups():
    rng = np.random.default_rng(3)
    keys = [bytes(rng.integers(97, 99, 12).astype(np.uint8)) for _ in range(300)]
    trie = BlindTrie(keys[0], 0)
    for k, s in enumerate(keys[1:], 1):
        trie.insert(s, k)
    groups = [sorted(g) for g in trie.leaves()]
    want = defaultdict(list)
    for k, s in enumerate(keys):
        want[s].append(k)
    assert groups == [want[s] for s in sorted(want)]


def test_repeated_windows_need_a_smaller_document():
    text = np.frombuffer(b"a" * 120 + b"b" * 8, dtype=np.uint8)
    pos, doc = np.array([0, 10, 40, 61]), np.array([3, 3, 5, 5])
    assert repeated_windows(text, np.zeros(4, dtype=int), pos, doc, 50).tolist() == [False, False, True, True]
    assert not repeated_windows(text, np.arange(4), pos, doc, 50).any()


def brute_components(rows):
    sets = []
    for _, t, _ in rows:
        w = WORD.findall(low(t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    best = defaultdict(list)
    for k, (i, _, _) in enumerate(rows):
        if i is not None and sets[k]:
            best[find(k)].append(i)
    out = []
    for k, (i, _, _) in enumerate(rows):
        comp = (min(best[find(k)]) if best[find(k)] else None) if sets[k] else i
        out.append((i, len(sets[k]), comp))
    return sorted(out, key=key)


def test_ngram_join(docs, rows):
    got = [tuple(r)[:3] for r in near_duplicate_components(docs).collect()]
    want = brute_components(rows)
    assert sorted(got, key=key) == want
    assert len({c for _, n, c in want if n}) < len([1 for _, n, _ in want if n])


def test_one_document_of_each_component_stays(docs, rows):
    kept = one_per_component(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    comp = {c for _, n, c in brute_components(rows) if n}
    worded = [x for x in got if WORD.search(x[2])]
    assert sorted(i for null, i, _ in worded if not null) == sorted(c for c in comp if c is not None)
    assert len(got) - len(worded) == sum(1 for _, t, _ in rows if not WORD.search(t or ""))


def test_unrelated_texts_of_null_or_repeated_ids_stay(spark):
    """Components, not their smallest ids, are thinned: null ids and one id with two texts name several components."""
    text = lambda c: " ".join(f"{c}{i}" for i in range(40))
    crc = ["tc50963c80102", "td3f504638284"]  # two texts of one CRC-32
    data = [(None, text("a")), (None, text("b")), (None, text("b") + " more"), (7, text("c")), (7, text("d")), (9, text("d")), (None, text("e")), (8, text("e"))]
    data += [(None, t) for t in crc]
    got = one_per_component(spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)).collect()
    got = sorted(((r["doc_id"], r["text"]) for r in got), key=key)
    b = {t for i, t in got if i is None and t.startswith("b0")}
    assert len(b) == 1 and b <= {text("b"), text("b") + " more"}
    want = [(None, text("a")), (None, b.pop()), (7, text("c")), (7, text("d")), (8, text("e")), *((None, t) for t in crc)]
    assert got == sorted(want, key=key)


def test_near_copies_in_one_group(spark):
    """Many near copies of one text: one component, whatever their number of pairs."""
    base = [f"t{i}" for i in range(80)]
    data = [(k, " ".join(w if i != k % 80 else f"e{k}" for i, w in enumerate(base))) for k in range(400)]
    d = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    got = near_duplicate_components(d).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 400


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (-5, -9)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {k: 100 for k in range(100, 150)} | {-5: -9, -9: -9}


ITEMS = "item_id bigint, text string, extra string"


def brute_contamination(rows, items, length=10):
    def split(t):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t or ""))

    wins = {}
    for item, t in items:
        w = split(t)
        for i in range(max(1, len(w) - length + 1)) if w else ():
            wins.setdefault(tuple(w[i : i + length]), set()).add(item)
    out = []
    for i, t, _ in rows:
        w, hit, names = split(t), set(), set()
        for a in range(len(w)):
            for n in {len(x) for x in wins}:
                x = tuple(w[a : a + n])
                if len(x) == n and x in wins:
                    hit |= set(range(a, a + n))
                    names |= wins[x]
        n_items, names = len(names), sorted(str(x) for x in names if x is not None)
        out.append((i, len(w), len(hit), n_items, hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=key)


@pytest.mark.parametrize("block", [500_000, 40])
def test_decontamination(spark, docs, rows, block):
    items = [(1, rows[3][1]), (10, " ".join(rows[4][1].split()[2:14]).upper()), (2, "One TWO-three"), (3, ""), (4, None), (None, rows[8][1]), (1, rows[3][1]), (5, rows[50][1][:400])]
    t = spark.createDataFrame([(i, x, "e") for i, x in items], ITEMS)
    got = [tuple(r) for r in contamination(docs, t, block_windows=block).collect()]
    want = brute_contamination(rows, items)
    assert sorted(got, key=key) == want
    assert 0 < sum(r[-1] for r in want) < len(want)
    clean = clean_documents(docs, t, block_windows=block)
    assert clean.columns == docs.columns and clean.count() == sum(not r[-1] for r in want)


def test_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([], ITEMS)
    assert contamination(docs, items).where("contaminated OR n_items > 0").count() == 0
    for f in (remove_repeated_windows, remove_repeated_bytes, near_duplicate_components, one_per_component, lambda d: contamination(d, items)):
        assert f(empty).count() == 0


def test_rolling_helpers():
    import pyarrow as pa

    col = pa.array(["ab  c", None, "", " d", "e\tf g"])
    (i, j, data, off), *rest = R.text_slices(col)
    assert (i, j) == (0, 5) and not rest
    s, e, first = R.find_words(data, off, R.NOT_BLANK)
    assert [bytes(data[a:b]) for a, b in zip(s, e, strict=True)] == [b"ab", b"c", b"d", b"e", b"f", b"g"]
    assert first.tolist() == [0, 2, 2, 2, 3, 6]
    assert [x[:2] for x in R.text_slices(col, 5)] == [(0, 3), (3, 4), (4, 5)]
    h = np.array([5, 3, 3, 9, 1, 1], dtype=np.uint64) << np.uint64(40)
    assert R.sliding_argmin(h, 3).tolist() == [1, 1, 4, 4]
    a, b = R.merge_spans(np.array([5, 0, 2, 9]), np.array([7, 2, 4, 10]))
    assert a.tolist() == [0, 5, 9] and b.tolist() == [4, 7, 10]


def crc_twins():
    """Two unlike texts of equal CRC-32: 60 words of a passage, and 121 words that occur nowhere else."""
    import zlib

    passage = [f"p{k}q" for k in range(60)]
    a = " ".join(passage)
    alone = " ".join(f"u{k}v" for k in range(120))
    want, table = zlib.crc32(a.encode()), {}
    # the CRC after a suffix is linear in it: meet in the middle over three letters before and four behind
    letters = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_"
    head = f"{alone} ".encode()
    start = zlib.crc32(head)
    for x in letters:
        for y in letters:
            for z in letters:
                w = bytes((x, y, z))
                table[zlib.crc32(w, start)] = w
    # undo four bytes from the wanted value: crc tables are invertible
    crc = [0] * 256
    for n in range(256):
        c = n
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        crc[n] = c
    back = {c >> 24: n for n, c in enumerate(crc)}

    def undo(value, byte):
        value ^= 0xFFFFFFFF
        n = back[value >> 24]
        return ((((value ^ crc[n]) << 8) & 0xFFFFFFFF) | (n ^ byte)) ^ 0xFFFFFFFF

    for t in letters:
        one = undo(want, t)
        for u in letters:
            two = undo(one, u)
            for v in letters:
                three = undo(two, v)
                if three in table:
                    b = (head + table[three] + bytes((v, u, t))).decode()
                    assert zlib.crc32(b.encode()) == want
                    return a, b, passage
    raise AssertionError("no twin")


def test_marks_beside_columns_of_their_names(spark):
    from lodestar.llm.decontaminate import mark_documents

    item = " ".join(f"i{k}" for k in range(12))
    rows = [(1, f"a b {item} c", 7, "x", 8, None, True), (2, "a b c", 9, "y", 1, "z", False)]
    d = spark.createDataFrame(rows, "doc_id int, text string, n_words int, __words string, __Items int, _dc_n_hit string, contaminated boolean")
    items = spark.createDataFrame([(None, item)], "item_id bigint, text string")
    got = mark_documents(d, items).orderBy("doc_id").collect()
    assert [tuple(r)[:7] for r in got] == rows and got[0].__fields__[7:] == ["_n_words", "_n_hit", "_n_items", "_items_sha256", "_contaminated"]
    assert [tuple(r)[7:10] for r in got] == [(15, 12, 1), (3, 0, 0)] and got[0]["_items_sha256"] == hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in clean_documents(d, items).collect()] == rows[1:]


def test_null_ids_of_equal_crc_keep_their_own_text(spark):
    """A null id's row is named by 62 bits of its text: another text of equal CRC loses nothing to it."""
    a, b, passage = crc_twins()
    rows = [(1, "start here " + " ".join(passage) + " end there", "s"), (None, a, "s"), (None, b, "s")]
    d = frame(spark, rows)
    got = {(r["n_words"], r["n_removed"]) for r in remove_repeated_windows(d).collect()}
    assert got == {(64, 60), (60, 60), (121, 0)}
    removed = {r["n_bytes"]: r["n_removed"] for r in remove_repeated_bytes(d).collect()}
    assert removed[len(b)] == 0 and removed[len(a)] == len(a)


def test_a_frequent_phrase_in_different_surroundings_is_split(spark):
    """One 12-word phrase in a third of all documents: its windows are dealt by their own hash, and equal ones still meet."""
    from lodestar.llm import substring_dedup as SD
    from lodestar.llm.packing import keyed_texts

    rng, sc = random.Random(12), SD._Scan(35)
    phrases = [[f"f{rng.randrange(10**6)}" for _ in range(12)] for _ in range(3000)]
    slices = [R.text_slices(pa.array([" ".join(p)])) for p in phrases]
    hashes = [int(sc.anchor.grams(sc.words.spans(sc.words.prefix(d), *R.find_words(d, off, R.NOT_BLANK)[:2]), 12)[0]) for s in slices for _, _, d, off in s]
    phrase = phrases[int(np.argmin(np.array(hashes, dtype=np.uint64)))]  # so low a hash that it anchors every window around it
    rows, n = [], 240
    for k in range(n):
        own = [f"d{k}w{j}" for j in range(90)]
        rows.append((k, " ".join(own[:45] + (phrase if k % 3 == 0 else []) + own[45:]), "s"))
    rows += [(500 + k, rows[30][1], "s") for k in range(2)] + [(600, " ".join(rows[60][1].split()[20:75]), "s")]  # whole and partial copies of some
    d = frame(spark, rows)
    want = brute_repeats(rows)
    for hot in (20, SD.HOT):
        got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in SD.remove_repeated_windows(d, hot=hot, hot_local=2).collect())
        assert got == want
    texts = keyed_texts(d, "doc_id", "text", 64)

    def largest(hot):
        per = SD.candidate_windows(texts, 35, 64, hot, 2).where("bucket >= 0").groupBy("bucket").agg(F.sum(F.length("once") / 8).alias("n")).collect()
        return max(r["n"] or 0 for r in per), sum(r["n"] or 0 for r in per)

    (split, all_), (whole, same) = largest(20), largest(SD.HOT)
    assert all_ == same > 1000 and whole > 0.8 * all_ and split < 0.1 * all_


def brute_repeats(rows, length=35):
    seen = Counter()
    for _, t, _ in rows:
        w = t.split()
        seen.update(tuple(w[i : i + length]) for i in range(len(w) - length + 1))
    out = []
    for i, t, _ in rows:
        w = t.split()
        gone = {j for k in range(len(w) - length + 1) if seen[tuple(w[k : k + length])] > 1 for j in range(k, k + length)}
        out.append((i, len(w), len(gone)))
    return sorted(out)
