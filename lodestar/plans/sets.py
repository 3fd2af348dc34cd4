"""Driver queries of the MinHash and LSH operators.

Customer sets (o_custkey -> distinct l_partkey) carry the set and Jaccard jobs; documents, as sets of
hashed 5-shingles, carry the LSH jobs (they hold exact and near copies, so buckets collide).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.columns import round6, text_clean
from ..operators import lsh as L
from ..operators import minhash as M
from ..operators import set_join as SJ
from ..operators.groups import reliable_checkpoint, written
from ..operators.stored import stored_table
from ..operators.text import shingle_arrays, shingle_ids, shingle_keys
from ..sources.tables import customer_item_sets, documents, table
from .registry import query
from .text import CLEAN_SQL

NUM_HASHES = 100
BANDS, ROWS = 20, 5
DOC_K = 5
MAX_GROUP = 10
S_CURVE_GRID = [(2, 10), (2, 50), (5, 10), (5, 50)]
AT_LEAST = (7, 100)
RATE_GRID = [(2, 10), (2, 50), (5, 10), (5, 20)]
ANCHORS, PER_BIN = 50, 400
P31 = 2**31 - 1

FAMILY = M.hash_family(NUM_HASHES)
LARGE = M.large_prime_family()

SETS_SQL = """sets AS (SELECT DISTINCT o_custkey::BIGINT AS set_id, l_partkey::BIGINT AS element
              FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL)"""
HF_SQL = "hf(k, a, b) AS (VALUES " + ", ".join(f"({k}, {a}::BIGINT, {b}::BIGINT)" for k, (a, b) in enumerate(FAMILY)) + ")"
DOC_SETS_SQL = f"""docs AS (SELECT doc_id, {CLEAN_SQL} AS t FROM documents),
sets AS (SELECT DISTINCT doc_id::BIGINT AS set_id, ('0x' || substr(md5(s), 1, 15))::BIGINT AS element
         FROM (SELECT doc_id, unnest(list_transform(range(1, length(t) - {DOC_K - 2}), lambda i: substring(t, i, {DOC_K}))) AS s
               FROM docs))"""
SIG_SQL = f"""{HF_SQL},
sig AS (SELECT set_id, k, min(((a * (element % {P31}) + b) % {P31}) + 1) AS h FROM sets, hf GROUP BY 1, 2)"""
BH_SQL = f"""{SIG_SQL},
bh AS (SELECT set_id, (k // {ROWS})::INTEGER AS band, md5(string_agg(h::VARCHAR, ',' ORDER BY k)) AS bucket
       FROM sig GROUP BY 1, 2)"""
BUCKETS_SQL = f"""{BH_SQL},
bd AS (SELECT band, bucket, count(*) AS size FROM bh GROUP BY 1, 2),
bx AS (SELECT bh.*, size, ('0x' || substr(md5(set_id::VARCHAR), 1, 8))::BIGINT % greatest(1, ceil(size / 10000.0))::BIGINT AS chunk
       FROM bh JOIN bd USING (band, bucket)),
buckets AS (SELECT band, bucket, chunk, size, array_to_string(list_sort(list(set_id)), ',') AS members
            FROM bx GROUP BY band, bucket, chunk, size)"""
CAND_SQL = f"""{BH_SQL},
rep AS (SELECT band, bucket, min(set_id) AS rep FROM bh GROUP BY 1, 2 HAVING count(*) >= 2),
cand AS (SELECT DISTINCT rep AS set_a, set_id AS set_b FROM bh JOIN rep USING (band, bucket) WHERE set_id <> rep)"""
JACCARD_SQL = f"""{SETS_SQL},
sz AS (SELECT set_id, count(*) AS n FROM sets GROUP BY 1),
i AS (SELECT a.set_id AS set_a, b.set_id AS set_b, count(*) AS intersection
      FROM sets a JOIN sets b ON a.element = b.element AND a.set_id < b.set_id GROUP BY 1, 2),
jp AS (SELECT set_a, set_b, intersection, na.n + nb.n - intersection AS union_size,
              intersection / (na.n + nb.n - intersection) AS jaccard
       FROM i JOIN sz na ON na.set_id = set_a JOIN sz nb ON nb.set_id = set_b)"""


def cust_sets(spark, sf):
    return M.set_elements(customer_item_sets(spark, sf))


def doc_sets(spark, sf, docs=None):
    """Documents as sets of 5-shingle ids (first 15 hex digits of md5 of the shingle: 60 bits)."""
    d = doc_contents(docs if docs is not None else documents(spark, sf))
    return M.set_elements(shingle_arrays(d, DOC_K).select("set_id", F.explode("elements").alias("element")))


def doc_contents(docs):
    """(set_id, content): the cleaned text of every document with an id; ``_shingled`` makes the same set of it as ``doc_sets``."""
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("set_id"), text_clean(F.col("text")).alias("content"))


def _shingled(texts):
    return shingle_ids(texts, DOC_K)


def _build_signatures(spark, sf):
    """Signatures of whole texts, in place; the sets of ids that several rows share are united first, and their parts' signatures merged."""
    docs = documents(spark, sf)
    again = table(spark, sf, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = reliable_checkpoint(again.where("n > 1 AND doc_id IS NOT NULL").select("doc_id"))
    if not again.limit(1).count():
        return M.signature_arrays(doc_contents(docs), FAMILY, digest=True, elements=_shingled)
    one = M.signature_arrays(doc_contents(docs.join(again, "doc_id", "left_anti")), FAMILY, digest=True, elements=_shingled)
    sets = doc_sets(spark, sf, docs.join(again, "doc_id"))
    parts = sets.groupBy("set_id", F.pmod(F.xxhash64("element"), F.lit(64)).alias("_part")).agg(F.collect_list("element").alias("content"))
    more = M.signature_arrays(parts, FAMILY, digest=True, elements=lambda lists: [np.array(x, dtype=np.int64) for x in lists], parts=True)
    return one.unionByName(more)


def doc_signatures(spark, sf):
    """(set_id, sig, n, digest) of all documents: shingled and hashed once, then read by every query over them (``stored_table``)."""
    return stored_table(spark, f"doc_signatures_{DOC_K}_{NUM_HASHES}", f"{sf.rstrip('/')}/documents.parquet", "set_id", lambda: _build_signatures(spark, sf))


def doc_band_hashes(spark, sf):
    return L.band_hashes(doc_signatures(spark, sf), BANDS, ROWS)


@query("set_elements", f"WITH {SETS_SQL} SELECT * FROM sets")
def q_set_elements(spark, sf):
    return cust_sets(spark, sf)


@query("minhash_signatures", f"WITH {SETS_SQL}, {SIG_SQL} SELECT set_id, k, h FROM sig")
def q_minhash_signatures(spark, sf):
    return M.signatures_long(M.signature_arrays(cust_sets(spark, sf), FAMILY))


@query("minhash_large_prime", f"""
WITH {SETS_SQL},
sz AS (SELECT set_id, count(*) AS n FROM sets GROUP BY 1),
lf(k, a, b, p) AS (VALUES {", ".join(f"({k}, {a}::HUGEINT, {b}::HUGEINT, {p}::HUGEINT)" for k, (a, b, p) in enumerate(LARGE))})
SELECT set_id, k, min(((a + element * b) % p) % n + 1)::BIGINT AS h FROM sets JOIN sz USING (set_id), lf GROUP BY 1, 2""")
def q_minhash_large_prime(spark, sf):
    return M.large_prime_signatures(cust_sets(spark, sf), LARGE)


@query("jaccard_pairs", f"WITH {JACCARD_SQL} SELECT set_a, set_b, intersection, union_size, round(jaccard, 6) AS jaccard FROM jp")
def q_jaccard_pairs(spark, sf):
    # the sets are read by the degree count that sizes the pair join and by the join itself: write once
    j = M.jaccard_pairs(written(cust_sets(spark, sf)))
    return j.select("set_a", "set_b", "intersection", "union_size", round6("jaccard").alias("jaccard"))


@query("jaccard_at_least", f"""
WITH {JACCARD_SQL}
SELECT set_a, set_b, intersection, union_size, round(jaccard, 6) AS jaccard FROM jp
WHERE intersection * {AT_LEAST[1]} >= union_size * {AT_LEAST[0]}""")
def q_jaccard_at_least(spark, sf):
    j = SJ.jaccard_at_least(reliable_checkpoint(cust_sets(spark, sf)), *AT_LEAST)
    return j.select("set_a", "set_b", "intersection", "union_size", round6("jaccard").alias("jaccard"))


def brand_sets(spark, sf):
    """Customers as sets of the brands they buy: sets that overlap in every degree."""
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("element"), F.regexp_extract("p_brand", "([0-9]+)", 1).cast("bigint").alias("brand"))
    x = customer_item_sets(spark, sf).join(brands, "element").where("brand IS NOT NULL")
    return M.set_elements(x.select("set_id", F.col("brand").alias("element")))


def _drawn_sql(key: str, rate: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 13))::BIGINT + 0.5) / {float(16**13)!r} < {rate}"


@query("lsh_observed_rate", f"""
WITH sets AS (SELECT DISTINCT o_custkey::BIGINT AS set_id, regexp_extract(p_brand, '([0-9]+)', 1)::BIGINT AS element
              FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
              WHERE o_custkey IS NOT NULL AND regexp_matches(p_brand, '[0-9]')),
{SIG_SQL},
sz AS (SELECT set_id, count(*) AS n FROM sets GROUP BY 1),
own AS (SELECT set_id FROM sz WHERE {_drawn_sql("'anchor:' || set_id", f"{float(ANCHORS)!r}::DOUBLE / (SELECT count(*) FROM sz)")}),
i AS (SELECT a.set_id AS x, b.set_id AS y, count(*) AS i FROM sets a JOIN own USING (set_id) JOIN sets b ON b.element = a.element AND b.set_id <> a.set_id GROUP BY 1, 2),
jp AS (SELECT DISTINCT least(x, y) AS set_a, greatest(x, y) AS set_b, i / (na.n + nb.n - i) AS jaccard
       FROM i JOIN sz na ON na.set_id = x JOIN sz nb ON nb.set_id = y),
bn AS (SELECT *, floor(jaccard * 10) / 10 AS jaccard_bin, count(*) OVER (PARTITION BY floor(jaccard * 10)) AS n_pairs FROM jp),
smp AS (SELECT * FROM bn WHERE {_drawn_sql("'pair:' || set_a || ':' || set_b", f"{float(PER_BIN)!r}::DOUBLE / n_pairs")}),
eq AS (SELECT s.*, x.k, x.h = y.h AS e FROM smp s JOIN sig x ON x.set_id = set_a JOIN sig y ON y.set_id = set_b AND y.k = x.k),
g(r, b) AS (VALUES {", ".join(f"({r}, {b})" for r, b in RATE_GRID)}),
band AS (SELECT r, b, set_a, set_b, jaccard, jaccard_bin, n_pairs, k // r AS band, bool_and(e) AS hit FROM eq, g WHERE k < r * b GROUP BY ALL),
hit AS (SELECT r, b, set_a, set_b, jaccard, jaccard_bin, n_pairs, bool_or(hit) AS hit FROM band GROUP BY ALL)
SELECT r, b, jaccard_bin, n_pairs, count(*) AS n_sample, round(avg(1.0 - pow(1.0 - pow(jaccard, r), b)), 6) AS expected_rate,
       round(avg(hit::INTEGER), 6) AS observed_rate
FROM hit GROUP BY 1, 2, 3, 4""")
def q_lsh_observed_rate(spark, sf):
    sets = reliable_checkpoint(brand_sets(spark, sf))
    pairs = reliable_checkpoint(L.sampled_pairs(sets, ANCHORS, PER_BIN))
    sig = M.signature_arrays(sets.join(M.named_sets(pairs), "set_id"), FAMILY)
    t = L.candidate_rates(pairs, sig, RATE_GRID)
    return t.select("r", "b", "jaccard_bin", "n_pairs", "n_sample", round6("expected_rate").alias("expected_rate"), round6("observed_rate").alias("observed_rate"))


@query("lsh_s_curve", f"""
WITH {JACCARD_SQL},
g(r, b) AS (VALUES {", ".join(f"({r}, {b})" for r, b in S_CURVE_GRID)})
SELECT r, b, floor(jaccard * 10) / 10 AS jaccard_bin, count(*) AS n_pairs,
       round(avg(1.0 - pow(1.0 - pow(jaccard, r), b)), 6) AS expected_rate
FROM jp, g GROUP BY 1, 2, 3""")
def q_lsh_s_curve(spark, sf):
    t = L.s_curve_table(M.jaccard_pairs(reliable_checkpoint(cust_sets(spark, sf))), S_CURVE_GRID)
    return t.select("r", "b", "jaccard_bin", "n_pairs", round6("expected_rate").alias("expected_rate"))


@query("lsh_band_hashes", f"WITH {DOC_SETS_SQL}, {BH_SQL} SELECT set_id, band, bucket FROM bh")
def q_lsh_band_hashes(spark, sf):
    return doc_band_hashes(spark, sf)


@query("lsh_buckets", f"WITH {DOC_SETS_SQL}, {BUCKETS_SQL} SELECT * FROM buckets")
def q_lsh_buckets(spark, sf):
    b = L.bucket_tables(doc_band_hashes(spark, sf))
    return b.select("band", "bucket", "chunk", "size", F.array_join("members", ",").alias("members"))


@query("lsh_collisions", f"WITH {DOC_SETS_SQL}, {BUCKETS_SQL} SELECT * FROM buckets WHERE size >= 2")
def q_lsh_collisions(spark, sf):
    b = L.collisions(doc_band_hashes(spark, sf))
    return b.select("band", "bucket", "chunk", "size", F.array_join("members", ",").alias("members"))


@query("lsh_candidates", f"""
WITH {DOC_SETS_SQL}, {BH_SQL}
SELECT DISTINCT a.set_id AS set_a, b.set_id AS set_b FROM bh a JOIN bh b USING (band, bucket) WHERE a.set_id < b.set_id""")
def q_lsh_candidates(spark, sf):
    return L.bucket_pairs(doc_signatures(spark, sf), BANDS, ROWS)


@query("signature_similarity", f"""
WITH {DOC_SETS_SQL}, {CAND_SQL}
SELECT set_a, set_b, round(avg(CASE WHEN x.h = y.h THEN 1.0 ELSE 0.0 END), 6) AS signature_similarity
FROM cand JOIN sig x ON x.set_id = set_a JOIN sig y ON y.set_id = set_b AND y.k = x.k GROUP BY 1, 2""")
def q_signature_similarity(spark, sf):
    sig = doc_signatures(spark, sf)
    cand = L.candidate_edges(L.band_hashes(sig, BANDS, ROWS))
    s = M.signature_agreement(sig, cand)
    return s.select("set_a", "set_b", round6("signature_similarity").alias("signature_similarity"))


PAIRS_SQL = f"""{BH_SQL},
rep AS (SELECT min(set_id) AS set_id FROM (SELECT set_id, list(element ORDER BY element) AS es FROM sets GROUP BY 1) GROUP BY es),
rb AS (SELECT bh.* FROM bh JOIN rep USING (set_id)),
pairs AS (SELECT DISTINCT a.set_id AS set_a, b.set_id AS set_b FROM rb a JOIN rb b USING (band, bucket) WHERE a.set_id < b.set_id)"""


@query("lsh_candidate_pairs", f"WITH {DOC_SETS_SQL}, {PAIRS_SQL} SELECT * FROM pairs")
def q_lsh_candidate_pairs(spark, sf):
    return L.candidate_pairs(doc_signatures(spark, sf), BANDS, ROWS)


@query("lsh_copies", f"""
WITH {DOC_SETS_SQL},
e AS (SELECT set_id, list(element ORDER BY element) AS es FROM sets GROUP BY 1)
SELECT set_id, min(set_id) OVER (PARTITION BY es) AS representative FROM e""")
def q_lsh_copies(spark, sf):
    return M.set_copies(doc_signatures(spark, sf))


@query("lsh_verify_all", f"""
WITH {DOC_SETS_SQL}, {PAIRS_SQL},
sz AS (SELECT set_id, count(*) AS n FROM sets GROUP BY 1),
inter AS (SELECT p.set_a, p.set_b, count(b.element) AS i
          FROM pairs p JOIN sets a ON a.set_id = p.set_a
          LEFT JOIN sets b ON b.set_id = p.set_b AND b.element = a.element GROUP BY 1, 2),
agree AS (SELECT p.set_a, p.set_b, avg(CASE WHEN x.h = y.h THEN 1.0 ELSE 0.0 END) AS ag
          FROM pairs p JOIN sig x ON x.set_id = p.set_a JOIN sig y ON y.set_id = p.set_b AND y.k = x.k GROUP BY 1, 2)
SELECT set_a, set_b, round(coalesce(i / nullif(na.n + nb.n - i, 0), 0), 6) AS jaccard, round(ag, 6) AS signature_similarity
FROM inter JOIN agree USING (set_a, set_b) JOIN sz na ON na.set_id = set_a JOIN sz nb ON nb.set_id = set_b""")
def q_lsh_verify_all(spark, sf):
    sig = doc_signatures(spark, sf)
    pairs = written(L.candidate_pairs(sig, BANDS, ROWS))
    # only documents that a pair names are shingled again, from the texts that travel to the blocks
    total = M.named_sets(pairs).join(sig.select("set_id", "n"), "set_id").agg(F.sum("n")).first()[0] or 0
    v = L.verify_arrays(pairs, doc_contents(table(spark, sf, "documents").select("doc_id", "text")), sig, total, elements=lambda texts: shingle_keys(texts, DOC_K))
    return v.select("set_a", "set_b", round6("jaccard").alias("jaccard"), round6("signature_similarity").alias("signature_similarity"))


LARGEST_SQL = f"""{BUCKETS_SQL},
grp AS (SELECT band, bucket, size, members FROM buckets WHERE size >= 2 AND size <= {MAX_GROUP}
        ORDER BY size DESC, band, bucket LIMIT 1)"""


@query("lsh_largest_group", f"WITH {DOC_SETS_SQL}, {LARGEST_SQL} SELECT * FROM grp")
def q_lsh_largest_group(spark, sf):
    g = L.largest_group(L.collisions(doc_band_hashes(spark, sf)), MAX_GROUP)
    return g.select("band", "bucket", "size", F.array_join("members", ",").alias("members"))


@query("lsh_verify", f"""
WITH {DOC_SETS_SQL}, {LARGEST_SQL},
m AS (SELECT bh.set_id FROM grp JOIN bh USING (band, bucket)),
pairs AS (SELECT a.set_id AS set_a, b.set_id AS set_b FROM m a JOIN m b ON a.set_id < b.set_id),
sz AS (SELECT set_id, count(*) AS n FROM sets GROUP BY 1),
inter AS (SELECT p.set_a, p.set_b, count(b.element) AS i
          FROM pairs p JOIN sets a ON a.set_id = p.set_a
          LEFT JOIN sets b ON b.set_id = p.set_b AND b.element = a.element GROUP BY 1, 2),
agree AS (SELECT p.set_a, p.set_b, avg(CASE WHEN x.h = y.h THEN 1.0 ELSE 0.0 END) AS ag
          FROM pairs p JOIN sig x ON x.set_id = p.set_a JOIN sig y ON y.set_id = p.set_b AND y.k = x.k GROUP BY 1, 2)
SELECT set_a, set_b, round(coalesce(i / nullif(na.n + nb.n - i, 0), 0), 6) AS jaccard,
       round(ag, 6) AS signature_similarity
FROM inter JOIN agree USING (set_a, set_b) JOIN sz na ON na.set_id = set_a JOIN sz nb ON nb.set_id = set_b""")
def q_lsh_verify(spark, sf):
    bh = doc_band_hashes(spark, sf)
    g = L.largest_group(L.collisions(bh), MAX_GROUP).select("band", "bucket")
    # at most MAX_GROUP rows: cut the lineage here so the checks below do not re-plan the whole LSH job
    members = reliable_checkpoint(bh.join(g, ["band", "bucket"]))
    member_docs = table(spark, sf, "documents").select("doc_id", "text").join(
        F.broadcast(members.select(F.col("set_id").alias("doc_id"))), "doc_id"
    )
    # a signature depends only on its own set: the members' signatures come from the members' documents
    sets = doc_sets(spark, sf, member_docs)
    v = L.verify_group(members, sets, M.signature_arrays(sets, FAMILY))
    return v.select("set_a", "set_b", round6("jaccard").alias("jaccard"), round6("signature_similarity").alias("signature_similarity"))
