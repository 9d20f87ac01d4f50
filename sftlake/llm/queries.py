"""The queries opN_<name>: each operator over its whole table, with production parameters, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftlake.llm import decontaminate, forest, language, lines, merkle, mixing, near, negatives, quality, repeats, token_counts, token_files, warc
from sftlake.llm.common import crc_remainder, stored, table, vocabulary
from sftlake.session import shared_dir

#: DuckDB patterns and functions that several queries use.
_SPACE = r"[\x20\x09-\x0D]"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary(), special_tokens=True)
    return token_files.read_token_digests(spark, path)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = token_counts.token_counts(docs, vocabulary(), fields=("source", "text"), rule="start", special_tokens=True)
    return counts.withColumn("n_tokens", F.col("n_tokens").cast("bigint"))


def op2_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    machine = quality.train(docs, table(spark, sf_dir, "labels"), usable=~held_out)
    return quality.score(docs, machine).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, plan = mixing.mix_counts(table(spark, sf_dir, "documents"))
    sized = spark.createDataFrame(
        [(s, plan["sizes"][s], float(plan["targets"][s])) for s in plan["sizes"]],
        "source string, source_size bigint, target double",
    )
    rows = rows.withColumn("source", F.col("_sources")[0])
    return rows.join(F.broadcast(sized), rows["source"].eqNullSafe(sized["source"]), "left").select(
        F.col("_doc").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", F.col("_taken").alias("taken"),
    )


OP4_SQL = rf"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS ord
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM rows GROUP BY source),
weighed AS (
  SELECT source, size, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS DOUBLE) AS w
  FROM sums),
ranked AS (
  SELECT *, CAST(3 * size AS DOUBLE) AS lim,
         row_number() OVER (ORDER BY 3 * size / w, source IS NULL, coalesce(source, '')) AS k
  FROM weighed),
running AS (
  SELECT *, sum(CAST(size AS DOUBLE)) OVER () - coalesce(sum(lim) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight
  FROM ranked),
level AS (SELECT k AS k0, rest / weight AS level FROM running WHERE rest * w <= lim * weight ORDER BY k LIMIT 1),
targets AS (
  SELECT r.*, CASE WHEN l.k0 IS NULL OR r.k < l.k0 THEN lim ELSE least(l.level * w, lim) END AS target
  FROM running r LEFT JOIN level l ON true),
whole AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS fl,
         row_number() OVER (ORDER BY floor(target) - target, source IS NULL, coalesce(source, '')) AS nth,
         least(sum(size) OVER (), CAST(round(sum(target) OVER ()) AS BIGINT)) - sum(CAST(floor(target) AS BIGINT)) OVER () AS short
  FROM targets),
quotas AS (SELECT source, size AS source_size, target, least(fl + CASE WHEN nth <= short THEN 1 ELSE 0 END, 3 * size) AS quota FROM whole),
need AS (
  SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS base,
         CASE WHEN source_size > 0 THEN quota % source_size ELSE 0 END AS rest
  FROM quotas),
summed AS (
  SELECT r.doc_id, r.size, n.source_size, n.target, n.base, n.rest, r.ord,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.ord RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n.rest AS over_by
  FROM rows r JOIN need n ON r.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (base + CASE WHEN rest > 0 AND (over_by <= 0 OR over_by < size AND abs(over_by) <= abs(over_by - size)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lost = lines.line_bitmaps_of_losers(docs, min_docs=10, min_chars=1, keep="none")
    same = docs["doc_id"].eqNullSafe(lost["doc"]) & (F.xxhash64(docs["text"]) == lost["text_hash"])
    digest = docs.join(lost, same, "left").select("doc_id", lines.applied_digest("text", "bitmap").alias("d"))
    return digest.select("doc_id", "d.*")


OP5_SQL = rf"""
WITH parts AS (
  SELECT row_number() OVER () AS r, doc_id, md5(text) AS t, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT r, doc_id, t, i, line, {_LOWER.format("regexp_replace(regexp_replace(line, '^" + _SPACE + "+', ''), '" + _SPACE + "+$', '')")} AS k
  FROM (SELECT r, doc_id, t, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS line FROM parts)),
gone AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT (doc_id, t)) >= 10)
SELECT any_value(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(g.k) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN g.k IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM lines LEFT JOIN gone g ON lines.k = g.k GROUP BY r
"""


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    model = language.train(docs, usable=~held_out)
    return language.identify(docs.drop("lang"), model, reject=False).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "rejected"
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("text", "item_ids", "spans")


OP7_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sn AS (SELECT s.doc_id, g, n FROM s JOIN n USING (doc_id)),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM sn a JOIN sn b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT ways.y, reach.root FROM reach JOIN ways ON ways.x = reach.node WHERE reach.root < ways.y)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.root AS component_id, d.doc_id = r.root AS kept
FROM documents d JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP8_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT DISTINCT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT r, i, dw.n, item_id FROM dw JOIN bw USING (win, n)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write_warc(warc.captures(table(spark, sf_dir, "pages")), path)
    # Headers and digests without blocks, kept: assembling looks at them several times, at the archives once.
    records = stored(warc.read_warc(spark, path, keep_blocks=False), "warc-records")
    found = warc.resolved(warc.assemble(records))
    page = lambda name: F.regexp_extract(name, r"^<urn:capture:(-?\d+):", 1)
    number = lambda text: F.when(text != "", text.cast("bigint"))
    return found.select(
        number(page("capture_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("response.record_type").alias("record_type"), number(page("response.refers_to")).alias("refers_to"),
        F.col("response.target_uri").alias("url"), F.col("request").isNotNull().alias("has_request"),
        F.col("metadata").isNotNull().alias("has_metadata"),
    )


_BASE32 = " || ".join(
    f"lpad(to_base(CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT), 32, 4), 4, '0')" for i in range(8)
)
OP9_SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top, count(*) OVER (PARTITION BY h) AS n FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       translate({_BASE32}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to,
       coalesce(url, 'urn:unknown') AS url, true AS has_request, true AS has_metadata
FROM m
"""

def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


OP11_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (
  SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 200)) AS k
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 99)) AS i FROM d)),
gone AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
marked AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS opens FROM gone),
numbered AS (SELECT doc_id, i, count_if(opens) OVER (PARTITION BY doc_id ORDER BY i) AS nth FROM marked),
spans AS (SELECT doc_id, nth, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, nth),
parts AS (
  SELECT d.doc_id, x, nth, a, b, substr(x, 2 * b + 1, 2 * (coalesce(lead(a) OVER (PARTITION BY d.doc_id ORDER BY nth), length(x) // 2) - b)) AS after
  FROM d JOIN spans USING (doc_id)),
cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
         substr(any_value(x), 1, 2 * min(a)) || string_agg(after, '' ORDER BY nth) AS kept
  FROM parts GROUP BY doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + F.lit(1)) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


OP12_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
  FROM scored WHERE label = anchor_label QUALIFY nth <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.label
 AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = [F.col(c).cast("bigint") + F.lit(1) if c == "n_chars" else F.col(c) for c in columns]
    chosen = F.col("doc_id").isNotNull() & (crc_remainder(F.col("doc_id"), 7) == 0)
    also = {"tampered": F.when(chosen, merkle.leaf_digest(changed))}
    found = merkle.manifest(table(spark, sf_dir, "documents"), columns, "lang", "doc_id", also=also)
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes (g, level, pos, h) of the trees over leaves (g, pos, h)."""
    return f"""{name} AS (
  SELECT g, 0 AS level, pos, h FROM {leaves}
  UNION ALL SELECT g, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}) WHERE n > 1 GROUP BY g, level, pos // 2)"""


_LEAF_FIELDS = [_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
_TAMPERED_FIELDS = [_field_sql("n_chars + 1") if i == 3 else f for i, f in enumerate(_LEAF_FIELDS)]
#: crc32 of a decimal number, bit by bit: each byte is followed by seven steps that add nothing.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT,
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384::UBIGINT * (xor(c, x) & 1))), 4294967295::UBIGINT)"""
OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({" || ".join(_LEAF_FIELDS)}) AS h,
         CASE WHEN {_CRC32} % 7 = 0 THEN sha256({" || ".join(_TAMPERED_FIELDS)}) END AS tampered
  FROM documents),
rows AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves),
{_tree_sql("tree", "rows")},
tops AS (SELECT g, arg_max(h, level) AS h, max(level) AS levels FROM tree GROUP BY g),
langs AS (SELECT '' AS g, g AS name, h, row_number() OVER (ORDER BY g) - 1 AS pos FROM tops),
{_tree_sql("upper", "langs")},
top AS (SELECT arg_max(h, level) AS root, max(level) AS levels FROM upper),
steps AS (
  SELECT r.g, r.pos AS leaf_pos, t.level AS ord, (r.pos >> l.level) % 2 AS odd, coalesce(t.h, '') AS h, l.level
  FROM rows r JOIN tops ON tops.g = r.g, LATERAL (SELECT unnest(range(tops.levels)) AS level) l
  LEFT JOIN tree t ON t.g = r.g AND t.level = l.level AND t.pos = xor(r.pos >> l.level, 1)),
upper_steps AS (
  SELECT n.name, (n.pos >> l.level) % 2 AS odd, coalesce(t.h, '') AS h, l.level
  FROM langs n, top, LATERAL (SELECT unnest(range(top.levels)) AS level) l
  LEFT JOIN upper t ON t.level = l.level AND t.pos = xor(n.pos >> l.level, 1)),
proofs AS (
  SELECT g, pos, list(odd || h ORDER BY part, level) FILTER (level IS NOT NULL) AS sides, string_agg(h, '' ORDER BY part, level) AS proof
  FROM (
    SELECT r.g, r.pos, 0 AS part, s.level, s.odd, s.h FROM rows r LEFT JOIN steps s ON s.g = r.g AND s.leaf_pos = r.pos
    UNION ALL SELECT r.g, r.pos, 1, u.level, u.odd, u.h FROM rows r LEFT JOIN upper_steps u ON u.name = r.g)
  GROUP BY g, pos),
folded AS (
  SELECT r.doc_id, r.h AS leaf, tops.h AS subroot, top.root, sha256(coalesce(p.proof, '')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(r.tampered, r.h), coalesce(p.sides, [])),
                     lambda h, s: sha256(CASE WHEN s[1] = '1' THEN s[2:] || h ELSE h || s[2:] END)) AS folded_root
  FROM rows r JOIN proofs p USING (g, pos) JOIN tops ON tops.g = r.g, top)
SELECT *, folded_root = root AS verified FROM folded
"""

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_forest": op2_forest,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_language": op6_language,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_decontaminate": op8_decontaminate,
    "op9_warc": op9_warc,
    "op10_token_counts": op10_token_counts,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE = {
    "op4_mixing": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op7_near_duplicates": OP7_SQL,
    "op8_decontaminate": OP8_SQL,
    "op9_warc": OP9_SQL,
    "op11_suffix_dedup": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
