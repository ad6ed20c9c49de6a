"""Queries of the corpus operators over whole tables, each named opN_<name>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skjald.llm import bpe, contamination, conversations, embeddings, huffman, licenses, media, minhash, mixing, passages, secrets, spelling, toxicity
from skjald.llm.common import shared_path, table


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_documents(table(spark, sf_dir, "documents"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    counts = [secrets.count_of("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secrets.shown("base"), 256).alias("base_sha256"), secrets.shown("spans").alias("spans"))


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = shared_path(spark, "huffman")
    huffman.write_files(table(spark, sf_dir, "documents"), files)
    return huffman.read_files(spark, files, with_ids=False)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    joined = [F.array_join("base", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.read_media(media.wav_column(table(spark, sf_dir, "documents")))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repaired(conversations.damaged(rows), rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_secrets": op2_secrets,
    "op3_passages": op3_passages,
    "op4_toxicity": op4_toxicity,
    "op5_huffman_ids": op5_huffman_ids,
    "op6_embeddings": op6_embeddings,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_minhash": op8_minhash,
    "op9_licenses": op9_licenses,
    "op10_media": op10_media,
    "op11_decontamination": op11_decontamination,
    "op12_spelling": op12_spelling,
    "op13_conversations": op13_conversations,
}
#: Smallest node that each one reaches by the links e (x, y), of the nodes that `nodes` selects.
REACHED = """r(node, label) AS (SELECT node, node FROM ({nodes}) UNION SELECT e.y, r.label FROM r JOIN e ON e.x = r.node WHERE r.label < e.y),
c AS (SELECT node, min(label) AS component_id FROM r GROUP BY 1)"""
#: The check of zlib over the bytes of `{text}`, which `b` lists.
CHECK = """k AS (SELECT list(c ORDER BY i) AS steps FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""
CHECKED = "xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode({text}))), lambda j: CAST(CAST('0x' || substr(hex(encode({text})), 2 * j + 1, 2) AS INT) AS BIGINT))), lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295)"
LOWERED = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES: dict[str, str] = {
    "op6_embeddings": f"""WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS x FROM embeddings),
g AS (SELECT * FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
n AS (SELECT x AS id, count(*) AS n_links FROM e GROUP BY 1), {REACHED.format(nodes="SELECT vec_id AS node FROM v")}
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON vec_id = node LEFT JOIN n ON vec_id = id""",
    "op8_minhash": f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS t FROM d),
s AS (SELECT DISTINCT doc_id, t FROM u), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * k >= 75 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l), {REACHED.format(nodes="SELECT doc_id AS node FROM documents")}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN c ON d.doc_id = node LEFT JOIN n USING (doc_id)""",
    "op11_decontamination": f"""WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED.format(text="coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({LOWERED.format(text="coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
t AS (SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda k: array_to_string(w[k:k + least(len(w), 10) - 1], ' '))) AS x FROM i WHERE len(w) > 0),
p AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS j, w FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n),
h AS (SELECT doc_id, j, p.n, item_id FROM p JOIN t ON p.n = t.n AND array_to_string(w[j:j + p.n - 1], ' ') = x),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + n)) AS k FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op12_spelling": f"""WITH RECURSIVE {CHECK},
o AS (SELECT doc_id, unnest(regexp_extract_all({LOWERED.format(text="coalesce(text, '')")}, '[A-Za-zÀ-ÿ]+')) AS x FROM documents),
g AS (SELECT doc_id, x, count(*) AS n FROM o WHERE length(x) >= 5 GROUP BY 1, 2), q AS (SELECT x, n, doc_id || ':' || x AS f FROM g), z AS (SELECT x, n, {CHECKED.format(text="f")} AS h FROM q, k),
v AS (SELECT CASE WHEN h % 97 = 0 THEN substr(x, 1, h % length(x)) || substr(x, h % length(x) + 2) ELSE x END AS word, n FROM z),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
l AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
e AS (SELECT a.word AS x, b.word AS y FROM l a JOIN l b ON a.i = b.i AND a.less = b.less AND a.word <> b.word UNION SELECT w.word, l.word FROM w JOIN l ON l.less = w.word UNION SELECT l.word, w.word FROM w JOIN l ON l.less = w.word),
s AS (SELECT x, count(*) AS n_near, min({{'less': -n, 'word': word}}) AS best FROM e JOIN w ON y = word GROUP BY 1),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 2 * n THEN best.word END AS form, CASE WHEN -best.less >= 2 * n THEN -best.less END AS form_n FROM w LEFT JOIN s ON word = x),
r(word, root) AS (SELECT word, word FROM f WHERE form IS NULL UNION ALL SELECT f.word, r.root FROM f JOIN r ON f.form = r.word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN r USING (word)""",
    "op13_conversations": f"""WITH RECURSIVE {CHECK},
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS f FROM conversations), h AS (SELECT *, {CHECKED.format(text="f")} % 20 AS h FROM c, k),
d AS (SELECT conv_id, turn, copy, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM h, range(2) r(copy) WHERE h > 0 AND (copy = 0 OR h = 3)),
o AS (SELECT *, row_number() OVER w AS i, lag(role[1]) OVER w AS before, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
t AS (SELECT *, last = '' OR again AS bad, last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS short FROM o),
m AS (SELECT *, CASE WHEN bad THEN 1000000 WHEN short THEN 3 ELSE 0 END AS stay, CASE WHEN role[1] = 's' THEN 0 ELSE 1000000 END AS ks, CASE WHEN role[1] = 'u' THEN 0 ELSE 1000000 END AS ku, CASE WHEN role[1] = 'a' THEN 0 ELSE 1000000 END AS ka FROM t),
p(conv_id, i, z, s, u, a) AS (
SELECT DISTINCT conv_id, CAST(0 AS BIGINT), {{'c': 0, 'e': '', 't': ''}}, {{'c': 1000000, 'e': '', 't': ''}}, {{'c': 3, 'e': 'I', 't': chr(10) || 'user:'}}, {{'c': 6, 'e': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} FROM t
UNION ALL SELECT conv_id, i, z, s, u, least(a, {{'c': u.c + 3, 'e': u.e || 'I', 't': u.t || chr(10) || 'assistant:'}}) FROM (
SELECT conv_id, i, z, s, least(u, {{'c': z.c + 3, 'e': z.e || 'I', 't': z.t || chr(10) || 'user:'}}, {{'c': s.c + 3, 'e': s.e || 'I', 't': s.t || chr(10) || 'user:'}}, {{'c': a.c + 3, 'e': a.e || 'I', 't': a.t || chr(10) || 'user:'}}) AS u, a FROM (
SELECT p.conv_id, m.i, {{'c': z.c + 4, 'e': z.e || 'D', 't': z.t}} AS z,
least({{'c': s.c + 4, 'e': s.e || 'D', 't': s.t}}, {{'c': z.c + stay + ks, 'e': z.e || 'K', 't': z.t || chr(10) || role || ':' || text}}) AS s,
least({{'c': u.c + 4, 'e': u.e || 'D', 't': u.t}}, {{'c': z.c + stay + ku, 'e': z.e || 'K', 't': z.t || chr(10) || role || ':' || text}}, {{'c': s.c + stay + ku, 'e': s.e || 'K', 't': s.t || chr(10) || role || ':' || text}}, {{'c': a.c + stay + ku, 'e': a.e || 'K', 't': a.t || chr(10) || role || ':' || text}},
{{'c': z.c + stay + 3, 'e': z.e || 'R', 't': z.t || chr(10) || 'user:' || text}}, {{'c': s.c + stay + 3, 'e': s.e || 'R', 't': s.t || chr(10) || 'user:' || text}}, {{'c': a.c + stay + 3, 'e': a.e || 'R', 't': a.t || chr(10) || 'user:' || text}}) AS u,
least({{'c': a.c + 4, 'e': a.e || 'D', 't': a.t}}, {{'c': u.c + stay + ka, 'e': u.e || 'K', 't': u.t || chr(10) || role || ':' || text}}, {{'c': u.c + stay + 3, 'e': u.e || 'R', 't': u.t || chr(10) || 'assistant:' || text}}) AS a
FROM p JOIN m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1))),
b AS (SELECT conv_id, arg_max(least(z, a), i) AS x FROM p GROUP BY 1),
q AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (last = '') AS blank, count(*) FILTER (last <> '' AND again) AS duplicate, count(*) FILTER (short) AS truncated, count(*) FILTER (before IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal FROM t GROUP BY 1)
SELECT n.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(x.c, 0) AS BIGINT) AS cost, coalesce(x.e, '') AS audit, sha256(coalesce(substr(x.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) n LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM n.conv_id""",
}
