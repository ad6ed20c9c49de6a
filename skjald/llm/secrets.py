"""Secret scans with multipart credential linking, in DataFrame functions only.

Base findings are assignments, access keys and long hexadecimal runs; they always
stay. Weak candidates are client identifiers, opaque secrets and endpoints: a part is
reported only if complementary parts stand in the same scope, a stretch of SCOPE
characters. Parts of a document are joined by intervals: each goes to the cells of
SCOPE characters that it may reach, cells are matched by equality, and the distance is
checked. An identifier (access key or client) links with a secret (assignment, hex or
opaque) and each makes the other one reported; an endpoint is reported if an identifier
or an assignment is near.

Offsets are code points, ends exclusive. A kind's matches are leftmost and do not
overlap. The pieces between matches, from split(), and the matches, from
regexp_extract_all(), give the offsets by a running sum within the row; the texts
themselves are read once and never shuffled.

Cases: a null text counts as empty; very long texts are scanned whole, and their parts
meet by cells, never all at once; of spans that start together the order is that of the
kinds; spans of different kinds may overlap; rows with equal id and text are scanned alike, once
for the links; null ids are joined as values; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skjald.llm.common import cut, text_or_empty, with_free_names

SCOPE = 200
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
#: kind, pattern, words of which a text must hold one (lower case), role. Order of the kinds is that of the result.
BASE = [
    ("assign", ASSIGN, ["password", "passwd", "secret", "token", "apikey", "api_key"], "secret"),
    ("access", r"AKIA[A-Z0-9]{14,}", ["akia"], "identifier"),  # 18 or more in all
    ("hex", r"[0-9a-f]{16,}", [], "secret"),
]
WEAK = [
    ("client", r"""(?i:client_?id|app_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}""", ["client", "app", "account", "user", "login"], "identifier"),
    ("opaque", r"(?<![A-Za-z0-9+/=])(?=[A-Za-z+/]{0,39}[0-9])(?=[a-z0-9+/]{0,39}[A-Z])[A-Za-z0-9+/]{40,}+", [], "secret"),
    ("endpoint", r"(?i:https?|ftp|jdbc:[a-z]+|mongodb|redis|amqps?)://[A-Za-z0-9._~:@-]{4,}", ["://"], "endpoint"),
]
KINDS = [kind for kind, *_ in BASE + WEAK]
PART = "array<struct<start:bigint,rank:int,stop:bigint>>"


def _spans(text: Column, low: Column, rank: int, pattern: str, words: list[str], least: int = 0) -> Column:
    """start, rank and stop of the pattern's matches; group 2 has `least` characters if that is given."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    good = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least else found
    steps = F.zip_with(F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(F.length(p).cast("long").alias("gap"), F.length(m).cast("long").alias("size"))), good, lambda x, g: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), (F.length(g) >= least).alias("good")))
    none = F.from_json(F.lit("[]"), PART)
    walk = F.aggregate(
        steps,
        F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")),
        lambda acc, x: F.struct((acc["at"] + x["gap"] + x["size"]).alias("at"), F.when(x["good"], F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), F.lit(rank).alias("rank"), (acc["at"] + x["gap"] + x["size"]).alias("stop"))))).otherwise(acc["out"]).alias("out")),
        lambda acc: acc["out"],
    )
    holds = F.lit(True)
    for k, word in enumerate(words):
        holds = F.contains(low, F.lit(word)) if not k else holds | F.contains(low, F.lit(word))
    return F.when(holds & text.rlike(pattern), walk).otherwise(none)


def find_parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the text) and parts: all base and weak spans, sorted by start and kind."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("low", F.lower("text"))
    text, low = F.col("text"), F.col("low")
    spans = [_spans(text, low, rank, pattern, words, ASSIGN_LEAST if kind == "assign" else 0) for rank, (kind, pattern, words, _) in enumerate(BASE + WEAK)]
    return rows.select("doc_id", F.xxhash64("text").alias("digest"), F.array_sort(F.concat(*spans)).alias("parts"))


def _role(rank: Column) -> Column:
    return F.element_at(F.array(*(F.lit(role) for *_, role in BASE + WEAK)), rank + 1)


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, digest, start, rank and stop of the weak parts that complementary parts confirm."""
    worth = parts.filter(F.exists("parts", lambda p: p["rank"] >= len(BASE)) & (F.size("parts") > 1))
    rows = worth.select("doc_id", "digest", F.explode("parts").alias("p")).select("doc_id", "digest", "p.*").distinct().withColumn("role", _role(F.col("rank")))
    weak = rows.filter(F.col("rank") >= len(BASE)).withColumn("cell", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("stop") + scope) / scope))))
    # A near partner covers one of the cells that the part reaches.
    other = rows.select("doc_id", "digest", F.col("start").alias("start2"), F.col("stop").alias("stop2"), F.col("rank").alias("rank2"), F.col("role").alias("role2"), F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("stop") - 1) / scope))).alias("cell"))
    same = F.col("w.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("w.digest") == F.col("o.digest")) & (F.col("w.cell") == F.col("o.cell"))
    near = (F.col("start2") - F.col("stop") <= scope) & (F.col("start") - F.col("stop2") <= scope) & ((F.col("start2") >= F.col("stop")) | (F.col("stop2") <= F.col("start")))
    pair = ((F.col("role") == "identifier") & (F.col("role2") == "secret")) | ((F.col("role") == "secret") & (F.col("role2") == "identifier")) | ((F.col("role") == "endpoint") & ((F.col("role2") == "identifier") | (F.col("rank2") == 0)))
    return weak.alias("w").join(other.alias("o"), same & near & pair).select("w.doc_id", "w.digest", "w.start", "w.rank", "w.stop").distinct()


def scan(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the text), base and spans (with what linking adds), each sorted arrays of start, rank and stop."""
    parts = cut(find_parts(docs, id_col, text_col))
    linked = link_parts(parts, scope).groupBy(F.col("doc_id").alias("id"), F.col("digest").alias("of")).agg(F.collect_list(F.struct("start", "rank", "stop")).alias("more"))
    base = F.filter("parts", lambda p: p["rank"] < len(BASE))
    rows = parts.join(linked, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    return rows.select("doc_id", "digest", base.alias("base"), F.array_sort(F.concat(base, F.coalesce("more", F.from_json(F.lit("[]"), PART)))).alias("spans"))


def shown(spans: str) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", F.element_at(names, p["rank"] + 1), p["start"].cast("string"), p["stop"].cast("string"))), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda p: p["rank"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with [KIND] in place of each span; of spans that overlap, the first one's kind stands for all."""
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    out = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, p: F.struct(
            F.greatest(acc["at"], p["stop"]).alias("at"),
            F.when(p["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (p["start"] - acc["at"]).cast("int")), F.element_at(names, p["rank"] + 1))).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, out).otherwise(text)


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of `docs` with their secrets redacted and `length_col`, if there is one, renewed."""
    return with_free_names(docs, lambda docs: _without_secrets(docs, id_col, text_col, length_col))


def _without_secrets(docs: DataFrame, id_col: str, text_col: str, length_col: str | None) -> DataFrame:
    found = scan(docs, SCOPE, id_col, text_col).filter(F.size("spans") > 0).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("spans").alias("__spans")).distinct()
    key = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_or_empty(text_col)) == F.col("__digest"))
    found = cut(found)
    many = found.agg(F.sum(F.size("__spans") + 2)).first()[0] or 0
    rows = docs.join(F.broadcast(found) if many <= BROADCAST_SPANS else found, key, "left")
    hit = F.col("__spans").isNotNull()
    rows = rows.withColumn("__redacted", F.when(hit, redacted(F.col(text_col), F.col("__spans"))).otherwise(F.col(text_col)))
    changed = {text_col: F.col("__redacted")}
    if length_col in docs.columns:
        changed[length_col] = F.when(hit, F.length("__redacted").cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return rows.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))


#: Spans, and as much for two of them for each document, up to which they are broadcast: some 10 MB.
BROADCAST_SPANS = 300_000
