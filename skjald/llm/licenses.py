"""License scans by ordered signature rules, in DataFrame functions only.

The base places are those of three phrases in a document's words. The rules are
regular expressions that run only on documents which hold their keyword: such a document
meets the rules of its keywords by a join with the rule table, whose size is fixed. A
match is suppressed if another one of an equal or better tier contains it, so that of
overlapping detections the most specific stays; one window over a document's matches in
the order of start finds that by running maxima of the ends, tier by tier.

Texts aren't shuffled; matches are, by document. Cases: a null text counts as empty;
very long texts are scanned whole, in one task each, and their matches are held in one
row; of matches that agree in place and tier the rule that stands first in the table stays; rows
with equal id and text are matched once; null ids are joined as values; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skjald.llm import license_rules
from skjald.llm.common import text_or_empty

#: Words of a text before A-Z are lower-cased: other characters than ASCII letters and digits part them.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def _phrases() -> str:
    """One pattern for all phrases; they end in a word with which none begins, and so never overlap."""
    return "(?i)(?<!" + WORD + ")(" + "|".join(phrase.replace(" ", GAP) for phrase in PHRASES) + ")(?!" + WORD + ")"


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD + "+")).cast("long")


def base_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, n_words, n_base, first_word, last_word, base (array of labels), and low: the
    lower-cased text if it holds an anchor of the rules."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("all_low", F.lower("text"))
    pattern = _phrases()
    text = F.col("text")
    found = F.when(F.contains("all_low", F.lit("license")), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("found", found).withColumn("n_words", _words(text))
    pieces, hit = F.split(text, pattern, -1), F.size("found") > 0
    rows = rows.withColumn("pieces", F.when(hit, pieces))
    labels = F.array_sort(F.array_distinct(F.transform("found", lambda m: F.element_at(F.create_map(*(F.lit(x) for pair in PHRASES.items() for x in pair)), F.regexp_replace(F.lower(m), "[^a-z]+", " ")))))
    anchored = reduce(or_, (F.contains("all_low", F.lit(x)) for x in license_rules.ANCHORS))
    return rows.select(
        "doc_id",
        F.xxhash64("text").alias("digest"),
        "n_words",
        F.size("found").cast("long").alias("n_base"),
        F.when(hit, _words(F.element_at("pieces", 1))).alias("first_word"),
        F.when(hit, F.col("n_words") - _words(F.element_at("pieces", -1)) - _words(F.element_at("found", -1))).alias("last_word"),
        labels.alias("base"),
        F.when(anchored, F.col("all_low")).alias("low"),
    )


def matches(texts: DataFrame) -> DataFrame:
    """doc_id, digest, rank, label, tier, start and stop of all rules' matches in texts (doc_id, digest, low)."""
    table = license_rules.rules()
    spark = texts.sparkSession
    rules = spark.createDataFrame(table, "rank int, label string, tier int, keyword string, pattern string")
    words = F.array(*(F.lit(x) for x in sorted({rule[3] for rule in table})))
    keyed = texts.withColumn("keyword", F.explode(F.filter(words, lambda w: F.contains(F.col("low"), w))))
    # A literal pattern, compiled once, says whether any of a keyword's many rules matches; only then is each tried.
    chain = F
    for keyword, pattern in license_rules.alternations().items():
        chain = chain.when(F.col("keyword") == keyword, F.regexp_like("low", F.lit(pattern)))
    keyed = keyed.filter(chain.otherwise(F.lit(True)))
    tried = keyed.join(F.broadcast(rules), "keyword").filter(F.regexp_like("low", F.col("pattern")))
    found, pieces = F.regexp_extract_all("low", F.col("pattern"), F.lit(0)), F.split("low", F.col("pattern"), -1)
    steps = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size")))
    spans = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x["gap"] + x["size"]).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("stop")))).alias("out")),
        lambda acc: acc["out"],
    )
    return tried.select("doc_id", "digest", "rank", "label", "tier", F.explode(spans).alias("s")).select("doc_id", "digest", "rank", "label", "tier", "s.start", "s.stop")


def unsuppressed(found: DataFrame) -> DataFrame:
    """The matches that none of an equal or better tier contains; of equal ones the first in rank stays."""
    order = Window.partitionBy("doc_id", "digest").orderBy("start", F.desc("stop"), "tier", "rank").rowsBetween(Window.unboundedPreceding, -1)
    tiers = sorted(license_rules.CONFIDENCE)
    reach = [F.when(F.col("tier") >= tier, F.max(F.when(F.col("tier") == tier, F.col("stop"))).over(order)) for tier in tiers]
    return found.withColumn("__reach", F.greatest(*reach)).filter(F.coalesce(F.col("__reach") < F.col("stop"), F.lit(True))).drop("__reach")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base places of every document with `labels` (array, of base and rules) and score, the confidence of its best match."""
    base = base_places(docs, id_col, text_col)
    texts = base.filter("low is not null").select("doc_id", "digest", "low").filter(F.col("low").isNotNull())
    found = unsuppressed(matches(texts).distinct())
    confidence = F.element_at(F.create_map(*(F.lit(x) for pair in license_rules.CONFIDENCE.items() for x in pair)), F.col("tier"))
    best = found.groupBy(F.col("doc_id").alias("id"), F.col("digest").alias("of")).agg(F.collect_set("label").alias("more"), F.max(confidence).alias("best"))
    rows = base.drop("low").join(best, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left").drop("id", "of")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(license_rules.CONFIDENCE[4])).otherwise(F.lit(0.0)))
    return rows.select("doc_id", "digest", "n_words", "n_base", "first_word", "last_word", "base", labels.alias("labels"), score.alias("score"))
