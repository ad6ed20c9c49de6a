"""Toxicity by class-conditional Kneser-Ney models of the characters of words.

For each class, toxic and ordinary, a model of order ORDER gives the probability of a
word's next character after the ORDER - 1 before it. Its absolute discounts go to
backoff probabilities that both classes share, which are Kneser-Ney continuation counts
over the words of both, so that what is rare in either class tells little. A word's log
ratio is the sum over its characters; a document is described by its mean over the
words (the length-normalised comparison of the two log-likelihoods), by the excess of
its distinct words above STRONG, MOST of each at most, and by how many distinct words it
has, as long texts have some strong ones by chance. A logistic function of these, fitted
out of fold, is the score.

Counts are of documents that hold a word, of all labelled rows that may be learned
from; the table of log ratios is whole, grows with the input, and stays in the shared
folder. Tasks get its most frequent grams, SENT_GRAMS of them at most, in one string. A
word whose grams are all among these is scored where it is read; one that holds another
gram is joined with the whole table by shuffles, once for each distinct word, and its
value is added to the documents that hold it. The scores don't depend on SENT_GRAMS.
The calibration reads some CALIBRATION_ROWS labelled documents, chosen by a hash of their
ids, and never more rows of features than that.

Cases: null texts count as empty and have the score of no evidence; very long texts are
read whole, as counts of their words; rows with null labels aren't learned from, and of
repeated labels the largest counts; without toxic and ordinary rows to learn from the
score is 0.5; null and repeated ids are scored like any other row, and rows of equal text
have equal scores; a score that equals the threshold is toxic; an empty table gives an
empty result; other columns are kept or ignored, whatever their names are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skjald.llm.common import cut, pieces, small, with_free_names

ORDER = 5
DISCOUNT = 0.75
#: Characters that a writing has at least, for the last backoff.
ALPHABET = 200
#: Log ratio from which a distinct word is evidence of its own, and the most that one counts beyond it.
STRONG, MOST = 2.5, 4.0
TOXIC = 0.7
#: Grams that are sent to the tasks: below about 20 MB for each worker and model.
SENT_GRAMS = 100_000
CALIBRATION_ROWS = 30_000
#: Words that a worker remembers or counts at a time.
MEMO_WORDS = 50_000
#: Rows of labels up to which they are broadcast: some 5 MB.
LABEL_ROWS = 300_000
#: Texts whose open words one task passes on.
PIECE_TEXTS = 5_000
#: Letters, digits and all bytes of other characters stay; A-Z become small.
PLAIN = bytes((b | 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(PLAIN).split() if text else []


def remainder(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def grams_of(word: bytes, order: int = ORDER) -> list[str]:
    """The word's n-grams of full order: a start and an end mark stand around it."""
    s = "\x02" * (order - 1) + word.decode() + "\x03"
    return [s[i : i + order] for i in range(len(s) - order + 1)]


def count_grams(labelled: DataFrame) -> DataFrame:
    """gram and, by fold and class, the words of documents that hold it: n00, n01, n10, n11.

    `labelled` has text, fold (0 or 1) and toxic (0 or 1)."""

    def flush(held: list[Counter]) -> pa.RecordBatch:
        grams: dict[str, list[int]] = {}
        for k, words in enumerate(held):
            for word, n in words.items():
                for gram in grams_of(word):
                    grams.setdefault(gram, [0, 0, 0, 0])[k] += n
            words.clear()
        columns = list(zip(*grams.values(), strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), *(pa.array(x, pa.int64()) for x in columns)], ["gram", "n00", "n01", "n10", "n11"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counter() for _ in range(4)]
        for batch in batches:
            for text, fold, toxic in zip(*batch.to_pydict().values(), strict=True):
                held[2 * fold + toxic].update(set(words_of(text)))
                if sum(map(len, held)) > MEMO_WORDS:
                    yield flush(held)
        yield flush(held)

    found = labelled.select("text", "fold", "toxic").mapInArrow(run, "gram string, n00 long, n01 long, n10 long, n11 long")
    return found.groupBy("gram").agg(*(F.sum(x).alias(x) for x in ("n00", "n01", "n10", "n11")))


def log_ratios(grams: DataFrame, models: dict[str, tuple[Column, Column]]) -> DataFrame:
    """gram, n and a column for each of the models, given by its ordinary and toxic counts: for each
    gram the log P(toxic) / P(ordinary) of its last character, and for each context that of a
    character that isn't seen after it. The backoff, which knows no classes, is one for all models.
    `grams` is read more than once: cut its lineage before."""
    names, n_pieces = list(models), pieces(grams.count())
    seen = grams.coalesce(n_pieces).select("gram", *(c.alias(f"{m}_{y}") for m, both in models.items() for y, c in enumerate(both)))
    tail = lambda n: F.expr(f"right(gram, {n})")
    head = lambda n: F.expr(f"left(gram, {n})")
    backoff = None
    for n in range(1, ORDER):
        # Continuation counts: the distinct grams, longer by one, that end in these n characters.
        longer = seen.select(tail(n + 1).alias("long"))
        longer = longer.distinct().coalesce(n_pieces) if n + 1 < ORDER else longer  # whole grams are distinct
        counts = longer.select(F.expr(f"right(long, {n})").alias("gram")).groupBy("gram").agg(F.count("*").alias("k")).coalesce(n_pieces)
        sums = counts.groupBy(head(n - 1).alias("context")).agg(F.sum("k").alias("total"), F.count("*").alias("kinds"))
        level = counts.withColumn("context", head(n - 1)).join(sums, "context")
        if backoff is None:
            lower = F.lit(1.0 / ALPHABET)
        else:
            level, lower = level.coalesce(n_pieces).withColumn("next", tail(n - 1)).join(backoff, "next"), F.col("p")
        p = F.greatest(F.col("k") - DISCOUNT, F.lit(0.0)) / F.col("total") + DISCOUNT * F.col("kinds") / F.col("total") * lower
        backoff = level.select(F.col("gram").alias("next"), p.alias("p")).coalesce(n_pieces)
    each = [f"{m}_{y}" for m in names for y in (0, 1)]
    total = sum((F.col(c) for c in each), F.lit(0))
    sums = [F.sum(c).alias(f"x_{c}") for c in each] + [F.sum((F.col(c) > 0).cast("long")).alias(f"t_{c}") for c in each]
    contexts = seen.groupBy(head(ORDER - 1).alias("context")).agg(*sums, F.sum(total).alias("n"))
    left_over = lambda c: F.when(F.col(f"x_{c}") > 0, DISCOUNT * F.col(f"t_{c}") / F.col(f"x_{c}")).otherwise(1.0)
    rows = seen.withColumn("context", head(ORDER - 1)).withColumn("next", tail(ORDER - 1)).join(contexts.drop("n"), "context").coalesce(n_pieces).join(backoff, "next")
    share = lambda c: F.when(F.col(f"x_{c}") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"x_{c}")).otherwise(0.0) + left_over(c) * F.col("p")
    of_grams = rows.select("gram", total.alias("n"), *(F.log(share(f"{m}_1") / share(f"{m}_0")).alias(m) for m in names))
    return of_grams.union(contexts.select("context", "n", *(F.log(left_over(f"{m}_1") / left_over(f"{m}_0")) for m in names))).coalesce(n_pieces)


class Scorer:
    """What a document's words come to by the grams that were sent.

    A table that is `whole` has all that the model knows; else a gram that it lacks may be
    one of the others, and the word is left open."""

    def __init__(self, grams: list[str], ratios: list[float], whole: bool):
        self.ratios, self.whole = dict(zip(grams, ratios, strict=True)), whole
        self.memo: dict[bytes, float | tuple[float, list[str]]] = {}

    def word(self, word: bytes) -> float | tuple[float, list[str]]:
        """The word's log ratio; if it is left open, that of its known grams, and the others."""
        found = self.memo.get(word)
        if found is None:
            get, known, others = self.ratios.get, 0.0, []
            for gram in grams_of(word):
                ratio = get(gram)
                if ratio is None:
                    if self.whole:
                        ratio = get(gram[:-1], 0.0)
                    else:
                        others.append(gram)
                        continue
                known += ratio
            found = (known, others) if others else known
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = found
        return found

    def sums(self, text: str | None) -> tuple[int, int, float, float, list[dict]]:
        """Numbers of words and of distinct ones, sum of their log ratios, excess of the strong ones, and the words left open."""
        counts = Counter(words_of(text))
        total = excess = 0.0
        left = []
        for word, n in counts.items():
            value = self.word(word)
            if type(value) is tuple:
                left.append({"word": word.decode(), "n": n, "part": value[0], "grams": value[1]})
            else:
                total += n * value
                if value > STRONG:
                    excess += min(value - STRONG, MOST)
        return sum(counts.values()), len(counts), total, excess, left


def sent_grams(ratios: DataFrame, models: list[str]) -> tuple[str, list[np.ndarray], bool]:
    """The most frequent grams, SENT_GRAMS at most, joined by blanks, their ratios by each model, and whether these are all."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = {r.level: r.rows for r in ratios.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect()}  # a row for each power of two
    held, lowest = 0, max(sizes, default=0) + 1
    for x in sorted(sizes, reverse=True):
        if held + sizes[x] > SENT_GRAMS:
            break
        held, lowest = held + sizes[x], x
    rows = ratios.filter(level >= lowest).select("gram", *models).toArrow()
    return " ".join(rows["gram"].to_pylist()), [rows[m].to_numpy() for m in models], held == sum(sizes.values())


def _features(docs: DataFrame, ratios: DataFrame, models: list[str], carried: list[str]) -> DataFrame:
    """`carried` columns with x1 (mean log ratio of the words), x2 (logarithm of the excess of the strong ones) and x3 (that of the number of distinct words).

    Column `__model` of `docs` is the place in `models` of the model that a row is scored by, and `__text` its text."""
    grams, tables, whole = sent_grams(ratios, models)
    sent = docs.sparkSession.sparkContext.broadcast((grams, tables))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
        grams, tables = sent.value
        names = grams.split(" ") if grams else []
        scorers = [Scorer(names, x.tolist(), whole) for x in tables]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield part, [scorers[k].sums(text) for k, text in zip(part.column("__model").to_pylist(), part.column("__text").to_pylist(), strict=True)]

    def run_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in scored(batches):
            x = [(total / n if n else 0.0, math.log1p(excess), math.log1p(distinct)) for n, distinct, total, excess, _ in found]
            columns = zip(*x, strict=True) if x else ((),) * 3
            yield pa.RecordBatch.from_arrays([*map(part.column, carried), *(pa.array(c, pa.float64()) for c in columns)], [*carried, "__x1", "__x2", "__x3"])

    if whole:
        kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*carried).schema)
        return docs.select(*carried, "__model", "__text").mapInArrow(run_whole, f"{kinds}`__x1` double, `__x2` double, `__x3` double")

    left_type = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64()), ("part", pa.float64()), ("grams", pa.list_(pa.string()))]))

    def run_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in scored(batches):
            n, distinct, total, excess, left = zip(*found, strict=True) if found else ((),) * 5
            columns = [pa.array(n, pa.int64()), pa.array(distinct, pa.int64()), pa.array(total, pa.float64()), pa.array(excess, pa.float64()), pa.array(left, left_type)]
            yield pa.RecordBatch.from_arrays([part.column("__key"), part.column("__model"), *columns], ["__key", "__model", "words", "kinds", "total", "excess", "left"])

    # Equal texts are scored alike, so that a text's digest is key enough, however rows are dealt.
    keyed = docs.select(*carried, "__model", "__text", F.md5(F.coalesce("__text", F.lit(""))).alias("__key"))
    key = ["__key", "__model"]
    sums = keyed.select(*key, "__text").mapInArrow(run_open, "`__key` string, `__model` int, words long, kinds long, total double, excess double, `left` array<struct<word: string, n: long, part: double, grams: array<string>>>")
    sums = cut(sums.dropDuplicates(key))
    n_pieces = pieces(sums.count(), PIECE_TEXTS)
    sums = sums.coalesce(n_pieces)
    held = sums.select(*key, F.explode("left").alias("w")).select(*key, "w.*")
    values = open_values(held.select("__model", "word", "part", "grams").dropDuplicates(["__model", "word"]), ratios, models, n_pieces)
    more = held.select(*key, "word", "n").join(values, ["__model", "word"]).coalesce(n_pieces).groupBy(*key).agg(F.sum(F.col("n") * F.col("value")).alias("more"), F.sum(F.least(F.greatest(F.col("value") - STRONG, F.lit(0.0)), F.lit(MOST))).alias("above"))
    or_none = lambda c: F.coalesce(c, F.lit(0.0))
    x1 = F.when(F.col("words") > 0, (F.col("total") + or_none("more")) / F.col("words")).otherwise(0.0)
    found = sums.join(more, key, "left").select(*key, x1.alias("__x1"), F.log1p(F.col("excess") + or_none("above")).alias("__x2"), F.log1p("kinds").alias("__x3"))
    return keyed.drop("__text").join(found, key).select(*carried, "__x1", "__x2", "__x3")


def open_values(words: DataFrame, ratios: DataFrame, models: list[str], n_pieces: int) -> DataFrame:
    """__model, word and value of distinct words (__model, word, part, grams), from the whole table of ratios by shuffles."""
    grams = words.coalesce(n_pieces).select("__model", "word", F.explode("grams").alias("gram"))
    known = grams.select("gram").distinct().withColumn("context", F.expr(f"left(gram, {ORDER - 1})"))
    by_model = F.array(*models)
    known = known.join(ratios.select("gram", by_model.alias("own")), "gram", "left").coalesce(n_pieces).join(ratios.select(F.col("gram").alias("context"), by_model.alias("other")), "context", "left")
    known = known.select("gram", F.coalesce("own", "other").alias("by_model")).coalesce(n_pieces)
    rest = grams.join(known, "gram").coalesce(n_pieces).groupBy("__model", "word").agg(F.sum(F.coalesce(F.get("by_model", F.col("__model")), F.lit(0.0))).alias("rest"))
    return words.select("__model", "word", "part").join(rest, ["__model", "word"]).select("__model", "word", (F.col("part") + F.col("rest")).alias("value"))


def terms(x1, x2, x3) -> list:
    """What the logistic function weighs, of numbers, arrays or columns."""
    return [x1, x2, x3, x2 * x2, x2 * x3, x3 * x3]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic function by Newton's method; the last is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * len(x), x.T @ (y - p) - penalty @ w * len(x))
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[DataFrame, np.ndarray] | None:
    """The table of log ratios, whose model of all rows is `every`, and the logistic weights, from rows whose remainder is not 1."""
    known = labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("toxic")).filter("id is not null and toxic is not null")
    known = known.filter(remainder(F.col("id")) != 1).groupBy("id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fold = (remainder(F.col("id")) / 2).cast("int")
    grams = cut(count_grams(texts.join(small(known, LABEL_ROWS), "id").withColumn("fold", fold)))
    n = {c: F.col(c) for c in ("n00", "n01", "n10", "n11")}
    if not all(grams.agg(*map(F.sum, n.values())).first()):
        return None
    # Each fold's documents are calibrated by the model of the other fold.
    ratios = cut(log_ratios(grams, {"of_0": (n["n10"], n["n11"]), "of_1": (n["n00"], n["n01"]), "every": (n["n00"] + n["n10"], n["n01"] + n["n11"])}))
    order = F.xxhash64(F.lit(4), "id")
    chosen = known.filter(F.pmod(order, F.lit(max(1, -(-known.count() // CALIBRATION_ROWS)))) == 0)
    sample = texts.join(small(chosen, LABEL_ROWS), "id").select("toxic", order.alias("order"), fold.alias("__model"), F.col("text").alias("__text"))
    rows = _features(sample, ratios, ["of_0", "of_1"], ["toxic", "order"]).orderBy("order", "__x1", "__x2", "__x3", "toxic").limit(CALIBRATION_ROWS).toArrow()
    toxic = rows["toxic"].to_numpy().astype(float)
    if len(set(toxic.tolist())) < 2:
        return None
    return ratios, fit_logistic(np.column_stack(terms(*(rows[f"__x{k}"].to_numpy() for k in (1, 2, 3)))), toxic)


def score_documents(docs: DataFrame, model: tuple[DataFrame, np.ndarray] | None, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with their score in the column `__score`."""
    if model is None:
        return docs.withColumn("__score", F.lit(0.5))
    ratios, weights = model
    found = _features(docs.withColumn("__model", F.lit(0)).withColumn("__text", F.col(text_col)), ratios, ["every"], docs.columns)
    *each, constant = map(float, weights)
    total = sum((w * x for w, x in zip(each, terms(*map(F.col, ("__x1", "__x2", "__x3"))), strict=True)), F.lit(constant))
    return found.select(*docs.columns, (1 / (1 + F.exp(-total))).alias("__score"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = score_documents(rows, learn(docs, labels, id_col, text_col, label_col))
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= TOXIC).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The rows of `docs` whose score is below TOXIC.

    Texts are scored by themselves, and the digests of those that go are sent back to the rows."""
    return with_free_names(docs, lambda docs: _without_toxic(docs, labels, id_col, text_col, label_col))


def _without_toxic(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    scored = score_documents(docs.select(F.md5(F.coalesce(text_col, F.lit(""))).alias("__digest"), F.col(text_col).alias("text")), learn(docs, labels, id_col, text_col, label_col))
    gone = cut(scored.filter(F.col("__score") >= TOXIC).select("__digest").distinct())
    rows = docs.withColumn("__digest", F.md5(F.coalesce(text_col, F.lit(""))))
    return rows.join(small(gone, LABEL_ROWS), "__digest", "left_anti").select(*docs.columns)
