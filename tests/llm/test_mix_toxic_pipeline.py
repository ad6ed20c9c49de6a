import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skjald.llm import mixing, queries, toxicity
from tests.llm.conftest import SF, sentence


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > most * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check_mix(rows, docs):
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    targets = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
    for s, target in targets.items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1e-6
    assert sorted(str(r.size) for r in rows) == sorted(str(words(t)) for t in docs)


def test_targets(spark):
    rng = random.Random(3)
    for n in (1, 2, 3, 7, 20):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 5000]) for i in range(n)} | {None: 7}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        wanted = brute_targets(sizes)
        for r in mixing.targets(rows).collect():
            assert r.target == pytest.approx(wanted[r.source])


def test_pivot_keeps_words_and_chances():
    rng = np.random.default_rng(5)
    size, part = rng.integers(1, 400, 30), rng.random(30)
    size[:3], part[:3] = 10, 0.5
    total = np.zeros(30)
    for _ in range(4000):
        out = mixing.pivot(size, part, rng)
        assert ((out > 0) & (out < 1)).sum() <= 1
        assert (out * size).sum() == pytest.approx((part * size).sum())
        total += out
    assert np.abs(total / 4000 - part).max() < 0.04


def test_mix_edges(spark, documents, empty, texts):
    first = mixing.mix_documents(documents)
    rows = first.collect()
    check_mix(rows, [r.text for r in documents.collect()])
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_documents(documents.repartition(7)).collect()))
    assert mixing.mix_documents(empty).count() == 0


def test_mix_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 10)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rng = random.Random(1)
    docs = [(i, "w " * rng.randrange(30), f"s{rng.choice([0, 0, 0, 1, 2])}") for i in range(400)]
    rows = mixing.mix_documents(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    check_mix(rows, [t for _, t, _ in docs])


def test_mix_query(spark):
    check_mix(queries.op1_mixing(spark, SF).collect(), [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])


def brute_ratio(counts, gram):
    """log P(toxic) / P(ordinary) of a gram's last character, from the definition."""
    d, order = toxicity.DISCOUNT, toxicity.ORDER

    def backoff(g):
        if not g:
            return 1 / toxicity.ALPHABET
        n = len(g)
        longer = {x[-n - 1 :] for x in counts}
        k = {}
        for x in longer:
            k[x[1:]] = k.get(x[1:], 0) + 1
        same = [v for x, v in k.items() if x[:-1] == g[:-1]]
        if not same:
            return backoff(g[1:])
        return max(k.get(g, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * backoff(g[1:])

    def p(y):
        after = {x: c[y] for x, c in counts.items() if x[:-1] == gram[:-1] and c[y]}
        total = sum(after.values())
        low = backoff(gram[1 - order :])
        return max(after.get(gram, 0) - d, 0) / total + d * len(after) / total * low if total else low

    return np.log(p(1) / p(0))


def test_log_ratios(spark):
    rng = random.Random(2)
    counts = {}
    for y, chosen in ((0, "abac"), (1, "abcx")):
        for _ in range(60):
            for gram in toxicity.grams_of("".join(rng.choice(chosen) for _ in range(rng.randrange(1, 6))).encode()):
                counts.setdefault(gram, [0, 0])[y] += 1
    rows = spark.createDataFrame([(g, *c) for g, c in counts.items()], "gram string, a long, b long")
    from pyspark.sql import functions as F

    found = {r.gram: r.ratio for r in toxicity.log_ratios(rows, {"ratio": (F.col("a"), F.col("b"))}).collect()}
    for gram in counts:
        assert found[gram] == pytest.approx(brute_ratio(counts, gram))
        assert found[gram[:-1]] == pytest.approx(brute_ratio(counts, gram[:-1] + "￿"), abs=1e-9)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(900):
        text = [f"{rng.choice(['ba', 'ko', 'ri', 'lu'])}{rng.choice(['na', 'te', 'mo'])}{rng.choice(['', 's', 'n'])}" for _ in range(rng.randrange(5, 80))]
        bad = rng.random() < 0.2
        for _ in range(max(1, len(text) // 12) if bad else 0):
            text[rng.randrange(len(text))] = "vex" + rng.choice(["um", "ig", "ta", "or"])
        docs.append((i, " ".join(text), str(int(bad)), "x"))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_held_out(spark, labelled):
    docs, labels = labelled
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.toxicity(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out]
    assert sum(t and p for t, p in held) >= 0.9 * sum(t for t, _ in held)
    assert sum(p and not t for t, p in held) <= 0.01 * len(held)
    # Labels of held-out rows, and columns other than the text, make no difference.
    other = labels.withColumn("toxic", (1 - labels.toxic).cast("int"))
    mixed = labels.filter("crc32(cast(doc_id as string)) % 3 != 1").union(other.filter("crc32(cast(doc_id as string)) % 3 = 1"))
    again = toxicity.toxicity(docs.drop("lang", "source"), mixed)
    assert {r.doc_id: round(r.score, 9) for r in again.collect()} == {r.doc_id: round(r.score, 9) for r in rows}


def test_few_rows_are_passed_on_by_few_tasks(spark, labelled):
    docs, labels = labelled
    want = {r.doc_id: round(r.score, 9) for r in toxicity.toxicity(docs, labels).collect()}
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("50", "false"), strict=True):
            spark.conf.set(k, v)
        ratios, _ = toxicity.learn(docs, labels)
        assert ratios.rdd.getNumPartitions() <= 2  # one was made of each partition of the grams, and of the contexts
        assert {r.doc_id: round(r.score, 9) for r in toxicity.toxicity(docs, labels).collect()} == want
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_toxicity_edges(spark, documents, empty, labelled):
    docs, labels = labelled
    model = toxicity.learn(docs, labels.union(labels).union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int")))
    rows = toxicity.score_documents(documents, model)
    assert rows.columns == [*documents.columns, "__score"] and rows.count() == documents.count()
    assert rows.filter("__score is null").count() == 0
    assert {r.score for r in toxicity.toxicity(documents, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(empty, labels).count() == 0
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and 0.7 * docs.count() < kept.count() < docs.count()


def test_toxicity_query(spark):
    rows = queries.op4_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)


def test_pipeline_stages(spark, documents, empty):
    """Each stage on odd documents: its columns, and that its decisions take effect."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash near-dedup", "secret scan", "source mix", "byte-level bpe"]
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == documents.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert stage(spark, empty, SF).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()


def test_pipeline_mix(spark, documents):
    mix = {}
    for r in mixing.mix_documents(documents).collect():
        mix[r.doc_id, r.source, r.size] = mix.get((r.doc_id, r.source, r.size), 0) + r.copies
    out = {}
    for r in corpus_pipeline.mix_sources(spark, documents, SF).collect():
        key = (r.doc_id, r.source, words(r.text))
        out[key] = out.get(key, 0) + 1
    assert out == {k: n for k, n in mix.items() if n}


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "ids", "n_tokens"} <= set(rows.columns)
    assert rows.count() > 0


def test_large_tables_of_ratios_give_the_same_scores(spark, monkeypatch):
    """What isn't sent to the tasks is joined: none of the table's rows is cut."""
    rng = random.Random(37)
    rows = [(i, None if i % 50 == 7 else " ".join([sentence(rng, 20), *(["grim vile"] if i % 3 == 0 else [])]) if i % 50 else "") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    few = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    monkeypatch.setattr(toxicity, "SENT_GRAMS", 200)
    many = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    assert len(many) == 300 and many == pytest.approx(few, abs=1e-9)


def test_stages_keep_columns_with_names_of_their_own(spark, documents):
    """Columns that begin as those used within come through every stage."""
    names = ["__text", "__model", "__digest", "__id", "__source", "__rank", "__copies", "__spans", "held__text"]
    docs = documents.select("*", *(F.concat_ws("-", F.lit(n), "doc_id").alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns, name
        rows = found.collect()
        assert rows and all(r[n] == n + ("" if r.doc_id is None else f"-{r.doc_id}") for r in rows for n in names), name
