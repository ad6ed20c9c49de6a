import random
from collections import defaultdict

import numpy as np

from skjald.llm import embeddings, graph, minhash, queries
from tests.llm.conftest import SF, sentence


def components_of(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_minhash(texts):
    """n_shingles and component by inverted lists of shingles."""
    sets, holders, links = {i: shingles(t) for i, t in texts.items()}, defaultdict(list), []
    for i in sorted(sets):
        both = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                both[j] += 1
            holders[s].append(i)
        links += [(i, j) for j, n in both.items() if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n)]
    parts = components_of(sets, links)
    return {i: (len(s), parts[i], parts[i] == i) for i, s in sets.items()}


def test_components(spark):
    rng = random.Random(4)
    for n, m in ((40, 25), (60, 60), (30, 0)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        links += [(i, i + 1) for i in range(1000, 1030)]
        rows = spark.createDataFrame(links, "u long, v long")
        found = {r.node: r.component for r in graph.components(rows).collect()}
        assert found == {r.node: r.component for r in graph.components(rows.repartition(6), each=9).collect()}
        wanted = components_of({x for link in links for x in link}, links)
        assert found == {k: v for k, v in wanted.items() if k in found}
        assert all(v == k for k, v in wanted.items() if k not in found)


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.75, 0.95):
        errors = []
        for _ in range(40):
            marks = rng.integers(0, 2**63, 400, dtype=np.uint64)
            n = int(400 * share)
            a, b = marks[: n + (400 - n) // 2], np.concatenate([marks[:n], marks[n + (400 - n) // 2 :]])
            one, two = (minhash.signatures(np.sort(x), np.array([len(x)]))[0] for x in (a, b))
            errors.append((one == two).mean() - n / 400)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06
    # Sets smaller than the slots need several levels, and an element fills each slot once.
    small = minhash.signatures(np.array([5], np.uint64), np.array([1]))[0]
    assert sorted((small >> np.uint64(32)).tolist()) == list(range(minhash.SLOTS))
    assert minhash.signatures(np.zeros(0, np.uint64), np.array([0])).shape == (1, minhash.SLOTS)


def test_shingle_sets():
    rng = random.Random(8)
    texts = [None, "", " \t", "A b", "a  B", "a b c d e", "a b c d e a b c d e a b c d e", "x\x1cy z\xa0w"] + [sentence(rng, rng.randrange(60), 6) for _ in range(40)]
    marks, sizes = minhash.shingle_sets(texts)
    assert sizes.tolist() == [len(shingles(t)) for t in texts]
    cuts = np.split(marks, np.cumsum(sizes)[:-1])
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(cuts[i], cuts[j])) == len(shingles(texts[i]) & shingles(texts[j]))


def test_minhash_edges(spark, documents, empty, texts):
    rows = minhash.near_duplicates(documents).collect()
    assert len(rows) == documents.count()
    wanted = brute_minhash(dict(enumerate(texts)))
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == wanted[r.doc_id]
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.without_duplicates(documents)
    assert kept.columns == documents.columns
    # One row of each group; texts without words and rows without an id all stay.
    ids = sorted(((r.doc_id) for r in kept.collect()), key=lambda x: (x is not None, x))
    alone = [i for i, (_, _, k) in wanted.items() if k]
    assert ids == [None, None, *sorted([*alone, 1])]


def test_minhash_families(spark):
    """A chain and a cloud of copies, whose links the smallest member of a bucket doesn't show."""
    rng = random.Random(12)
    base, texts = sentence(rng, 120, 5000).split(), []
    words = list(base)
    for i in range(60):  # drifts away
        words[(7 * i) % 120] = f"d{i}"
        texts.append(" ".join(words))
    for i in range(60):  # each at some distance from the base
        far = list(base)
        for k in rng.sample(range(120), rng.randrange(1, 7)):
            far[k] = f"c{i}.{k}"
        texts.append(" ".join(far))
    rows = spark.createDataFrame([(i * 10, t) for i, t in enumerate(texts)], "doc_id long, text string")
    wanted = brute_minhash({i * 10: t for i, t in enumerate(texts)})
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(rows).collect()} == wanted


def test_minhash_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op8_minhash(spark, SF).collect()} == brute_minhash(texts)


def brute_vectors(vectors):
    """n_links and component by all cosines; vectors that can't link are None."""
    ids = [i for i, v in vectors if v is not None]
    x = np.array([v for _, v in vectors if v is not None], float).reshape(len(ids), -1)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    near = x @ x.T >= embeddings.COSINE
    links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True)]
    parts = components_of([i for i, _ in vectors], links)
    n = dict(zip(ids, near.sum(1) - 1, strict=True))
    return {i: (n.get(i, 0), parts[i], parts[i] == i) for i, _ in vectors}


def test_vectors(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 24))
    clean = [(i, (centres[i % 12] + rng.normal(size=24) * rng.choice([0.02, 0.1, 0.2])).tolist()) for i in range(300)]
    clean += [(300 + i, clean[5][1]) for i in range(40)] + [(400, [2 * v for v in clean[7][1]])]
    bad = [(500, None), (501, [0.0] * 24), (502, [None] + [1.0] * 23), (503, [float("nan")] * 24), (504, [float("inf")] + [1.0] * 23), (505, [])]
    rows = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in clean + bad], "vec_id long, embedding array<double>, label int, kind string, n_links string")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(rows).collect()}
    assert found == brute_vectors(clean + [(i, None) for i, _ in bad])
    assert embeddings.near_duplicates(rows.limit(0)).count() == 0


def test_vector_tiles(spark, monkeypatch):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.1).tolist()) for i in range(700)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(table).collect()} == brute_vectors(rows)


def test_recall():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(2, 3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = embeddings.COSINE * a + np.sqrt(1 - embeddings.COSINE**2) * b
    one, two = embeddings.buckets(a), embeddings.buckets(near)
    assert (one[:, :, :, None] == two[:, :, None, :]).any((1, 2, 3)).mean() > 0.99


def test_hadamard():
    x = np.random.default_rng(0).normal(size=(5, 8))
    assert np.allclose(embeddings.hadamard(embeddings.hadamard(x)) / 8, x)


def test_vector_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op6_embeddings(spark, SF).collect()} == brute_vectors(rows)
