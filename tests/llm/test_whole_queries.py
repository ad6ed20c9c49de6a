"""Queries over whole tables against plain versions of their rules."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from skjald.llm import bpe, license_rules, media, mixing, passages, queries, secrets, toxicity
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def uncovered(texts, rows, size=50):
    """Places whose `size` words stand in another text too, and that no passage of their text covers."""
    words = {i: t.encode().lower().split() for i, t in texts.items()}
    held = {}
    for i, w in words.items():
        for k in range(len(w) - size + 1):
            held.setdefault(tuple(w[k : k + size]), set()).add(i)
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    places = [(i, k) for i, w in words.items() for k in range(len(w) - size + 1) if len(held[tuple(w[k : k + size])]) > 1]
    assert places
    return [(i, k) for i, k in places if not set(range(k, k + size)) <= found.get(i, set())]


def test_passages_query(spark, docs):
    rows = queries.op3_passages(spark, SF).collect()
    assert not uncovered(docs, rows)
    words = {i: t.encode().lower().split() for i, t in docs.items()}
    for r in rows:  # and what is reported is similar
        x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (words[r.doc_id][r.start_word : r.end_word], words[r.first_doc_id][r.first_start : r.first_end]))
        assert len(x & y) >= passages.SIMILAR * len(x | y)


def test_planted_passages_are_found(spark):
    rng = np.random.default_rng(41)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 50_000, n)]
    rows, pairs = [], []
    for k in range(150):
        base = words(int(rng.integers(60, 140)))
        near = base.copy()
        while True:  # words change as long as the similarity allows
            tried = near.copy()
            tried[int(rng.integers(len(tried)))] = f"n{rng.integers(1 << 30)}"
            x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (base, tried))
            if len(x & y) < 0.76 * len(x | y) or (k % 3 == 0 and tried != base and near != base):
                break
            near = tried
        pairs.append((len(rows), len(rows) + 1))
        rows += [" ".join(words(int(rng.integers(1, 200))) + x + words(int(rng.integers(1, 200)))) for x in (base, near)]
    rows.append(" ".join(words(200_000)))  # a very long text of its own
    found = passages.repeated_passages(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    linked = {frozenset((r.doc_id, r.first_doc_id)) for r in found if r.doc_id != r.first_doc_id}
    assert sum(frozenset(p) in linked for p in pairs) >= 149 and all(p in map(frozenset, pairs) for p in linked)


def test_toxicity_query_is_the_plain_computation(spark, docs):
    labels = {}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        labels[r.doc_id] = max(labels.get(r.doc_id, 0), r.toxic)
    rest = {i: zlib.crc32(str(i).encode()) % 3 for i in docs}
    train = [i for i in labels if i in docs and rest[i] != 1]
    d, order = toxicity.DISCOUNT, toxicity.ORDER
    counts = {}
    for i in train:
        for word in set(toxicity.words_of(docs[i])):
            for gram in toxicity.grams_of(word):
                counts.setdefault(gram, [0, 0, 0, 0])[2 * (rest[i] // 2) + labels[i]] += 1
    low = None
    for n in range(1, order):
        ends = Counter(x[1:] for x in {g[-n - 1 :] for g in counts})
        total, kinds = Counter(), Counter()
        for g, k in ends.items():
            total[g[:-1]] += k
            kinds[g[:-1]] += 1
        low = {g: max(k - d, 0) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * (1 / toxicity.ALPHABET if low is None else low[g[1:]]) for g, k in ends.items()}
    after = {}
    for g, c in counts.items():
        after.setdefault(g[:-1], {})[g] = c

    def ratio(gram, classes):
        seen = after.get(gram[:-1])
        if seen is None:
            return 0.0
        p = []
        for y in (0, 1):
            total = sum(c[k + y] for c in seen.values() for k in classes)
            kinds = sum(any(c[k + y] for k in classes) for c in seen.values())
            n = sum(seen.get(gram, [0] * 4)[k + y] for k in classes)
            back = d * kinds / total if total else 1.0
            p.append((max(n - d, 0) / total if total else 0.0) + back * low[gram[1:]] if gram in seen else back)
        return math.log(p[1] / p[0])

    def features(text, classes):
        words = Counter(toxicity.words_of(text))
        values = {w: sum(ratio(g, classes) for g in toxicity.grams_of(w)) for w in words}
        mean = sum(n * values[w] for w, n in words.items()) / max(1, sum(words.values()))
        return toxicity.terms(mean, math.log1p(sum(min(max(v - toxicity.STRONG, 0), toxicity.MOST) for v in values.values())), math.log1p(len(words)))

    w = toxicity.fit_logistic(np.array([features(docs[i], [2] if rest[i] == 0 else [0]) for i in train]), np.array([float(labels[i]) for i in train]))
    rows = queries.op4_toxicity(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        score = 1 / (1 + math.exp(-(np.dot(w[:-1], features(docs[r.doc_id], [0, 2])) + w[-1])))
        assert r.score == pytest.approx(score, abs=1e-6)
        assert r.held_out == (rest[r.doc_id] == 1) and r.predicted == int(r.score >= 0.7)


def test_secrets_query(spark, docs):
    patterns = [(k, re.compile(p), role) for k, p, _, role in secrets.BASE + secrets.WEAK]
    for r in queries.op2_secrets(spark, SF).collect():
        text, parts = docs[r.doc_id], []
        for rank, (kind, pattern, role) in enumerate(patterns):
            parts += [(m.start(), rank, m.end(), role) for m in pattern.finditer(text) if kind != "assign" or len(m[2]) >= 12]
        kept = []
        for a, rank, b, role in parts:
            near = [(x, role2) for c, x, d, role2 in parts if c - b <= secrets.SCOPE and a - d <= secrets.SCOPE and (c >= b or d <= a)]
            wanted = {"identifier": ["secret"], "secret": ["identifier"]}.get(role)
            if rank < 3 or any(role2 in wanted if wanted else role2 == "identifier" or x == 0 for x, role2 in near):
                kept.append((a, rank, b))
        shown = lambda spans: ",".join(f"{patterns[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
        base = [s for s in kept if s[1] < 3]
        assert r.spans == shown(kept)
        assert r.base_sha256 == hashlib.sha256(shown(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in base) for k in range(3)]


def test_licenses_query(spark, docs):
    rules = [(rank, label, tier, keyword, re.compile(pattern)) for rank, label, tier, keyword, pattern in license_rules.rules()]
    assert len(license_rules.NOTICES) > 200 and len(rules) == len({x[0] for x in rules})
    some = 0
    for r in queries.op9_licenses(spark, SF).collect():
        low, found = docs[r.doc_id].lower(), set()
        if any(x in low for x in license_rules.ANCHORS):
            for rank, label, tier, keyword, pattern in rules:
                if keyword in low:
                    found |= {(m.start(), -m.end(), tier, rank, label) for m in pattern.finditer(low)}
        found = sorted(found)
        left = [x for i, x in enumerate(found) if not any(y[2] <= x[2] and -y[1] >= -x[1] for y in found[:i])]
        base = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == base | {x[4] for x in left}
        assert r.score == max([license_rules.CONFIDENCE[x[2]] for x in left] + [license_rules.CONFIDENCE[4] if r.n_base else 0.0])
        some += len(left)
    assert some


def test_notices_are_found(spark):
    """Each rule's own wording, where it has no choices, is found and outranks the hints in it."""
    plain = [(label, tier, words) for label, tier, _, words in license_rules.NOTICES if re.fullmatch("[a-z0-9 ]+", words) and any(x in words for x in license_rules.ANCHORS) and tier < 3]
    assert len(plain) > 60
    from skjald.llm import licenses

    rows = [(i, "Some text. " + words.upper().replace(" ", ",\n") + " and more") for i, (_, _, words) in enumerate(plain)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    keyed = [i for i, (label, _, words) in enumerate(plain) if any(k in words for la, _, k, w in license_rules.NOTICES if w == words)]
    assert len(keyed) > 50
    for i in keyed:
        assert plain[i][0] in found[i].labels and found[i].score >= 0.95


def test_media_features(spark, docs):
    wave_ = np.exp(-2j * np.pi * np.outer(np.arange(media.FRAME), np.arange(media.FRAME // 2 + 1)) / media.FRAME)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(media.FRAME) / (media.FRAME - 1))
    for r in queries.op10_media(spark, SF).limit(40).collect():
        raw = docs[r.doc_id].encode()
        raw += bytes(-len(raw) % 64 or (0 if raw else 64))
        assert r.payload_sha256 == hashlib.sha256(raw).hexdigest() and r.payload_bytes == len(raw)
        assert r.feature == f"{len(r.prints)}:{hashlib.sha256(np.array(r.prints, '<i8').tobytes()).hexdigest()}"
        x = np.frombuffer(raw, np.uint8).astype(float) - 128
        n = max(1, -(-(len(x) - media.FRAME) // media.HOP) + 1)
        x = np.append(x, np.zeros((n - 1) * media.HOP + media.FRAME - len(x)))
        power = [np.abs((x[k * media.HOP : k * media.HOP + media.FRAME] * window) @ wave_) for k in range(n)]
        for code in r.prints:  # each pair's bins are strongest in their bands, but for rounding
            frame, low, high, ahead = code >> 20, code >> 11 & 511, code >> 2 & 511, code & 3
            for at, b in ((frame, low), (frame + ahead, high)):
                first, last = next((a, z) for a, z in zip(media.BANDS[:-1], media.BANDS[1:], strict=True) if a <= b < z)
                assert power[at][b] >= power[at][first:last].max() * (1 - 1e-4)
        bands = len(media.BANDS) - 1
        assert len(r.prints) == n * bands * (bands - 1) // 2 + sum(max(0, n - a) for a in range(1, media.AHEAD + 1)) * bands**2


def near_groups(texts):
    """Smallest id of each text's group by all pairs of full sets."""
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_pipeline_is_its_stages_in_plain(spark, docs):
    toxic = {r.doc_id for r in queries.op4_toxicity(spark, SF).collect() if r.predicted}
    groups = near_groups({i: t for i, t in docs.items() if i not in toxic})
    spans = {r.doc_id: r.spans for r in queries.op2_secrets(spark, SF).collect()}
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {}
    for i in sorted(i for i, least in groups.items() if i == least):
        out, at = "", 0
        for kind, a, b in (x.split(":") for x in spans[i].split(",") if x):
            if int(a) >= at:
                out += docs[i][at : int(a)] + f"[{kind.upper()}]"
            at = max(at, int(b))
        kept[i] = out + docs[i][at:]
    mix = mixing.mix_documents(spark.createDataFrame([(i, t, source[i]) for i, t in kept.items()], "doc_id long, text string, source string"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).ranks, special_tokens={})
    wanted = Counter({(r.doc_id, tuple(library.encode_ordinary(kept[r.doc_id]))): r.copies for r in mix.collect() if r.copies})
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert toxic and len(kept) < len(groups) and got == wanted
