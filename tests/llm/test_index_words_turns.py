"""The inverted index, spelling variants and conversation repair against plain versions."""

import hashlib
import heapq
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from skjald.llm import contamination, conversations, minhash, passages, queries, spelling
from tests.llm.conftest import SF

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_contamination(docs, items):
    terms = lambda t: TERM.findall((t or "").translate(ASCII_LOWER))
    windows = {}
    for item, text in items:
        w = terms(text)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(item)
    found = []
    for doc, text in docs:
        w, hit, of = terms(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if at := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    of |= at
        of.discard(None)
        found.append((doc, len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(map(str, of))).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=repr)


def test_decontamination_of_odd_texts(spark, documents, empty, texts, monkeypatch):
    items = [(1, " ".join(texts[3].split()[20:45])), (2, "One"), (3, "one, TWO three"), (None, " ".join(texts[3].split()[100:115])), (4, None), (5, ""), (6, texts[11]), (7, " ".join(texts[10].split()[40_000:40_012])), (7, "absent term"), (2, "one"), (8, "...")]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    for chunk, batch, candidates in ((contamination.CHUNK_BYTES, contamination.BATCH, contamination.CANDIDATES), (300, 10, 3)):
        for name, value in (("CHUNK_BYTES", chunk), ("BATCH", batch), ("CANDIDATES", candidates)):
            monkeypatch.setattr(contamination, name, value)
        got = sorted((tuple(r)[:6] for r in contamination.contamination(documents, bench).collect()), key=repr)
        assert got == plain_contamination(docs, items)
    assert contamination.contamination(empty, bench).isEmpty()
    none = contamination.contamination(documents, bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)
    kept = contamination.without_contaminated(documents, bench, most=0.5)
    assert kept.columns == documents.columns and 7 not in {r.doc_id for r in kept.collect()} and kept.count() < len(docs)


def test_decontamination_query(spark):
    rows = lambda name, c: [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(c, "text").collect()]
    got = sorted((tuple(r)[:6] for r in queries.op11_decontamination(spark, SF).collect()), key=repr)
    assert got == plain_contamination(rows("documents", "doc_id"), rows("benchmark", "item_id"))
    assert any(r[-1] for r in got)


def test_decontamination_query_has_the_columns_of_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    assert queries.op11_decontamination(spark, SF).columns == con.sql(queries.ORACLES["op11_decontamination"]).columns


def test_proximity_matches(spark):
    rng = np.random.default_rng(7)
    w = [f"w{x}" for x in rng.integers(0, 100_000, 40)]
    item = w[5:15]
    rows = [(1, w), (2, [*w[:9], "extra", "more", *w[9:]]), (3, [*w[:9], *["extra"] * 9, *w[9:]]), (4, [*w[:6], *w[7:]]), (5, w[:9]), (6, w[9:])]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in rows], "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r for r in contamination.matches(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()}
    assert {i for i, r in found.items() if r["items"]} == {1} and {i for i, r in found.items() if r.near_items} == {2}
    assert [tuple(s) for s in found[1].spans] == [(5, 15)]
    with pytest.raises(ValueError):
        contamination.matches(docs, docs, slop=contamination.GAP)


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(docs):
    n = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            word = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 5:
                n[word] += 1
    return {w: c for w, c in n.items() if c >= 3}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))  # noqa: B905
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def plain_variants(n):
    cut, by = {}, {}
    for w in n:
        for i in range(len(w)):
            cut.setdefault((len(w), w[:i] + w[i + 1 :]), set()).add(w)
    for (_, less), words in cut.items():
        for w in words | ({less} & set(n)):
            by.setdefault(w, set()).update(words, {less} & set(n))
    form, rows = {}, []
    near_of = {w: [x for x in by.get(w, ()) if near(w, x)] for w in n}
    for w, others in near_of.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    for w in n:
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n[w], len(near_of[w]), n[form[w]] if w in form else None))
    return sorted(rows, key=repr)


def test_spelling_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op12_spelling(spark, SF).collect()), key=repr)
    assert got == plain_variants(plain_counts(docs)) and sum(r[1] is not None for r in got) > 20


def test_spelling_of_odd_texts(spark, documents, empty):
    again = documents.union(documents).union(documents)
    long = spark.createDataFrame([(k, f"{'ab' * 40_000} {'ba' * 300}{k} É×÷éàÿĀÉé tésting testing tsting TESTING Ünïß") for k in range(4)], "doc_id long, text string")
    rows = again.select("doc_id", "text").union(long)
    docs = [(r.doc_id, r.text) for r in rows.collect()]
    got = sorted((tuple(r) for r in spelling.spelling_variants(rows).collect()), key=repr)
    assert got == plain_variants(plain_counts(docs))
    assert spelling.spelling_variants(again.select("*")).count() and spelling.spelling_variants(empty).isEmpty()


@pytest.mark.parametrize("most", [2, 7, 10_000])
def test_blocks_lose_no_pair(spark, most):
    """All words over a small alphabet: blocks are subdivided down to one code point."""
    rng = np.random.default_rng(most)
    words = {"".join("abé"[x] for x in rng.integers(0, 3, int(rng.integers(5, 8)))) for _ in range(700)} | {"common" + c + d for c in "abcdef" for d in "abcdef"} | {"x" * k for k in range(5, 60)}
    n = {w: int(rng.integers(3, 60)) for w in words}
    frame = spark.createDataFrame(list(n.items()), "word string, n long")
    assert sorted((tuple(r) for r in spelling.variants(frame, most=most).collect()), key=repr) == plain_variants(n)
    sizes = spelling.blocks(frame, most).filter("high - low > 1").groupBy(*spelling.KEY).count()
    assert (sizes.selectExpr("max(count)").first()[0] or 0) <= most


def plain_repair(rows):
    """rows: turn, role, text in order; by a search over all edits in order of cost and initials."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        if i == len(rows) and state in ("", "a"):
            break
        done.add((i, state))
        nxt = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        full = {"u": "user", "a": "assistant"}[nxt]
        heapq.heappush(heap, (cost + 3, audit + "I", i, nxt, (*out, f"{full}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, nxt, (*out, f"{full}:{text}")))
                if role[:1] == nxt or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))  # noqa: B905
    count = Counter(faults)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain_conversations(rows):
    kept, found = {}, []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept.setdefault(conv, [])
        if h:
            row = (turn, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
            kept[conv] += [row] * (1 + (h == 3))
    for conv, turns in kept.items():
        found.append((conv, *plain_repair(sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())))))
    return sorted(found, key=repr)


def test_conversations_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op13_conversations(spark, SF).collect()), key=repr) == plain_conversations(rows)


@pytest.mark.parametrize("block", [1, 2, 8])
def test_conversations_of_odd_rows(spark, monkeypatch, block):
    """Nulls, repeats, gaps and one long conversation, in blocks of 2 rows and more."""
    rng = np.random.default_rng(block)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    roles, texts = ["user", "assistant", "system", "tool", "", None, "user", "assistant"], ["a.", "b!", "c", "", None, " \n", "long " * 300 + ".", "d?\t", "é.　"]
    rows = [(pick([*range(25), None]), pick([0, 1, 2, 3, 4, 7, None]), pick(roles), pick(texts)) for _ in range(160)]
    rows += [(100, k, "user" if k % 2 == 0 else "assistant", f"t{k}.") for k in range(300)] + [(101, 5, "user", "same.")] * 40 + rows[:15]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, n string, at int").repartition(3)
    monkeypatch.setattr(conversations, "BLOCK", block)
    got = conversations.repaired(conversations.damaged(frame), frame)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_conversations(rows)
    assert conversations.repaired(conversations.damaged(frame.limit(0)), frame.limit(0)).isEmpty()


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_words_built_to_collide_stay_apart(spark, size):
    """Sums of powers would give these two words one hash."""
    a = "".join("ab"[bin(i).count("1") & 1] for i in range(size))
    b = a.translate(str.maketrans("ab", "ba"))
    found = minhash.near_duplicates(spark.createDataFrame([(1, a), (2, b), (3, a.upper())], "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(1, 1), (2, 2), (3, 1)}
    tokens = [passages.tokens([f"{w} " * 60])[0] for w in (a, b)]
    assert not set(tokens[0].tolist()) & set(tokens[1].tolist())
