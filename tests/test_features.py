"""The file sink, the growing index, rare hashes, edit distances, dynamic keys, quarantine, resampling and short parts."""

import json
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skjald.functions import edits, resampling
from skjald.operators import fingerprints, manifests, reruns, scores, segments, song_index
from skjald.plans import reference_queries
from skjald.sources import files, readers, shared, writers


def names(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_segment_tables_keep_their_order(spark, tmp_path, kind):
    """Lines of a file stand by number, though many tasks have them."""
    lines = spark.range(6000, numPartitions=7).select((F.col("id") % 3).cast(kind).alias("file"), (F.col("id") * 7919 % 6000).alias("seg_id"), F.lit(0).cast("long").alias("start_sample"), F.lit(5).cast("long").alias("end_sample"))
    writers.segment_tables(manifests.segment_lines(lines, "file"), str(tmp_path / "tsv"), "file")
    for k in range(3):
        [found] = [f for f in (tmp_path / "tsv" / f"file={k}").iterdir() if f.suffix == ".txt"]
        numbers = [int(line.split(".")[0]) for line in found.read_text().splitlines()]
        assert numbers == sorted(numbers) and len(numbers) == 2000


def test_file_sink(spark, tmp_path):
    to = str(tmp_path / "out")
    rows = [(f"{k % 3}/{k}.wav", bytes(range(2 * k % 250)) * 2) for k in range(40)]
    frame = spark.createDataFrame(rows, "path string, samples binary").repartition(5)
    writers.audio_files(frame, to)
    found = {r.path.split("/out/")[1]: r.samples for r in readers.recordings(spark, to, readers.wav).collect()}
    assert {p: bytes(b) for p, b in found.items()} == dict(rows) and names(to) == sorted(p for p, _ in rows)
    with pytest.raises(Exception, match="FileExistsError"):  # nothing is moved if one of them is there
        files.write_files(spark.createDataFrame([("new", b"a"), ("0/0.wav", b"b")], "path string, content binary"), to)
    assert names(to) == sorted(p for p, _ in rows)
    files.write_files(spark.createDataFrame([("0/0.wav", b"b")], "path string, content binary"), "file://" + to, overwrite=True)
    assert (tmp_path / "out/0/0.wav").read_bytes() == b"b"
    for path in ("../x", "/x", "", None, "_temporary/x", "a/../.."):
        with pytest.raises(ValueError):
            files.relative(path)


def test_many_files_pass_by_the_driver(spark, tmp_path):
    """Files are moved, listed and read by tasks; of one path the later task's stays; hidden names and other patterns are left out."""
    to = str(tmp_path / "out")
    frame = spark.range(600, numPartitions=6).select(F.concat((F.col("id") % 7).cast("string"), F.lit("/x/"), F.col("id") % 300, F.lit(".wav")).alias("path"), F.encode(F.col("id").cast("string"), "utf-8").alias("content"))
    files.write_files(frame.withColumn("path", F.regexp_replace("path", "^./", "")), to)
    assert len(names(to)) == 300 and all(int((tmp_path / "out" / n).read_text()) == int(n.split("/")[1][:-4]) + 300 for n in names(to))
    files.write_files(frame.filter("id < 300"), to)
    for name in ("_hidden.wav", ".dot.wav", "x/note.txt", "_temporary/y.wav", "a [1].wav"):
        (tmp_path / "out" / name).parent.mkdir(exist_ok=True)
        (tmp_path / "out" / name).write_text("z")
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(to)
    wanted = sorted((r.path, bytes(r.content)) for r in plain.select("path", "content").collect())
    assert len(wanted) == 601
    for root in (to, "file://" + to, to + "/"):
        found = sorted((r.path, bytes(r.content)) for r in files.contents(spark, root, "*.wav").collect())
        assert found == wanted and sorted(r.path for r in files.walked(spark, root, "*.wav").collect()) == [p for p, _ in wanted]
    assert "binaryFile" not in readers.listing(spark, to, "*.wav")._jdf.queryExecution().toString()
    assert readers.listing(spark, to, "{note,other}.txt").select("filename", "folder").collect() == [("note.txt", "x")]
    (tmp_path / "none").mkdir()
    assert readers.listing(spark, str(tmp_path / "none")).isEmpty()


def test_failed_task_leaves_no_file(spark, tmp_path):
    to = str(tmp_path / "out")
    frame = spark.range(40, numPartitions=4).select(F.concat(F.lit("f"), "id").alias("path"), F.when(F.col("id") == 39, F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.encode("id", "utf-8")).alias("content"))
    with pytest.raises(Exception, match="lost"):
        files.write_files(frame, to)
    placed = lambda: [n for n in names(to) if not n.startswith(files.TEMPORARY)]
    assert placed() == []
    files.write_files(frame.filter("id < 39"), to)
    assert len(placed()) == 39


def test_growing_index(spark, tmp_path):
    rng = random.Random(3)
    songs = [(f"s{k}", [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 30))]) for k in range(12)]
    frame = spark.createDataFrame([*songs, ("copy", songs[3][1]), ("none", None)], "name string, tokens array<string>")
    index = song_index.SongIndex(spark, str(tmp_path / "index"), buckets=4)
    assert index.add(frame.filter("name < 's2'"), "name", "tokens") == 5  # with `copy`, which is before s3
    assert index.add(frame, "name", "tokens") == 7
    state = lambda: (sorted(map(tuple, index.fingerprints().collect())), sorted((r.song_name, r.total_hashes) for r in index.songs().collect()))
    full = state()
    assert [n for n, _ in full[1]] == sorted(["copy", *(n for n, _ in songs if n != "s3")]) and sum(t for _, t in full[1]) == len(full[0])
    assert index.add(frame, "name", "tokens") == 0 and state() == full
    # A run that ends between both writes has added nothing; the next one clears and repeats it.
    more = spark.createDataFrame([("late", list("zyxwvu"))], "name string, tokens array<string>")
    keyed = index.new_songs(more, "name", "tokens").withColumn("song_id", F.col("file_sha1"))
    index.write_hashes(fingerprints.index(keyed, "song_id", "tokens"), "half")
    assert state() == full
    again = song_index.SongIndex(spark, str(tmp_path / "index"), buckets=4)
    assert sorted(map(tuple, again.fingerprints().collect())) == full[0]
    assert again.add(more, "name", "tokens") == 1 and again.fingerprints().count() == len(full[0]) + 4
    assert not (tmp_path / "index/fingerprints/batch=half").exists()


def exchanges_above(plan, table):
    """Exchanges between the scan of `table` and the first join above it, in a tree of a plan."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if table in line)
    depth, n = lines[at].index("+-") if "+-" in lines[at] else lines[at].index(":-"), 0
    for line in reversed(lines[:at]):
        mark = max(line.find("+-"), line.find(":-"))
        if 0 <= mark < depth:
            depth = mark
            if "Join" in line:
                return n
            n += "Exchange" in line
    raise AssertionError(plan)


def test_index_is_joined_as_it_lies(spark, tmp_path):
    frame = spark.range(300).select(F.col("id").cast("string").alias("name"), F.transform(F.sequence(F.lit(0), F.lit(40)), lambda x: (x * (F.col("id") + 7) % 50).cast("string")).alias("tokens"))
    index = song_index.SongIndex(spark, str(tmp_path / "index"), buckets=8)
    index.add(frame, "name", "tokens")
    query = fingerprints.index(frame, "name", "tokens")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.match(query)._jdf.queryExecution().simpleString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert exchanges_above(plan.replace("(unknown)", ""), index.hashes_name) == 0


def test_rare_hashes_find_all_confident_matches(spark):
    rng = random.Random(5)
    line = [f"l{k}" for k in range(8)]  # stands in all songs and queries
    songs = [(k, line + [rng.choice("abcdef") + rng.choice("xyz") for _ in range(30)]) for k in range(60)]
    asked = [(100 + k, line + t[8 + k % 9 :] + [f"q{rng.randrange(9)}" for _ in range(k % 7)]) for k, t in songs]
    index = lambda rows: fingerprints.index(spark.createDataFrame(rows, "id long, t array<string>"), "id", "t")
    query, indexed = index(asked), index(songs)
    everything = fingerprints.match(query, indexed).collect()
    for least in (0.1, 0.5, 0.9, 1.0):
        assert sorted(map(tuple, fingerprints.match(query, indexed, least).collect())) == sorted(tuple(r) for r in everything if r.confidence >= least)
    hashes, totals = fingerprints.asked_hashes(query)
    found = fingerprints.candidates(hashes, totals, indexed, 0.9, ["song_id"])
    assert found.count() < 3 * len(asked) < hashes.join(indexed, "hash").count() / 10


def test_only_known_hashes_are_gathered(spark):
    """Hashes that the index lacks count in the totals, within their row; keys of several rows and null ones too."""
    rng = random.Random(6)
    rows = [(k // 2 if k < 20 else k, [rng.choice("abcdefg") for _ in range(k)]) for k in range(60)] + [(None, list("abcabc")), (None, list("cab")), (70, None), (71, list("aaaaaa"))]
    frame = spark.createDataFrame(rows, "id long, t array<string>").repartition(3)
    query, totals = fingerprints.index(frame, "id", F.col("t")), fingerprints.hash_totals(frame, "id", F.col("t"))
    wanted = {r for r in map(tuple, fingerprints.asked_hashes(query)[1].collect()) if r[0] is not None}
    assert {r for r in map(tuple, totals.collect()) if r[0] is not None} == wanted and (71, 1) in wanted
    once = frame.filter("id >= 20")
    assert sorted(map(tuple, fingerprints.hash_totals(once, "id", F.col("t")).collect())) == sorted(r for r in wanted if r[0] >= 20)
    indexed = fingerprints.index(frame.filter("id % 5 = 1"), "id", F.col("t"))
    for least in (0.0, 0.3):
        found = fingerprints.match(query, indexed, least, totals)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, fingerprints.match(query, indexed, least).collect())) != []
    few = fingerprints.index(frame.filter("id = 71"), "id", F.col("t"))  # one hash
    held = fingerprints.match(query, few, 0.0, fingerprints.hash_totals(once, "id", F.col("t")))
    assert "LeftSemi" in held._jdf.queryExecution().executedPlan().toString()


def test_edit_counts_of_long_sequences():
    rng = random.Random(7)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for strip, kept in ((edits.STRIP, edits.KEPT), (5, 30), (64, 0)):
        held = edits.STRIP, edits.KEPT
        edits.STRIP, edits.KEPT = strip, kept
        try:
            for _ in range(400):
                a, b = ([rng.choice("abcé") for _ in range(rng.randrange(40))] for _ in range(2))
                swapped, added, gone = edits.counts(a, b)
                assert swapped + added + gone == plain(a, b) == edits.distance(a, b) and added - gone == len(b) - len(a)
        finally:
            edits.STRIP, edits.KEPT = held
    words = [f"w{k}" for k in range(150_000)]  # more different words than a code plane has
    assert edits.counts(words, ["x", *words[:70_000], *words[70_001:], "y"]) == (0, 2, 1)


def test_error_rates_of_odd_texts(spark):
    rows = spark.createDataFrame([(1, "a b", "a  c"), (1, None, "x"), (2, "", None), (3, "é", "e")], "k int, a string, b string")
    found = {r.k: r for r in scores.error_rates(rows, F.col("a"), F.col("b"), ["k"], apart=True).collect()}
    assert (found[1].cer, found[1].wer) == (1.0, 1.0) and (found[2].cer, found[2].wer) == (None, None) and found[3].cer == 1.0
    assert (found[1].word_substitutions, found[1].word_insertions, found[1].word_deletions) == (1, 1, 0)


def test_dynamic_keys(spark, tmp_path):
    lines = [{"metadata": {"a": 1, "dc:title": "x"}, "id": 1}, {"metadata": {"a": 2.5, "b": [1, 2]}, "id": 2}, {"id": 3}, {"metadata": None, "id": 4, "z": {"q": None}}]
    (tmp_path / "one.json").write_text("\n".join(map(json.dumps, lines[:2])) + "\nbroken {\n")
    (tmp_path / "two.json").write_text("\n".join(map(json.dumps, lines[2:])) + "\n[1]\n\n")
    found = readers.json_objects(spark, str(tmp_path), "metadata")
    assert found.columns == ["a", "b", "dc:title", "id", "z"]
    got = sorted((float(r["a"]) if r["a"] is not None else None, r["b"], r["dc:title"], r["id"], r["z"]) for r in found.collect() if r["id"] in (1, 2)) + sorted((tuple(r) for r in found.collect() if r["id"] > 2), key=lambda r: r[3])
    assert got == [(1.0, None, "x", 1, None), (2.5, "[1,2]", None, 2, None), (None, None, None, 3, None), (None, None, None, 4, '{"q":null}')]
    (tmp_path / "three.json").write_text('{"metadata": {"id": 9}, "id": 5}\n')
    with pytest.raises(ValueError, match="both levels: id"):
        readers.json_objects(spark, str(tmp_path), "metadata")
    with pytest.raises(ValueError, match="more than 1 keys"):
        readers.object_keys(spark.read.text(str(tmp_path)).select(F.try_parse_json("value").alias("v")), "v", most=1)


def test_quarantine(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("m/u1.mp3\t5\nm/u2\nm/u3\tx\n\nm/u4\t6\t7\n")
    (tmp_path / "b.tsv").write_text("m/u5\t8\n")
    rows, bad = readers.checked(spark, str(tmp_path), "file_path string, n long")
    assert sorted(map(tuple, rows.collect())) == [("m/u1.mp3", 5), ("m/u5", 8)]
    found = sorted((r.file.split("/")[-1], r.line, r.reason) for r in bad.collect())
    assert found == [("a.tsv", "m/u2", "1 fields of 2"), ("a.tsv", "m/u3\tx", "a field of another type"), ("a.tsv", "m/u4\t6\t7", "3 fields of 2")]
    done = spark.createDataFrame([("u1",)], "name string")
    assert tuple(reruns.audit(rows, done, quarantine=bad).first()) == (2, 1, 1, 3)


def test_quarantined_audit_of_large_numbers(spark, tmp_path):
    """Ids of five digits and more are told from those that they begin with."""
    spark.createDataFrame([(k, 50) for k in range(49_990, 50_030)], "doc_id long, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1) for k in (4, 5, 50_001, 50_003)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    good = [k for k in range(49_990, 50_030) if k % 7 and k % 11]
    done = len({50_001, 50_003} & set(good))
    assert done and tuple(reference_queries.P16_quarantined_audit(spark, str(tmp_path)).first()) == (len(good), done, len(good) - done, 40 - len(good))


@pytest.mark.parametrize("old", [44_100, 48_000, 22_050, 8_000])
def test_resampling(old):
    level = lambda y: 20 * np.log10(np.sqrt(2 * np.mean(y[len(y) // 4 : -len(y) // 4] ** 2)))
    tone = lambda hertz: np.sin(2 * np.pi * hertz * np.arange(old) / old)
    assert abs(level(resampling.resample(tone(1_000), old, 16_000))) < 0.1
    if old > 20_000:
        assert level(resampling.resample(tone(10_000), old, 16_000)) < -60
    for n in (0, 1, 2, 441, 1000):
        found = resampling.resample(np.full(n, 7.0), old, 16_000)
        assert len(found) == -(-n * 16_000 // old) and np.allclose(found, 7)


def test_resampling_by_blocks():
    """As a sum over each new sample's surroundings; of rates with few, many and too many phases."""
    rng = np.random.default_rng(4)
    for old, new in ((44_100, 16_000), (48_000, 16_000), (8_000, 16_000), (44_101, 16_000)):
        table, common = resampling.phases(old, new), np.gcd(old, new)
        half = table.shape[1] // 2
        for n in (1, 700, 3_001):
            x = rng.integers(-32_768, 32_768, n).astype("<i2")
            places = np.arange(-(-n * new // old)) * (old // common)
            near = x[np.clip((places // (new // common))[:, None] + np.arange(-half + 1, half + 1), 0, n - 1)].astype(float)
            assert np.allclose(resampling.resample(x, old, new), (near * table[places % (new // common)]).sum(1), atol=1e-6)
    assert resampling.block(44_100, 16_000)[0].nbytes < 1_000_000


def test_files_are_given_back_in_small_batches(spark, monkeypatch):
    """What a task holds is bounded by bytes, not by rows."""
    frame = spark.range(300, numPartitions=1).select(F.col("id").cast("string").alias("path"), F.encode(F.repeat(F.lit("ab"), 50_000), "utf-8").alias("samples"))
    for found, column in ((writers.wav_files(frame), "content"), (readers.decoded(writers.wav_files(frame, 44_100), readers.wav), "samples")):
        sizes = found.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long")
        assert found.count() == 300 and found.agg(F.min(F.length(column))).first()[0] >= 100_000 and sizes.agg(F.sum("n")).first()[0] == 300
    rows = ((k, b"x" * 1_000) for k in range(10))
    batches = shared.batched(rows, pa.schema([("k", pa.int64()), ("b", pa.binary())]), 2_500)
    assert next(batches).num_rows == 3 and next(rows)[0] == 3  # the others aren't made yet
    assert [b.num_rows for b in batches] == [3, 3]


def test_short_parts_are_literal(spark):
    rng = random.Random(9)
    texts = [(k, " ".join(rng.choice(["a.b", "ab", "(x", "x)", "a", "", "é*", "\\Q"]) for _ in range(6))) for k in range(60)] + [(None, "a.b only"), (61, None), (62, "")]
    parts = [(k, p) for k, p in enumerate(["a.b", "(x", "a a", "é*", "\\Q", "x) a", "", "nowhere", "a.b a.b", " ", None, "a.b", "ab (x a"])]
    docs, rows = spark.createDataFrame(texts, "doc long, body string").repartition(3), spark.createDataFrame(parts, "k int, part string")
    found = reruns.first_match(rows, docs, "body", "part", "doc")
    wanted = []
    for k, part in parts:
        hits = [d for d, t in texts if part is not None and t is not None and part in t]
        if hits:
            wanted.append((k, part, min((d for d in hits if d is not None), default=None), len(hits)))
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()


def test_collisions_with_what_exists(spark):
    rows, there = (spark.createDataFrame([(p,) for p in ps], "path string") for ps in (["a", "a", "b", "c"], ["b", "z"]))
    assert sorted(map(tuple, manifests.collisions(rows, "path", there).collect())) == [("a", 2, False), ("b", 1, True)]


@pytest.mark.parametrize("few", [3, 10_000])
def test_middle_values(spark, few):
    """Ties, one value, even and odd numbers, a wide range of magnitudes."""
    rng = random.Random(few)
    values = {1: [0.5], 2: [1.0, 2.0], 3: [rng.random() for _ in range(999)], 4: [rng.choice([0.1, 0.2]) for _ in range(100)], 5: [10.0 ** rng.choice([-300, -100, 0, 100, 300]) * rng.choice([-1, 1]) for _ in range(501)], 6: [7.0] * 50, 7: [-1e308, 1e308], 8: [0.0] * 50 + [1.0] * 50}
    frame = spark.createDataFrame([(k, i, v) for k, vs in values.items() for i, v in enumerate(vs)] + [(1, 9, None), (9, 0, None)], "file_id long, i int, p double")
    found = {r.file_id: (r.lower, r.upper) for r in segments.middle_values(frame, "file_id", "p", few).collect()}
    assert found == {k: (sorted(vs)[(len(vs) - 1) // 2], sorted(vs)[len(vs) // 2]) for k, vs in values.items()}
