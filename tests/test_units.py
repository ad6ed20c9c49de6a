"""Edge cases of the library's own operators."""

import io
import random
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from skjald.functions import paths, text
from skjald.operators import fingerprints, manifests, reruns, scores, segments
from skjald.sources import readers, writers


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


def test_numbers_to_words(spark):
    values = [0, 7, 21, 99, 100, 110, 342, 1000, 1001, 2018, 20_305, 1_000_000, 3_400_021, 999_999_999]
    assert column(spark, [f"a{n}b" for n in values], text.spell_numbers) == [f"a{text.number_words(n)}b" for n in values]
    assert text.number_words(21) == "enogtyve"
    assert column(spark, ["", None, "x", "1234567890"], text.spell_numbers) == ["", None, "x", "en to tre fire fem seks syv otte ni nul"]


def test_cleaners(spark):
    assert column(spark, ["Hej,  «Í» ó-b!", None, ""], text.clean_basic) == ["hej í o b", None, ""]
    assert column(spark, ["xxx ja (støj) [1] Host host 5% ö/ä"], text.clean_talk) == [" ja host fem procent æ æ"]
    assert column(spark, ["ab å", "Ab", "a1", ""], text.in_vocabulary) == [True, False, False, True]
    assert column(spark, ["ab å", "aBc"], text.first_outside) == ["", "B"]
    assert column(spark, ["ab c"], text.letters) == ["a b | c"]
    assert column(spark, ["3.5S", "3", "x", None], text.seconds) == [3.5, 3.0, None, None]


def test_word_distance(spark):
    rng = random.Random(3)
    pairs = [([rng.choice("abcd") for _ in range(rng.randrange(9))], [rng.choice("abcde") for _ in range(rng.randrange(9))]) for _ in range(60)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rows = spark.createDataFrame([(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    found = scores.edit_counts(rows, F.col("a"), F.col("b"), ["i"]).orderBy("i").collect()
    assert [r.word_substitutions + r.word_insertions + r.word_deletions for r in found] == [distance(a, b) for a, b in pairs]
    assert [r.char_substitutions + r.char_insertions + r.char_deletions for r in found] == [distance(" ".join(a), " ".join(b)) for a, b in pairs]
    assert all(r.word_insertions - r.word_deletions == len(b) - len(a) for r, (a, b) in zip(found, pairs, strict=True))


def test_paths(spark):
    assert column(spark, ["a/b.mp3", "b.wav", "b.txt"], paths.stem) == ["a/b", "b", "b.txt"]
    assert column(spark, ["//a/b", "/a", "///a", "a"], paths.normal_line) == ["a/b", "a", "a", "a"]
    assert column(spark, [0, 5, 6, 22, 23, None], lambda h: paths.night(h), "int") == [False] * 6
    assert column(spark, [0, 5, 6, 22, 23, None], lambda h: paths.night(h, True), "int") == [True, True, False, False, True, False]


def test_reruns(spark):
    titles = ["Golf", "Show (G)", "show", None]
    assert column(spark, titles, lambda t: reruns.mentions(t, ["(G)"])) == [True, True, False, False]
    assert column(spark, titles, lambda t: reruns.mentions(t, ["(G)"], literal=True)) == [False, True, False, False]
    rows = spark.createDataFrame([(1, "a"), (2, None)], "n int, auth string")
    status = spark.createDataFrame([("a", "rerun"), ("a", "other"), (None, "rerun")], "id string, status string")
    found = reruns.with_status(rows, status, "auth", "is_x_rerun")
    assert sorted(map(tuple, found.collect()), key=repr) == [(1, "a", False), (1, "a", True), (2, None, True)]
    plain = reruns.with_status(rows, status, "auth", "is_x_rerun", null_safe=False)
    assert sorted(map(tuple, plain.collect()), key=repr) == [(1, "a", False), (1, "a", True), (2, None, False)]
    wanted = spark.createDataFrame([("m/u1.mp3",), ("m/u2xxxx",), ("m/u3",), ("noslash",)], "file_path string")
    done = spark.createDataFrame([("u1",), ("u2",)], "name string")
    assert tuple(reruns.audit(wanted, done).first()) == (3, 2, 1)


def test_audit_of_numbers(spark):
    """A number that begins another one is another file's."""
    wanted = spark.createDataFrame([("m/51282.mp3",), ("m/51283.wav",), ("m/7.wav",), ("m/51284",), ("m/5.mp3.wav",), ("m/x.mp3x",)], "file_path string")
    done = spark.createDataFrame([("5",), ("7",), ("51283",), ("",)], "name string")
    assert tuple(reruns.audit(wanted, done, end=reruns.EXTENSION).first()) == (6, 3, 3)


def machine(p, step=200, back=20, bridge=15, shortest=10_000):
    """Voice segments frame by frame."""
    ordered = sorted(p)
    thr = 0.89 * ordered[(len(p) - 1) // 2] + 0.08
    out, start, low, cut = [], None, 0, 0
    for i in range(len(p)):
        high = max(p[max(0, i - back + 1) : i + 1]) >= thr
        if high:
            if start is None:
                start = step * max(0, i - back)
            low = 0
        elif start is not None:
            if not low:
                cut = step * i
            low += 1
            if low > bridge:
                if cut - start > shortest:
                    out.append((start, cut))
                start, low = None, 0
    if start is not None:
        out.append((start, step * len(p)))
    return out


def test_voice_segments(spark):
    rng = random.Random(5)
    files = {k: [rng.random() * (0.2 if (i // rng.choice([30, 60, 90])) % 2 else 1.0) for i in range(rng.choice([1, 40, 400, 900]))] for k in range(12)}
    rows = spark.createDataFrame([(k, i, p) for k, ps in files.items() for i, p in enumerate(ps)], "file_id long, i int, p double")
    found = segments.voice_segments(rows)
    got = {k: [] for k in files}
    for r in found.orderBy("file_id", "seg_id").collect():
        got[r.file_id].append((r.start, r.end))
    assert got == {k: machine(p) for k, p in files.items()}
    assert segments.padded(found).filter("start < 0 or end < start").count() == 0


def plain_segments(p, trigger=320, silence=23, longest=1200, shortest=480, reach=160, step=200):
    """The rules over slices of the whole list: a buffer is p[first:i + 1]."""
    level = 0.89 * np.median(p) + 0.08
    out, first, speech = [], 0, False
    for i in range(len(p)):
        size = i + 1 - first
        if size < trigger:
            continue
        if not speech:
            if np.mean(p[first : i + 1]) > level:
                speech, start = True, first
            else:
                first += 1
            continue
        if np.mean(p[first : i + 1 - silence]) >= level or size < shortest:
            continue
        if size > longest:
            tries = list(range(size // 2 - reach, size // 2 + reach, silence))
            at = int(tries[int(np.argmin([p[first + k + silence] for k in tries]))] + silence / 2)
            out += [(step * start, step * (i - (size - at) - 1)), (step * (i - (size - at) + 1), step * i)]
        else:
            out.append((step * start, step * i))
        first, speech = i + 1, False
    return out


def test_custom_segments(spark):
    rng = np.random.default_rng(7)
    files = {}
    for k in range(20):  # speech and silence of random lengths
        p = np.concatenate([np.clip(rng.normal(rng.choice([0.15, 0.5, 0.85]), 0.15, rng.integers(100, 1500)), 0, 1) for _ in range(20)])[:6000]
        files[k] = p.tolist()
    files[20], files[21] = [0.5] * 319, [0.25] * 5000 + [1.0] * 1300 + [0.0] * 3500
    rows = spark.createDataFrame([(k, i, x) for k, p in files.items() for i, x in enumerate(p)], "file_id long, i int, p double").repartition(5)
    got = {k: [] for k in files}
    for r in segments.segment("custom", rows).orderBy("file_id", "seg_id").collect():
        assert r.seg_id == len(got[r.file_id])
        got[r.file_id].append((r.start, r.end))
    assert got == {k: plain_segments(p) for k, p in files.items()}
    assert sum(map(len, got.values())) > 30 and got[21]
    with pytest.raises(ValueError):
        segments.segment("none", rows)


def test_searches_over_indexes(spark):
    songs = spark.createDataFrame([(1, "a b c d e f"), (2, "x y z a b c d"), (3, "q r s t")], "k long, t string")
    index = fingerprints.index(songs, "k", F.split("t", " "))
    assert {(r.song_id, r.offset) for r in index.collect()} == {(1, 0), (1, 1), (1, 2), (1, 3), *((2, i) for i in range(5)), (3, 0), (3, 1)}
    both = index.withColumn("name", F.lit("p1_2014_2015")).union(index.filter("song_id = 2").withColumn("name", F.lit("p1_2016")))
    names = spark.createDataFrame([("p1_2014_2015",), ("p1_2016",)], "name string")
    asked = spark.createDataFrame([("p1", 2015), ("p1", 2016), ("p1", 1999)], "channel string, year int")
    assert {tuple(r) for r in fingerprints.index_names(asked, names).collect()} == {("p1", 2015, "p1_2014_2015"), ("p1", 2016, "p1_2016")}
    with pytest.raises(Exception, match="several indexes"):
        fingerprints.index_names(spark.createDataFrame([("p1", 201)], "channel string, year int"), names).collect()
    wide = fingerprints.find_duplicates(songs.union(spark.createDataFrame([(9, "a")], songs.schema)), "k", index, both, ["p1_2014_2015", "p1_2016"])
    rows = {r.k: r for r in wide.collect()}
    assert rows[1].matched_files_p1_2014_2015 == [1, 2] and rows[1].confidences_p1_2014_2015 == [1.0, 0.5] and rows[1].matched_files_p1_2016 == [2]
    assert rows[3].matched_files_p1_2016 == [] and not rows[3].error_p1_2016 and rows[9].error_p1_2016


def test_first_match(spark):
    texts = spark.createDataFrame([(1, "x one two three y"), (2, "xone two threey"), (3, "one three two"), (4, None), (5, "one two three")], "i long, t string")
    parts = spark.createDataFrame([("one two three",), ("one two",), ("two",), ("none of it",), ("",)], "part string")
    found = {r.part: (r.first_match, r.n_matches) for r in reruns.first_match(parts, texts, "t", "part", "i").collect()}
    assert found == {"one two three": (1, 3), "one two": (1, 3), "two": (1, 4), "": (1, 4)}


def test_speech_is_mono_at_16_khz():
    def wav_of(channels, width, rate, raw):
        out = io.BytesIO()
        with wave.open(out, "wb") as file:
            file.setnchannels(channels), file.setsampwidth(width), file.setframerate(rate)
            file.writeframes(raw)
        return out.getvalue()

    x = (10_000 * np.sin(2 * np.pi * 200 * np.arange(44_100) / 44_100)).astype("<i2")
    rate, raw = readers.speech(wav_of(2, 2, 44_100, np.repeat(x, 2).astype("<i2").tobytes()))
    y = np.frombuffer(raw, "<i2")
    assert (rate, len(y)) == (16_000, 16_000)
    assert np.abs(y - 10_000 * np.sin(2 * np.pi * 200 * np.arange(16_000) / 16_000))[100:-100].max() < 5  # and no delay
    up = np.frombuffer(readers.speech(wav_of(1, 1, 8_000, bytes([128, 192, 128])))[1], "<i2")
    assert len(up) == 6 and np.abs(up[::2] - np.array([0, 16384, 0])).max() < 1100  # a filter whose edge is below the old half rate
    assert readers.speech(wav_of(1, 3, 16_000, b"\x01\x02\x03"))[1] == b"\x02\x03"
    assert readers.speech(wav_of(1, 2, 22_050, b""))[1] == b""


def test_tiles_and_frames(spark):
    files = spark.createDataFrame([(1, 0), (2, 1_920_000), (3, 1_920_001), (4, 9_000_000)], "k long, n long")
    found = segments.tiles(files, "k", "n", "s").collect()
    assert {r.k for r in found} == {4}
    assert all(48_000 <= r.end_sample - r.start_sample <= 240_000 and r.end_sample <= 9_000_000 - 1_920_000 for r in found)
    assert segments.frames(spark.createDataFrame([(1, 401), (2, 0)], "k long, n long"), "k", "n").count() == 3


def test_manifests(spark):
    lines = spark.createDataFrame([("//c/m/u/1.wav\t5",), ("a///b",), ("manifest",), ("a/b\t1",)], "value string")
    found = manifests.normal_lines(lines).withColumn("ok", manifests.valid(F.col("value")))
    assert sorted(map(tuple, found.collect())) == [("a/b\t1", False), ("c/m/u/1.wav\t5", True)]
    rows = spark.range(50).withColumnRenamed("id", "k")
    split = manifests.split(rows, "k", "s", 20)
    assert sorted(r["count"] for r in split.groupBy("split").count().collect()) == [20, 30]
    assert manifests.split(rows, "k", "s", 20).exceptAll(split).count() == 0


def test_fingerprints(spark):
    songs = spark.createDataFrame([(1, "a b c d e f".split()), (2, "x a b c d y".split()), (3, ["a"])], "k long, t array<string>")
    indexed = fingerprints.index(songs, "k", F.col("t"))
    best = {(r.query_id, r.song_id): (r.aligned, r.confidence) for r in fingerprints.match(indexed, indexed).collect()}
    assert best == {(1, 1): (4, 1.0), (1, 2): (2, 0.5), (2, 2): (4, 1.0), (2, 1): (2, 0.5)}
    assert {r.query_id for r in fingerprints.duplicates(fingerprints.match(indexed, indexed)).filter("is_duplicate").collect()} == {1, 2}
    assert fingerprints.listed(fingerprints.match(indexed, indexed)).filter("query_id = 1").first().matched == [1, 2]


def test_scores(spark):
    rows = spark.createDataFrame([("m", "a b c", "a x c"), ("m", "", None), ("n", None, "z")], "model string, r string, h string")
    found = {r.model: (r.cer, r.wer) for r in scores.error_rates(rows, F.col("r"), F.col("h"), ["model"]).collect()}
    assert found == {"m": (1 / 5, 1 / 3), "n": (None, None)}
    assert "NA" in scores.latex(spark.createDataFrame([(None, 1.5)], "a string, b double"))


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in" / "m1").mkdir(parents=True)
    with wave.open(str(tmp_path / "in" / "m1" / "u.wav"), "wb") as f:
        f.setnchannels(1), f.setsampwidth(2), f.setframerate(16_000), f.writeframes(b"\1\0" * 30)
    found = readers.recordings(spark, str(tmp_path / "in"), readers.wav).first()
    assert (found.rate, found.n_samples) == (16_000, 30)
    assert readers.listing(spark, str(tmp_path / "in"), "*wav").first().folder == "m1"
    wavs = writers.wav_files(spark.createDataFrame([("p", bytes(found.samples))], "path string, samples binary")).first()
    assert wave.open(io.BytesIO(bytes(wavs.content))).getnframes() == 30
    (tmp_path / "s.tsv").write_text("skip\tme\na\trerun\n")
    assert [tuple(r) for r in readers.status(spark, str(tmp_path / "s.tsv"), skip_first=True).collect()] == [("a", "rerun")]
    (tmp_path / "m.json").write_text('{"metadata": {"a": 1}, "filename": "f"}\n')
    assert tuple(readers.json_lines(spark, str(tmp_path / "m.json"), "metadata struct<a:int>, filename string", "metadata").first()) == (1, "f")
    writers.manifest(spark.createDataFrame([("b",), ("a",)], "v string"), str(tmp_path / "man"), "/root")
    assert [r.value for r in readers.lines(spark, str(tmp_path / "man")).collect()] == ["/root", "a", "b"]
    writers.triples(spark.createDataFrame([("t1", "w", "l"), ("t0", "w0", "l0")], "tsv string, wrd string, ltr string"), str(tmp_path / "tri"))
    assert [r.value for r in readers.lines(spark, str(tmp_path / "tri" / "kind=wrd")).orderBy("value").collect()] == ["w", "w0"]
    writers.index(spark.createDataFrame([(1, 5, "p1", 2014)], "song_id long, hash long, channel string, year int"), str(tmp_path / "ix"), ["channel", "year"])
    assert spark.read.parquet(str(tmp_path / "ix")).filter("year = 2014").count() == 1
    writers.segment_tables(spark.createDataFrame([("u", "0.wav\t5")], "k string, line string"), str(tmp_path / "seg"), "k")
    assert readers.lines(spark, str(tmp_path / "seg")).first().value == "0.wav\t5"
    writers.delimited(spark.range(2), str(tmp_path / "csv"))
    assert readers.delimited(spark, str(tmp_path / "csv"), "id long").count() == 2
