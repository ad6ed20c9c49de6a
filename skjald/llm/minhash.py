"""Near-duplicate documents by SuperMinHash signatures, banding and checked links.

Words are runs of characters other than ASCII blanks, with A-Z lower-cased; a
document's set holds the 64-bit hashes of its distinct shingles of five words, or of
the whole sequence if it has fewer. Two documents are linked if 100 * intersection >=
75 * union on these full sets; a component is what links connect.

Stages, of which none sends a document's set or signature to the driver:
1. signatures: for each element, SuperMinHash draws a level by level permutation of the
   slots; a document stops at the level at which its slots are all filled. Documents of
   equal sets form a class, and only its representative goes on.
2. candidates: classes that agree in a band are compared by signature; each band's
   bucket first compares its members with its smallest only, so that a group of n
   copies makes n pairs and not n * n.
3. verification on full sets, which are read from the texts of candidates alone.
4. families: in buckets whose members still are in several components, tiles of
   bounded size look for components that are alike by signature; such components form a
   family. All members of a family then meet in tiles on their full sets, and a tile
   returns a spanning forest of the links that it finds.
5. components by alternating large-star and small-star contraction of the links.

Two signatures of SLOTS = 128 slots that stand for a similarity of 0.75 agree in fewer
than 128 * LEAST slots with a chance of about 1e-6; those pairs aren't verified.

Cases: very long texts are read whole, and a tile's members are bounded in their number,
not in the size of their sets; of equal sets the smallest id stands for all; null texts and texts without words have an empty set, n_shingles 0, and are
linked with nothing; rows that repeat are documents of equal sets; rows without an id
are linked with nothing, have no component and are kept; an empty table gives an empty
result; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skjald.llm.common import cut, small, tiled, with_free_names
from skjald.llm.graph import components

SHINGLE = 5
SLOTS, ROWS = 128, 4
SIMILAR = 75  # per cent
#: Share of equal slots from which a pair is verified.
LEAST = 0.56
#: Members of a bucket that are compared with as many others at once.
TILE = 1024
#: The same for full sets.
TILE_SETS = 512
#: Rows of two integers up to which a table is broadcast: some 10 MB.
BROADCAST_IDS = 300_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function, in place of a random number generator with seed x."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


#: Places of a word with random numbers of their own for each byte; later ones mix theirs with the number of the run.
PLACES = 64
#: Independent random numbers of (place, byte), A-Z as a-z: a word's hash is their sum, so that no two words collide by their shape.
TABLE = mixed(np.arange(1, PLACES * 256 + 1, dtype=np.uint64) * ODD).reshape(PLACES, 256)
TABLE[:, 65:91] = TABLE[:, 97:123]
BLANK = np.isin(np.arange(256), [*range(9, 14), 32])
TABLE[:, BLANK] = 0
TABLE = TABLE.ravel()
#: Bytes that are hashed at a time.
HASHED = 1 << 20


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and how many each text has."""
    raw = [text.encode() if text else b"" for text in texts]
    found = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    blank = BLANK[found]
    starts = np.flatnonzero(~blank & np.append(True, blank)[:-1])
    bounds = np.cumsum([0, *(len(x) + 1 for x in raw)])
    counts = np.diff(np.searchsorted(starts, bounds))
    out = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(found), HASHED)), len(starts)))
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        first = starts[low:high]
        part = found[first[0] : starts[high] if high < len(starts) else len(found)]
        first = first - first[0]
        place = np.arange(len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
        value = TABLE[(place % PLACES << 8) + part]
        far = (place >= PLACES) & (value != 0)
        if far.any():
            value[far] = mixed(value[far] + (place[far] // PLACES).astype(np.uint64) * ODD)
        out[low:high] = np.add.reduceat(value, first)
    return mixed(out), counts


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of each text's distinct shingles, joined, and how many each text has."""
    words, n = word_hashes(texts)
    row = np.repeat(np.arange(len(n)), n)
    left = np.repeat(np.cumsum(n), n) - np.arange(len(words))  # words from here to the text's end
    first = np.ones(len(words), bool)
    first[1:] = row[1:] != row[:-1]
    mark = np.zeros(len(words), np.uint64)
    reach = np.concatenate([words, np.zeros(size, np.uint64)])
    for k in range(size):
        mark = np.where(left > k, mixed(mark * ODD + reach[k : k + len(words)] + np.uint64(k + 1)), mark)
    keep = first | (left >= size)
    row, mark = row[keep], mark[keep]
    order = np.lexsort((mark, row))
    row, mark = row[order], mark[order]
    new = np.ones(len(mark), bool)
    new[1:] = (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])
    return mark[new], np.bincount(row[new], minlength=len(n)).astype(np.int64)


def signatures(marks: np.ndarray, sizes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set: slots of (level, random number), the smallest of all elements.

    Level by level, every element of a set that has empty slots draws its next place in a
    permutation of the slots and a random number; a set whose slots are filled stops, as
    later levels give larger values only."""
    n = len(sizes)
    best = np.full((n, slots), np.iinfo(np.uint64).max, np.uint64)
    flat = best.reshape(-1)
    row = np.repeat(np.arange(n), sizes)
    perm = None
    for level in range(slots):
        draw = mixed(marks + np.uint64(int(ODD) * (level + 1) % (1 << 64)))
        place = level + ((draw >> np.uint64(32)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        value = np.uint64(level) << np.uint64(32) | draw & np.uint64(0xFFFFFFFF)
        if level == 0:
            slot = place
        else:
            each = np.arange(len(row))
            slot = perm[each, place].astype(np.int64)
            perm[each, place] = perm[:, level]
            perm[:, level] = slot
        np.minimum.at(flat, row * slots + slot, value)
        if level == slots - 1:
            break
        open_rows = (best == np.iinfo(np.uint64).max).any(1)
        keep = open_rows[row]
        if not keep.any():
            break
        if level == 0:
            first = place[keep]
            marks, row = marks[keep], row[keep]
            perm = np.tile(np.arange(slots, dtype=np.uint8), (len(row), 1))
            perm[np.arange(len(row)), first], perm[:, 0] = 0, first
        elif not keep.all():
            marks, row, perm = marks[keep], row[keep], perm[keep]
    return best


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def kinds(marks: np.ndarray, sizes: np.ndarray) -> list[int | None]:
    """A 64-bit digest of each set; none for empty ones."""
    ends = np.cumsum(sizes).tolist()
    return [xxhash.xxh3_64_intdigest(marks[b - n : b].tobytes()) - (1 << 63) if n else None for b, n in zip(ends, sizes.tolist(), strict=True)]


def sign_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the text), n_shingles, kind (of the set) and sig (SLOTS 32-bit values in a binary)."""
    schema = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                marks, sizes = shingle_sets(part.column(1).to_pylist())
                ends = np.cumsum(sizes)
                sigs: list[bytes | None] = []
                for a, b in _runs(sizes, 50_000):
                    found = signatures(marks[ends[a] - sizes[a] : ends[b - 1]], sizes[a:b])
                    short = ((found >> np.uint64(32)) * np.uint64(0x9E3779B1) ^ found).astype("<u4")
                    sigs += [x.tobytes() if n else None for x, n in zip(short, sizes[a:b].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(sizes), pa.array(kinds(marks, sizes), pa.int64()), pa.array(sigs, pa.binary())], ["doc_id", "digest", "n_shingles", "kind", "sig"])

    return docs.select(id_col, text_col, F.xxhash64(text_col)).mapInArrow(run, f"doc_id {schema}, digest long, n_shingles long, kind long, sig binary")


def bands(classes: DataFrame) -> DataFrame:
    """A row of bucket and kind for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _slots(batch.column(1)).reshape(batch.num_rows, -1, ROWS).astype(np.uint64)
            key = np.zeros(sig.shape[:2], np.uint64) + np.arange(sig.shape[1], dtype=np.uint64)
            for k in range(ROWS):
                key = mixed(key * ODD + sig[:, :, k])
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64).ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), sig.shape[1]))], ["bucket", "kind"])

    return classes.select("kind", "sig").mapInArrow(run, "bucket long, kind long")


def _slots(sigs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.to_pylist()), "<u4").reshape(len(sigs), SLOTS)


def alike_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of (a, b) whose signatures agree in enough slots to be verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array((_slots(batch.column(2)) == _slots(batch.column(3))).mean(1) >= LEAST))

    sigs = classes.select("kind", "sig")
    both = pairs.join(sigs.select(F.col("kind").alias("b"), F.col("sig").alias("y")), "b").join(sigs.select(F.col("kind").alias("a"), F.col("sig").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


class Forest:
    """Union-find over the members of a tile, in which members of one component are together from the start."""

    def __init__(self, labels: np.ndarray):
        names, place = np.unique(labels, return_inverse=True)
        self.root, self.place = list(range(len(names))), place.tolist()
        self.edges: list[tuple[int, int]] = []

    def find(self, k: int) -> int:
        root = self.root
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    def join(self, i: int, j: int) -> None:
        p, q = self.find(self.place[i]), self.find(self.place[j])
        if p != q:
            self.root[max(p, q)] = min(p, q)
            self.edges.append((i, j))

    def table(self, names: np.ndarray) -> pa.Table:
        ends = np.array(self.edges, np.int64).reshape(-1, 2)
        return pa.table({"u": pa.array(names[ends[:, 0]], pa.int64()), "v": pa.array(names[ends[:, 1]], pa.int64())})


def _tile(tile: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kinds and components of a tile's rows, and which of them are to meet which."""
    kind, label, at = tile["kind"].to_numpy(), tile["component"].to_numpy(), tile["tile"].to_numpy()
    return kind, label, np.flatnonzero(at == tile["lo"][0].as_py()), np.flatnonzero(at == tile["hi"][0].as_py())


def candidates(members: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges (u, v) between components that are alike by signature: in each tile of a bucket, a forest of them."""
    labelled = members.select("bucket", "kind").join(labels.withColumnRenamed("node", "kind"), "kind", "left").withColumn("component", F.coalesce("component", "kind"))
    several = labelled.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y")).filter("n > 2 and x < y").select("bucket", "n")
    rows = labelled.join(several, "bucket").join(classes.select("kind", "sig"), "kind")

    def run(tile: pa.Table) -> pa.Table:
        _, label, left, right = _tile(tile)
        sig, forest = _slots(tile["sig"].combine_chunks()), Forest(label)
        for i in left.tolist():
            others = right[label[right] != label[i]]
            for j in others[(sig[others] == sig[i]).mean(1) >= LEAST].tolist():
                forest.join(i, j)
        return forest.table(label)

    return tiled(rows, "bucket", "kind", TILE).groupBy("bucket", "lo", "hi").applyInArrow(run, "u long, v long").distinct()


def links_across(sets: DataFrame) -> DataFrame:
    """Links (u, v) between components within families, by full sets: in each tile, a forest of them.

    `sets` has family, kind, component and marks. A tile numbers its marks once, and each
    member then meets all others by one sum over their marks."""
    n = sets.groupBy("family").agg(F.count("*").alias("n"))

    def run(tile: pa.Table) -> pa.Table:
        kind, label, left, right = _tile(tile)
        marks = tile["marks"].combine_chunks()
        _, number = np.unique(marks.flatten().to_numpy(), return_inverse=True)
        sizes = marks.value_lengths().to_numpy().astype(np.int64)
        starts, forest = np.cumsum(sizes) - sizes, Forest(label)
        flag = np.zeros(number.max() + 1, np.int32)
        each = [number[a : a + b] for a, b in zip(starts.tolist(), sizes.tolist(), strict=True)]
        joined = np.concatenate([each[j] for j in right])
        cuts = np.cumsum(sizes[right]) - sizes[right]
        for i in left.tolist():
            if (label[right] == label[i]).all():
                continue
            flag[each[i]] = 1
            both = np.add.reduceat(flag[joined], cuts)
            flag[each[i]] = 0
            linked = (100 * both >= SIMILAR * (sizes[i] + sizes[right] - both)) & (label[right] != label[i])
            for j in right[linked].tolist():
                forest.join(i, j)
        return forest.table(kind)

    return tiled(sets.join(n, "family"), "family", "kind", TILE_SETS).groupBy("family", "lo", "hi").applyInArrow(run, "u long, v long")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """kind and marks (array<long>, sorted) of the classes in `wanted` (kind, doc_id of a member)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                marks, sizes = shingle_sets(part.column(1).to_pylist())
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                rows = pa.RecordBatch.from_arrays([pa.array(kinds(marks, sizes), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(marks.astype(np.int64)))], ["kind", "marks"])
                yield rows.filter(pc.fill_null(pc.equal(rows.column(0), part.column(2)), False))

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(small(wanted, BROADCAST_IDS), "doc_id")
    # Rows that repeat are one class.
    return texts.select("doc_id", "text", "kind").mapInArrow(run, "kind long, marks array<bigint>").dropDuplicates(["kind"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds to pairs of (a, b) whether their full sets are similar enough."""
    left, right = sets.select(F.col("kind").alias("a"), F.col("marks").alias("x")), sets.select(F.col("kind").alias("b"), F.col("marks").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    alike = F.lit(100) * both >= F.lit(SIMILAR) * (F.size("x") + F.size("y") - both)
    return pairs.join(right, "b").join(left, "a").select("a", "b", alike.alias("linked"))


def link_classes(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node and component of every class (kind, doc_id, sig) that is linked with another one."""
    found = bands(classes)
    shared = found.groupBy("bucket").agg(F.min("kind").alias("a"), F.count("*").alias("n")).filter("n > 1")
    members = cut(found.join(shared, "bucket").select("bucket", "kind", "a", "n"))
    pairs = cut(alike_pairs(members.filter("kind != a").select("a", F.col("kind").alias("b")).distinct(), classes))
    ends = pairs.select(F.col("a").alias("kind")).union(pairs.select(F.col("b").alias("kind"))).distinct()
    names = classes.select("kind", "doc_id")
    sets = cut(full_sets(docs, names.join(ends, "kind"), id_col, text_col))
    links = cut(verified(pairs, sets).filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))
    labels = components(links)
    # What the stars have left apart: components that are alike by signature are a family, all of whose members meet.
    near = cut(candidates(members.filter("n > 2"), classes, labels))
    if near.isEmpty():
        return labels
    families = components(near).withColumnRenamed("component", "family").withColumnRenamed("node", "component")
    labelled = names.join(labels.withColumnRenamed("node", "kind"), "kind", "left").withColumn("component", F.coalesce("component", "kind"))
    relatives = cut(labelled.join(families, "component"))
    sets = full_sets(docs, relatives.select("kind", "doc_id"), id_col, text_col)
    more = links_across(cut(relatives.select("kind", "component", "family").join(sets, "kind")))
    return components(links.union(cut(more)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, digest (of its text), n_shingles, component_id and kept."""
    signed = cut(sign_documents(docs, id_col, text_col))
    classes = cut(signed.filter("kind is not null and doc_id is not null").groupBy("kind").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig")))
    labels = link_classes(docs, classes, id_col, text_col)
    place = classes.select("kind", F.col("doc_id").alias("least")).join(labels.withColumnRenamed("node", "kind"), "kind", "left").withColumn("component", F.coalesce("component", "kind"))
    least = place.groupBy("component").agg(F.min("least").alias("component_id"))
    place = place.join(least, "component").select("kind", "component_id")
    rows = signed.select("doc_id", "digest", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("kind")).alias("kind"))
    linked = rows.filter("kind is not null").join(place, "kind").select("doc_id", "digest", "n_shingles", "component_id")
    alone = rows.filter("kind is null").select("doc_id", "digest", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` of which near_duplicates() keeps the document; of rows that repeat with words in them, one."""
    return with_free_names(docs, lambda docs: _without_duplicates(docs, id_col, text_col))


def _without_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    found = cut(near_duplicates(docs, id_col, text_col))
    key = [F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__digest")]
    keyed = docs.select("*", *key)
    gone = found.filter("not kept").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    kept = keyed.join(small(gone, BROADCAST_IDS), ["__id", "__digest"], "left_anti")
    again = found.filter("kept and n_shingles > 0 and doc_id is not null").groupBy(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).count().filter("count > 1").drop("count")
    if not again.isEmpty():
        again = small(again, BROADCAST_IDS)
        once = kept.join(again, ["__id", "__digest"], "left_semi").dropDuplicates(["__id", "__digest"])
        kept = kept.join(again, ["__id", "__digest"], "left_anti").unionByName(once)
    return kept.select(*docs.columns)
