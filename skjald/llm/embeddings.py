"""Near-duplicate vectors by cross-polytope hashing.

Each vector is turned by fast Hadamard rotations (random signs and Walsh-Hadamard
transforms, three times), and its hash is the axis that it is nearest to, with its sign.
A table's bucket joins HASHES such axes. Multiprobe: a vector also goes to the buckets of
its next best axes, PROBES of them in each table. Vectors that share a bucket of a
table are candidates, and those are verified by their cosine in double precision.

Equal vectors form a class, of which one stands for all. Buckets are split into tiles,
every pair of which meets in a task of bounded size; a pair is counted only in the first
of the tables in which it meets. Tiles return sums for each vector and a spanning forest
of their links, so that a group of n near copies makes no n * n rows.

Cases: null or zero vectors, those with null or non-finite components and those of no
components link with nothing and are components of their own; vectors of different
lengths never link; vectors of any length are hashed, very long ones too; a cosine that
equals the threshold links, and of equal components the first axis is the nearer; equal ids are vectors of their own, in one component; null
ids count as vectors but give no component's name; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skjald.llm.common import cut, tiled
from skjald.llm.graph import components

COSINE = 0.95
TABLES, HASHES, PROBES = 8, 3, 4
TILE, BIN = 512, 1024
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, whose length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
        x = x.reshape(n, d)
    return x


def buckets(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """Keys of shape (rows, tables, probes) of unit vectors."""
    n, d = x.shape
    wide = 1 << max(1, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, wide - d)))
    rng = np.random.default_rng([seed, d])
    keys = np.empty((n, tables, probes), np.int64)
    each = np.arange(n)
    for table in range(tables):
        best, second, loss = [], [], []
        for _ in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], wide)) / np.sqrt(wide)
            size = np.abs(y)
            two = np.argpartition(-size, 1, axis=1)[:, :2]
            swap = size[each, two[:, 0]] < size[each, two[:, 1]]
            two[swap] = two[swap, ::-1]
            codes = two * 2 + (np.take_along_axis(y, two, 1) < 0)
            best.append(codes[:, 0])
            second.append(codes[:, 1])
            loss.append(np.subtract(*np.take_along_axis(size, two, 1).T))
        best, second, loss = np.stack(best, 1), np.stack(second, 1), np.stack(loss, 1)
        # Probes in order of what they lose: subsets of the hashes that take their second axis.
        subsets = np.array([[s >> k & 1 for k in range(hashes)] for s in range(1 << hashes)], bool)
        order = np.argsort(loss @ subsets.T, axis=1, kind="stable")[:, :probes]
        for probe in range(probes):
            codes = np.where(subsets[order[:, probe]], second, best)
            key = np.full(n, table, np.int64)
            for k in range(hashes):
                key = key * (2 * wide) + codes[:, k]
            keys[:, table, probe] = key
    return keys


def classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """kind (64-bit digest), vec_id (smallest), copies, x (double components) of the distinct vectors that can link."""
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), x.alias("x"))
    return rows.filter(usable("x")).groupBy("x").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")).withColumn("kind", digest("x"))


def usable(x: str) -> F.Column:
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(fine & F.exists(x, lambda v: v != 0), F.lit(False))


def digest(x: str) -> F.Column:
    """Of the components; both zeros are one."""
    return F.xxhash64(F.transform(x, lambda v: v + F.lit(0.0)))


def unit(rows: pa.Array) -> np.ndarray:
    """Unit vectors of lists that are equally long."""
    x = rows.flatten().to_numpy().reshape(len(rows), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def hashed(found: DataFrame) -> DataFrame:
    """The classes with d (components) and keys (the buckets of all tables and their probes)."""

    def run(batches):
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column("x")])
            for d in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == d)))
                for at in range(0, part.num_rows, 2000):
                    some = part.slice(at, 2000)
                    keys = buckets(unit(some.column("x"))).reshape(some.num_rows, -1)
                    ends = pa.array(np.arange(some.num_rows + 1) * keys.shape[1], pa.int32())
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(np.full(len(keys), d), pa.int32()), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], [*some.schema.names, "d", "keys"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return found.mapInArrow(run, f"{kinds}, d int, keys array<long>")


def tile_links(tile: pa.Table) -> pa.Table:
    """Links that meet in no earlier table, of one tile of a bucket or of several small buckets: sums by vector, and a forest of edges."""
    tile = tile.take(pa.compute.sort_indices(tile, [("bucket", "ascending"), ("kind", "ascending")]))
    kind, at, copies, bucket = (tile[c].to_numpy() for c in ("kind", "tile", "copies", "bucket"))
    x = unit(tile["x"].combine_chunks())
    keys = tile["keys"].combine_chunks().flatten().to_numpy().reshape(len(x), TABLES, PROBES)
    lo, hi = tile["lo"][0].as_py(), tile["hi"][0].as_py()
    n_links, root, edges = np.zeros(len(kind)), list(range(len(kind))), []

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    for first, last in zip(cuts, cuts[1:], strict=False):
        left, right = first + np.flatnonzero(at[first:last] == lo), first + np.flatnonzero(at[first:last] == hi)
        linked = x[left] @ x[right].T >= COSINE
        if lo == hi:
            linked = np.triu(linked, 1)
        i, j = np.nonzero(linked)
        if not len(i):
            continue
        i, j = left[i], right[j]
        mine = int(np.argmax((keys[first] == bucket[first]).any(1)))
        fresh = np.ones(len(i), bool)
        for table in range(mine):
            fresh &= ~(keys[i, table][:, :, None] == keys[j, table][:, None, :]).any((1, 2))
        # In its own table a pair may share several probes: the smallest shared bucket counts.
        same = keys[i, mine][:, :, None] == keys[j, mine][:, None, :]
        fresh &= np.where(same, keys[i, mine][:, :, None], np.iinfo(np.int64).max).min((1, 2)) == bucket[first]
        i, j = i[fresh], j[fresh]
        np.add.at(n_links, i, copies[j])
        np.add.at(n_links, j, copies[i])
        for u, v in zip(i.tolist(), j.tolist(), strict=True):
            p, q = find(u), find(v)
            if p != q:
                root[max(p, q)] = min(p, q)
                edges.append((u, v))
    some = np.flatnonzero(n_links)
    u, v = np.array(edges, np.int64).reshape(-1, 2).T
    nothing = pa.nulls(len(some), pa.int64())
    return pa.table(
        {
            "kind": pa.array(np.concatenate([kind[some], kind[u]])),
            "n_links": pa.array(np.concatenate([n_links[some], np.zeros(len(u))]).astype(np.int64)),
            "other": pa.concat_arrays([nothing, pa.array(kind[v], pa.int64())]),
        }
    )


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each vector: vec_id, n_links, component_id and kept."""
    found = cut(hashed(classes(vectors, id_col, vector_col)))
    members = found.select("kind", "d", F.explode("keys").alias("bucket"))
    shared = cut(members.groupBy("bucket", "d").agg(F.count("*").alias("n")).filter("n > 1"))
    # The keys go with the vector, so that no task hashes it again.
    rows = members.join(shared, ["bucket", "d"]).join(found.select("kind", "x", "copies", "keys"), "kind")
    # Buckets of one tile share tasks, some BIN rows in each group.
    bins = max(1, -(-(shared.filter(F.col("n") <= TILE).agg(F.sum("n")).first()[0] or 0) // BIN))
    tiles = tiled(rows, "bucket", "kind", TILE).withColumn("bin", F.when(F.col("n") <= TILE, -1 - F.pmod(F.xxhash64("bucket"), F.lit(bins))).otherwise(F.col("bucket"))).groupBy("bin", "d", "lo", "hi")
    links = cut(tiles.applyInArrow(tile_links, "kind long, n_links long, other long"))
    labels = components(links.filter("other is not null").select(F.col("kind").alias("u"), F.col("other").alias("v")))
    sums = links.groupBy("kind").agg(F.sum("n_links").alias("near"))
    place = found.select("kind", "copies", F.col("vec_id").alias("least")).join(sums, "kind", "left").join(labels.withColumnRenamed("node", "kind"), "kind", "left").withColumn("component", F.coalesce("component", "kind"))
    least = place.groupBy("component").agg(F.min("least").alias("component_id"))
    place = place.join(least, "component").select("kind", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), "component_id")
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), x.alias("x")).select("vec_id", F.when(usable("x"), digest("x")).alias("kind"))
    linked = rows.filter("kind is not null").join(place, "kind").select("vec_id", "n_links", "component_id")
    alone = rows.filter("kind is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
