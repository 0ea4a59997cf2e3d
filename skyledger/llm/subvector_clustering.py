"""Centroid clustering over dictionaries of subvectors.

Vectors are read once. A task gathers some thousand of them to a chunk, turns components into integers, cuts the dimensions into
blocks of ``width`` and replaces every subvector by its code in the chunk's dictionary of distinct subvectors of that block: nothing
is lost. Every later step works on the encoded chunks, which lie in the shared folder. A round computes the exact squared distances
of each distinct subvector to the centroids once, and a vector's distance is the sum of those that its codes name. The new sums
come from counts of codes too, so no round restores a vector.

A dictionary belongs to its chunk, so its size is bounded by the chunk whatever the corpus holds, and no dictionary has to be
joined or broadcast. What tasks return per round is one row per centroid; the centroids, a fixed number of vectors, are all that
passes through the driver. A vector that a third of all rows repeat is one code per block, not a hot key.

Defined cases: vectors that are null, of another length, or with a null or non-finite component are left out; a null id hashes as
the empty text and comes back as null; repeated rows are vectors of their own; of equal hashes the smaller vector comes first;
with fewer vectors than centroids there are as many centroids as vectors; an empty table gives no rows. Components beyond 2^27 in
size count as 2^27, so that every distance fits 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

LIMIT = 1 << 27  # largest component, so that sums of squares stay below 2^63
CHUNK = 1 << 13  # vectors of a chunk
ENCODED = "ids binary, known binary, codes binary, subvectors binary, starts binary, seeds array<struct<hash:string,vector:array<int>>>"


@dataclass(frozen=True)
class Chunk:
    """Encoded vectors: ``codes[i, b]`` names a row of ``subvectors``; the rows of block ``b`` begin at ``starts[b]``."""
    codes: np.ndarray
    subvectors: np.ndarray
    starts: np.ndarray

    def restored(self) -> np.ndarray:
        """The vectors again."""
        return self.subvectors[self.codes].reshape(len(self.codes), -1)


def dictionary_encoded(vectors: np.ndarray, width: int) -> Chunk:
    """Codes and distinct subvectors of integer vectors whose length is a multiple of ``width``."""
    codes, parts, starts = [], [], [0]
    for low in range(0, vectors.shape[1], width):
        distinct, code = np.unique(vectors[:, low:low + width], axis=0, return_inverse=True)
        codes.append(code.reshape(-1) + starts[-1])
        parts.append(distinct)
        starts.append(starts[-1] + len(distinct))
    return Chunk(np.stack(codes, axis=1).astype(np.int32), np.concatenate(parts), np.array(starts, dtype=np.int32))


def distances(chunk: Chunk, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of every vector to every centroid: one sum over the blocks of what the dictionary's rows have."""
    width = chunk.subvectors.shape[1]
    partial = np.empty((len(chunk.subvectors), len(centroids)), dtype=np.int64)
    for block, (low, high) in enumerate(zip(chunk.starts, chunk.starts[1:], strict=False)):
        gap = chunk.subvectors[low:high, None, :].astype(np.int64) - centroids[None, :, block * width:(block + 1) * width]
        partial[low:high] = (gap * gap).sum(axis=2)
    total = np.zeros((len(chunk.codes), len(centroids)), dtype=np.int64)
    for block in range(chunk.codes.shape[1]):
        total += partial[chunk.codes[:, block]]
    return total


def cluster_sums(chunk: Chunk, cluster: np.ndarray, k: int) -> np.ndarray:
    """Componentwise sums of every cluster's vectors, from how often each code occurs in it."""
    size, blocks = len(chunk.subvectors), chunk.codes.shape[1]
    counts = np.bincount((cluster[:, None].astype(np.int64) * size + chunk.codes).ravel(), minlength=k * size).reshape(k, size)
    ends = list(zip(chunk.starts, chunk.starts[1:], strict=False))
    return np.concatenate([counts[:, low:high] @ chunk.subvectors[low:high].astype(np.int64) for low, high in ends[:blocks]], axis=1)


def integers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors in an array column of doubles, and their components as integers."""
    places = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dims), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    finite = np.isfinite(flat).all(axis=1)
    with np.errstate(over="ignore"):
        return places[finite], np.clip(np.floor(flat[finite] * scale), -LIMIT, LIMIT).astype(np.int32)


def encoded(vectors: DataFrame, k: int, seed: str, dims: int, scale: int, width: int, chunk: int, id_col: str, vector_col: str) -> DataFrame:
    """The chunks of all usable vectors; each lists its ``k`` vectors of smallest hash as candidates to start from."""
    if dims % width:
        raise ValueError(f"blocks of {width} do not divide {dims} dimensions")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))

    def packed(ids: np.ndarray, known: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        coded = dictionary_encoded(values, width)
        hashes = [hashlib.sha256(f"{seed}:{i if k_ else ''}".encode()).hexdigest() for i, k_ in zip(ids.tolist(), known.tolist(), strict=True)]
        # Sorting hashes alone finds all that may be among the first k; equal ones are kept beyond k.
        order = sorted(range(len(ids)), key=hashes.__getitem__)
        last = hashes[order[min(k, len(order)) - 1]]
        seeds = sorted((hashes[i], values[i].tolist()) for i in order if hashes[i] <= last)[:k]
        columns = [[ids.tobytes()], [np.packbits(known).tobytes()], [coded.codes.tobytes()], [coded.subvectors.tobytes()],
                   [coded.starts.tobytes()], [[{"hash": h, "vector": v} for h, v in seeds]]]
        kinds = [pa.binary()] * 5 + [pa.list_(pa.struct([("hash", pa.string()), ("vector", pa.list_(pa.int32()))]))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                          names=["ids", "known", "codes", "subvectors", "starts", "seeds"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            places, values = integers(batch.column(1), dims, scale)
            ids = batch.column(0).take(pa.array(places))
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            for low in range(0, len(places), chunk):
                part = slice(low, low + chunk)
                held.append((ids[part], known[part], values[part]))
                size += len(ids[part])
                if size >= chunk:
                    yield packed(*map(np.concatenate, zip(*held, strict=True)))
                    held, size = [], 0
        if size:
            yield packed(*map(np.concatenate, zip(*held, strict=True)))

    return stored(rows.mapInArrow(run, ENCODED), "subvectors")


def chunks_of(batches: Iterator[pa.RecordBatch], width: int, dims: int) -> Iterator[tuple[pa.RecordBatch, int, Chunk]]:
    for batch in batches:
        for row in range(batch.num_rows):
            cell = lambda name: np.frombuffer(batch.column(name)[row].as_py(), dtype=np.int32)  # noqa: E731, B023
            yield batch, row, Chunk(cell("codes").reshape(-1, dims // width), cell("subvectors").reshape(-1, width), cell("starts"))


def first_centroids(chunks: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors of smallest hash."""
    first = chunks.select(F.explode("seeds").alias("seed")).select("seed.*").orderBy("hash", "vector").limit(k).collect()
    return np.array([r.vector for r in first], dtype=np.int64)


def summed(chunks: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    """Per centroid ``(cluster, at, value)``: at -1 the number of its vectors, at -2 the sum of their distances, else the sum of a component."""
    k, dims = centroids.shape

    def run(batches):
        sums = np.zeros((k, dims + 2), dtype=np.int64)
        for _, _, chunk in chunks_of(batches, width, dims):
            table = distances(chunk, centroids)
            cluster = table.argmin(axis=1)
            sums[:, :dims] += cluster_sums(chunk, cluster, k)
            sums[:, dims] += np.bincount(cluster, minlength=k)
            least = table.min(axis=1)
            sums[:, dims + 1] += [least[cluster == c].sum() for c in range(k)]
        used = np.flatnonzero(sums[:, dims])
        ats = np.concatenate((np.arange(dims), [-1, -2]))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, dims + 2), pa.int32()), pa.array(np.tile(ats, len(used)), pa.int32()),
                                          pa.array(sums[used].ravel(), pa.int64())], names=["cluster", "at", "value"])

    rows = chunks.select("codes", "subvectors", "starts").mapInArrow(run, "cluster int, at int, value long")
    return rows.groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))


def collected(sums: DataFrame, k: int, dims: int) -> list[list[int]]:
    """The sums as ``k`` lists: components, number of vectors, distance; at most ``k * (dims + 2)`` numbers."""
    table = [[0] * (dims + 2) for _ in range(k)]
    for row in sums.collect():
        table[row.cluster][row.at if row.at >= 0 else dims - 1 - row.at] = int(row.value)
    return table


def moved(centroids: np.ndarray, table: list[list[int]]) -> np.ndarray:
    """The floor of the mean for every centroid that has vectors; the others stay."""
    dims = centroids.shape[1]
    return np.array([[s // row[dims] for s in row[:dims]] if row[dims] else old.tolist() for old, row in zip(centroids, table, strict=True)],
                    dtype=np.int64)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: str = "1", dims: int = 64, scale: int = 64, width: int = 2,
            chunk: int = CHUNK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Lloyd's rounds on integer vectors: ``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per usable vector.

    A component ``x`` is ``floor(scale * x)``. Centroids start as the ``k`` vectors whose ``sha256("<seed>:<id>")`` is smallest.
    Distances are squared and exact, of equal ones the centroid of smaller number is nearest, and a new component is the floor
    of the mean. ``inertia`` is null where it exceeds 64 bits.
    """
    chunks = encoded(vectors, k, seed, dims, scale, width, chunk, id_col, vector_col)
    columns = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = first_centroids(chunks, k)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], columns)
    for _ in range(rounds):
        centroids = moved(centroids, collected(summed(chunks, centroids, width), len(centroids), dims))
    inertias = [row[dims + 1] for row in collected(summed(chunks, centroids, width), len(centroids), dims)]
    fits = lambda value: value if value < 1 << 63 else None
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    per_cluster, whole = pa.array([fits(x) for x in inertias], pa.int64()), fits(sum(inertias))

    def run(batches):
        for batch, row, coded in chunks_of(batches, width, dims):
            table = distances(coded, centroids)
            nearest = table.argmin(axis=1)
            ids = np.frombuffer(batch.column("ids")[row].as_py(), dtype=np.int64)
            known = np.unpackbits(np.frombuffer(batch.column("known")[row].as_py(), dtype=np.uint8))[:len(ids)].astype(bool)
            at = pa.array(nearest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=~known), pa.array(nearest, pa.int32()), pa.array(table[np.arange(len(ids)), nearest]), per_cluster.take(at),
                 pa.array([whole] * len(ids), pa.int64()), pa.array(digests).take(at)],
                names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return chunks.select("ids", "known", "codes", "subvectors", "starts").mapInArrow(run, columns)
