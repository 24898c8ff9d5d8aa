"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one kept in each component.

Centres are fitted on a bounded sample; every vector goes to its nearest centre (its home) and visits the next nearest, or
in exact mode all cells that may hold a partner.
Vectors of a cell are compared with all that live in it or visit it, in blocks, so that a cell of any size is shared out
over many tasks.  A block pair gives the number of links of each vector and a spanning forest of its links, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.components import components
from lexforge.llm.staging import staged, unstage
from lexforge.llm.texts import map_batches

#: Bound of the sample that fits the centres, in vectors and in MB; vectors aimed at in a cell; most centres; cells visited.
SAMPLE_VECTORS, SAMPLE_MB, CELL, MAX_CELLS, PROBES = 16_384, 64, 256, 4096, 6
#: Vectors in a block of a cell.
BLOCK = 2048


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k unit centres; an empty cell takes the vector that is farthest from its own centre."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=k, replace=False)].copy()
    for _ in range(rounds):
        near = x @ centres.T
        home = near.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        size = np.linalg.norm(sums, axis=1)
        for c in np.flatnonzero(size < 1e-9):
            sums[c] = x[int(near[np.arange(len(x)), home].argmin())]
            size[c] = 1.0
        centres = sums / size[:, None]
    return centres


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision; powers of two keep very large and small ones in range."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    flat = np.ldexp(flat, -np.frexp(np.abs(flat).max(axis=1, initial=0.0))[1][:, None])
    return flat / np.linalg.norm(flat, axis=1)[:, None]


def _visits(x: np.ndarray, c: np.ndarray, least: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home of each vector, and rows and cells of all visits, by row.

    The PROBES nearest cells; with ``least``, all cells whose border with the vector's own is within half the distance of
    two vectors of that cosine: of two such vectors in different cells, one at least is that near to their common border.
    """
    near = x @ c.T
    home = near.argmax(axis=1)
    if least is None:
        m = min(PROBES, len(c))
        cells = np.argpartition(-near, m - 1, axis=1)[:, :m] if m < len(c) else np.tile(np.arange(m), (len(x), 1))
        return home, np.repeat(np.arange(len(x)), m), cells.reshape(-1)
    apart = np.sqrt(np.maximum(2 - 2 * (c[home] @ c.T), 0))
    border = near[np.arange(len(x)), home][:, None] - near
    rows, cells = np.nonzero(border <= (math.sqrt(max(0.0, 2 - 2 * least)) / 2 + 1e-6) * apart + 1e-9)
    return home, rows, cells


def _cells(batches: Iterator[pa.RecordBatch], centres: dict[int, np.ndarray], least: float | None = None) -> Iterator[pa.RecordBatch]:
    """(node, weight, vector) to one row for each cell: (dim, cell, home, probes, node, weight, vector); probes: all cells of the vector."""
    for batch in batches:
        sizes = np.array([len(v) for v in batch.column(2)], dtype=np.int64) if batch.num_rows else np.empty(0, dtype=np.int64)
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            part = batch.take(pa.array(at))
            x = _unit(part.column(2))
            home, rows, cells = _visits(x, centres[int(d)], least)
            counts = np.bincount(rows, minlength=len(x))
            first = np.cumsum(counts) - counts
            # the list of its row's cells beside every visit
            ends = np.concatenate([[0], np.cumsum(counts[rows])])
            places = np.arange(ends[-1]) - np.repeat(ends[:-1] - first[rows], counts[rows])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cells[places].astype(np.int32)))
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), d), pa.int32()), pa.array(cells.astype(np.int32)), pa.array(home[rows].astype(np.int32)), lists, part.column(0).take(take), part.column(1).take(take), part.column(2).take(take)], names=["dim", "cell", "home", "probes", "node", "weight", "vector"])


def _padded(lists: pa.ListArray) -> np.ndarray:
    """A list column as a matrix, with -1 after the end of a list."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(sizes), int(sizes.max(initial=1))), -1, dtype=np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _hang(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Joins the trees of all pairs p, q; every label is the smallest place of its tree, and its own label."""
    while True:
        a, b = label[p], label[q]
        apart = a != b
        if not apart.any():
            return label
        p, q, a, b = p[apart], q[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _products(rows: pa.Table, i: int, j: int, cell: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, links of each found here, and the node that each hangs on in this block pair's forest."""
    node = rows["node"].to_numpy()
    order = np.argsort(node, kind="stable")
    rows = rows.take(pa.array(order)).combine_chunks()
    node, weight, home, block = (rows[c].to_numpy() for c in ("node", "weight", "home", "block"))
    x = _unit(rows["vector"].chunk(0))
    probes = _padded(rows["probes"].chunk(0))
    one = np.flatnonzero(block == i)
    two = np.flatnonzero(block == j)
    links, label = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
    native = home == cell
    for a in range(0, len(one), 256):
        mine = one[a : a + 256]
        hit = (x[mine] @ x[two].T) >= least
        hit &= native[mine][:, None] | native[two][None, :]
        if i == j:
            hit &= two[None, :] > mine[:, None]
        p, q = np.nonzero(hit)
        p, q = mine[p], two[q]
        # a pair that lives in two cells counts in the smaller one, if it meets there
        host, guest = np.where(native[p], p, q), np.where(native[p], q, p)
        meets = (probes[host] == home[guest][:, None]).any(axis=1)
        counts = (native[p] & native[q]) | (cell < home[guest]) | ~meets
        p, q = p[counts], q[counts]
        np.add.at(links, p, weight[q])
        np.add.at(links, q, weight[p])
        label = _hang(label, p, q)
    keep = np.flatnonzero(links)
    return node[keep], links[keep], node[label[keep]]


def _compare(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows by (dim, cell, i, j); holds one block pair at a time."""
    held: list[pa.RecordBatch] = []
    at: tuple | None = None

    def close() -> pa.RecordBatch:
        node, links, root = _products(pa.Table.from_batches(held), at[2], at[3], at[1], least)
        return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(links, pa.int64()), pa.array(root, pa.int64())], names=["node", "links", "root"])

    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if a == b:
                continue
            key = tuple(int(v) for v in keys[a])
            if at is not None and key != at:
                yield close()
                held = []
            at = key
            held.append(batch.slice(a, b - a))
    if held:
        yield close()


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95, cells: int | None = None, exact: bool = False) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) for each row of ``df``.

    Vectors of equal length whose cosine, in double precision, is at least ``least`` and that meet in a cell are linked;
    equal vectors are one node and linked with each other.  With ``exact``, all such vectors meet; otherwise each visits
    PROBES cells, which misses links between cells that are no near neighbours.  Ties between cells go to the first.  A null or zero vector, or one with null or non-finite
    components, links with nothing.  Rows that repeat an id count as vectors of their own and are one node.  An empty
    table gives an empty one; other columns are not read.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(vector_col).cast("array<double>")
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), finite.alias("sound"), v.alias("vector"))
    key = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")]
    sound = rows.filter("sound and vec_id is not null").select("vec_id", "vector", *key)
    nodes = staged(sound.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("vector").alias("vector")), "vectors")
    sizes = {r["d"]: r["n"] for r in nodes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect()}  # one row for each length
    centres = {}
    for d, count in sizes.items():
        most = max(1, min(SAMPLE_VECTORS, (SAMPLE_MB << 20) // (8 * d)))
        k = max(1, min(cells or math.ceil(count / CELL), MAX_CELLS, most // 4, count))
        sample = nodes.filter(F.size("vector") == d).orderBy("h1", "h2").limit(most).select("vector").toArrow()["vector"].combine_chunks()
        x = _unit(sample.chunk(0) if isinstance(sample, pa.ChunkedArray) else sample)
        centres[d] = spherical_kmeans(x, min(k, len(x)))
    shared = spark.sparkContext.broadcast(centres)  # MAX_CELLS centres for each length at most
    in_cells = staged(map_batches(nodes.select("node", "weight", "vector"), lambda it: _cells(it, shared.value, least if exact else None), "dim int, cell int, home int, probes array<int>, node bigint, weight bigint, vector array<double>", 1024), "cells")
    blocks = F.broadcast(in_cells.groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))  # a row for each cell
    dealt = in_cells.join(blocks, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("*", other).select("dim", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "home", "probes", "node", "weight", "vector")
    found = map_batches(dealt.repartition(n, "dim", "cell", "i", "j").sortWithinPartitions("dim", "cell", "i", "j"), lambda it: _compare(it, least), "node bigint, links bigint, root bigint", 1024)
    found = staged(found, "found")
    unstage(in_cells)
    comps = components(found.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("h1", "h2", "node", "weight").join(links, "node", "left").join(comps, "node", "left")
    named = named.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    linked = sound.select("vec_id", "h1", "h2").join(named, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not (sound and vec_id is not null)").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
