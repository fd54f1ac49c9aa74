"""Near-duplicate embeddings by an epsilon grid order join.

Vectors are scaled to length 1, where cosine >= t means a distance of at most
eps = sqrt(2 - 2 t). They are rotated to principal dimensions (fitted on at
most ``FIT_ROWS`` vectors; any rotation gives the same links) and sorted by
their grid cells of side eps on the leading ``GRID`` dimensions. The sorted
sequence is cut into blocks of ``BLOCK`` vectors. Pairs of intervals of blocks are
split level by level on DataFrames of bounding boxes, and a pair whose boxes
are further apart than eps is skipped with all that it holds; inside a pair
of blocks a task goes on in the same way down to ``LEAF`` vectors, which are compared in
double precision. An interval pair that lies in a ball of half the linking angle links
as a whole without comparing pairs.

Equal vectors are one class before the join. A task returns, for each vector, how many
others it links with and a spanning forest of the links, so rows out follow
the vectors and not the pairs.

Defined cases: vectors that are null, empty or all zero, or hold null or
non-finite components link with nothing; vectors of different length never link;
repeated ids are rows of one node, each with its own links; null ids count
as one largest id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import arrow_rows, id_order, stored
from orderloom.llm.components import connected_components

COSINE = 0.95
GRID = 8             # leading principal dimensions of the grid and of the block boxes
FIT_ROWS = 2048      # documented bound of the sample that the rotation is fitted on
BLOCK, LEAF = 4096, 256
FAN = 8              # children of an interval
SLACK = 1e-9


def is_usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotations(classes: DataFrame) -> dict[int, np.ndarray]:
    """A rotation to principal dimensions for each vector length in the sample."""
    rows = classes.orderBy(F.xxhash64("embedding"), "rep").select("embedding").limit(FIT_ROWS).collect()
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r[0]), []).append(r[0])
    out = {}
    for size, vectors in by_size.items():
        _, axes = np.linalg.eigh(np.cov(unit(np.array(vectors)).T.reshape(size, -1), bias=True).reshape(size, size))
        out[size] = axes[:, ::-1].copy()
    return out


def _rotated(x: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    return x @ axes[x.shape[1]] if x.shape[1] in axes else x


def _lead(x: np.ndarray) -> np.ndarray:
    """The leading GRID dimensions, filled with zeros."""
    return np.pad(x[:, :GRID], ((0, 0), (0, max(0, GRID - x.shape[1]))))


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(v, np.float64) for v in column.to_pylist()]


def ego_sequence(classes: DataFrame, axes: dict[int, np.ndarray], eps: float, block: int = BLOCK) -> DataFrame:
    """(block, pos, size, rep, n, embedding): classes in epsilon grid order, cut into blocks."""
    shared = classes.sparkSession.sparkContext.broadcast(axes)

    def cells(batches):
        for batch in batches:
            found = [np.floor(_lead(_rotated(unit(v[None]), shared.value))[0] / eps).astype(np.int32) for v in _vectors(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=["rep", "n", "embedding", "cells"])

    def number(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = np.arange(seq, seq + batch.num_rows)
            seq += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(at), part, np.int32)), pa.array(at)],
                                             names=["rep", "n", "embedding", "part", "seq"])

    kind = classes.schema["embedding"].dataType.simpleString()
    placed = classes.select("rep", "n", "embedding").mapInArrow(cells, f"rep bigint, n bigint, embedding {kind}, cells array<int>")
    ordered = (placed.withColumn("size", F.size("embedding")).repartitionByRange("size", "cells", "rep")
               .sortWithinPartitions("size", "cells", "rep").select("rep", "n", "embedding"))
    numbered = stored(ordered.mapInArrow(number, f"rep bigint, n bigint, embedding {kind}, part int, seq bigint"), "ego-sequence")
    per = numbered.groupBy("part").count()  # one row per partition
    before = per.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    pos = F.col("before") + F.col("seq")
    return numbered.join(F.broadcast(before), "part").select(
        F.floor(pos / block).cast("bigint").alias("block"), pos.alias("pos"), "rep", "n", "embedding")


def block_table(sequence: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """One row per block: reps, counts, vectors, the range of vector lengths, the box on the leading dimensions."""
    shared = sequence.sparkSession.sparkContext.broadcast(axes)
    wide = sequence.schema["embedding"].dataType.elementType.simpleString() == "double"
    boxes = "".join(f", lo{k} double, hi{k} double" for k in range(GRID))

    def build(batches):
        held, rows = None, []

        def close():
            if rows:
                reps, ns, vectors = zip(*rows)
                lead = np.concatenate([_lead(_rotated(unit(v[None].astype(np.float64)), shared.value)) for v in vectors])
                box = [x for k in range(GRID) for x in (lead[:, k].min(), lead[:, k].max())]
                sizes = [len(v) for v in vectors]
                out = [held, np.array(reps, "<i8").tobytes(), np.array(ns, "<i8").tobytes(), np.array(sizes, "<i4").tobytes(),
                       b"".join(v.tobytes() for v in vectors), min(sizes), max(sizes), *box]
                rows.clear()
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in out], names=names)

        names = ["block", "reps", "ns", "sizes", "vectors", "size_lo", "size_hi", *[f"{e}{k}" for k in range(GRID) for e in ("lo", "hi")]]
        for batch in batches:
            for block, rep, n, v in zip(*(c.to_pylist() for c in batch.columns)):
                if block != held:
                    yield from close()
                    held = block
                rows.append((rep, n, np.array(v, np.float64 if wide else np.float32)))
        yield from close()

    return (sequence.repartition("block").sortWithinPartitions("block", "pos").select("block", "rep", "n", "embedding")
            .mapInArrow(build, "block bigint, reps binary, ns binary, sizes binary, vectors binary, size_lo bigint, size_hi bigint" + boxes))


def _near(a: str, b: str, eps: float) -> Column:
    """Whether two boxes (columns under the prefixes a and b) may hold vectors within eps."""
    square = F.lit(0.0)
    for k in range(GRID):
        gap = F.greatest(F.lit(0.0), F.col(f"{a}.lo{k}") - F.col(f"{b}.hi{k}"), F.col(f"{b}.lo{k}") - F.col(f"{a}.hi{k}"))
        square = square + gap * gap
    lengths = (F.col(f"{a}.size_lo") <= F.col(f"{b}.size_hi")) & (F.col(f"{b}.size_lo") <= F.col(f"{a}.size_hi"))
    return lengths & (square <= (eps + SLACK) ** 2)


def near_block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(a, b), a <= b: pairs of blocks whose boxes are within eps, by splitting pairs of intervals."""
    boxes = ["size_lo", "size_hi", *[f"{e}{k}" for k in range(GRID) for e in ("lo", "hi")]]
    levels = [blocks.select(F.col("block").alias("node"), *boxes)]
    while levels[-1].count() > 1:
        wider = [(F.min if c.endswith("_lo") or c.startswith("lo") else F.max)(c).alias(c) for c in boxes]
        levels.append(stored(levels[-1].groupBy(F.floor(F.col("node") / FAN).cast("bigint").alias("node")).agg(*wider), "intervals"))
    pairs = levels.pop().select(F.col("node").alias("a"), F.col("node").alias("b"))
    child = lambda c: F.explode(F.sequence(F.col(c) * FAN, F.col(c) * FAN + FAN - 1)).alias(c)
    while levels:
        level = levels.pop()
        split = pairs.select(child("a"), "b").select("a", child("b")).where("a <= b")
        one, two = (level.select(F.col("node").alias(c), F.struct(*boxes).alias(f"box_{c}")) for c in "ab")
        pairs = stored(split.join(one, "a").join(two, "b").where(_near("box_a", "box_b", eps)).select("a", "b"), "interval-pairs")
    return pairs


class Interval:
    """A block inside a task: unit vectors in grid order and the boxes of its leaves."""

    def __init__(self, pos, reps, ns, x, rotated, leaf=LEAF):
        self.pos, self.reps, self.ns, self.x, self.leaf = pos, reps, ns, x, leaf
        starts = np.arange(0, len(x), leaf)
        self.lo, self.hi = np.minimum.reduceat(rotated, starts), np.maximum.reduceat(rotated, starts)


def _intervals(row: dict, axes: dict, wide: bool, block: int, leaf: int) -> dict[int, Interval]:
    """By vector length; nearly always one."""
    reps, ns = np.frombuffer(row["reps"], "<i8"), np.frombuffer(row["ns"], "<i8")
    sizes, flat = np.frombuffer(row["sizes"], "<i4"), np.frombuffer(row["vectors"], np.float64 if wide else np.float32)
    begin = np.cumsum(sizes) - sizes
    out = {}
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        x = unit(flat[begin[own][:, None] + np.arange(size)])
        out[int(size)] = Interval(row["block"] * block + own, reps[own], ns[own], x, _rotated(x, axes), leaf)
    return out


def join_intervals(a: Interval, b: Interval, cosine: float) -> tuple[dict, list]:
    """Linked counts by position, and a spanning forest of the links, between two blocks (or within one)."""
    eps2 = (math.sqrt(2 - 2 * cosine) + SLACK) ** 2
    half = math.cos(math.acos(cosine) / 2 - SLACK) if cosine > -1 else -1.0
    same = a is b
    degree_a = np.zeros(len(a.x), np.int64)
    degree_b = degree_a if same else np.zeros(len(b.x), np.int64)
    forest, parent = [], {}

    def root(v):
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v

    def link(i, j):
        p, q = root(int(a.reps[i])), root(int(b.reps[j]))
        if p != q:
            parent[p] = q
            forest.append((int(a.reps[i]), int(b.reps[j])))

    def join(a0, a1, b0, b1):
        """Leaves a0..a1 of one against b0..b1 of the other."""
        lo_a, hi_a = a.lo[a0:a1].min(axis=0), a.hi[a0:a1].max(axis=0)
        lo_b, hi_b = b.lo[b0:b1].min(axis=0), b.hi[b0:b1].max(axis=0)
        gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
        if gap @ gap > eps2:
            return
        rows_a, rows_b = slice(a0 * a.leaf, min(a1 * a.leaf, len(a.x))), slice(b0 * b.leaf, min(b1 * b.leaf, len(b.x)))
        x, y = a.x[rows_a], b.x[rows_b]
        own = same and a0 == b0
        center = x.sum(axis=0) + y.sum(axis=0)
        norm = math.sqrt(center @ center)
        if norm and min((x @ center).min(), (y @ center).min()) / norm >= half:
            degree_a[rows_a] += b.ns[rows_b].sum() - (a.ns[rows_a] if own else 0)
            if not own:
                degree_b[rows_b] += a.ns[rows_a].sum()
            for i in range(rows_a.start, rows_a.stop):
                link(i, rows_b.start)
            for j in range(rows_b.start, rows_b.stop):
                link(rows_a.start, j)
            return
        if a1 - a0 == 1 and b1 - b0 == 1:
            near = x @ y.T >= cosine
            if own:
                np.fill_diagonal(near, False)
            if near.any():
                degree_a[rows_a] += near @ b.ns[rows_b]
                if not own:
                    degree_b[rows_b] += near.T @ a.ns[rows_a]
                while near.any():  # links between what is not yet one tree; each turn halves the trees at least
                    for i in np.flatnonzero(near.any(axis=1)):
                        link(rows_a.start + i, rows_b.start + int(near[i].argmax()))
                    trees = [np.array([root(int(v)) for v in interval.reps[rows]]) for interval, rows in ((a, rows_a), (b, rows_b))]
                    near &= trees[0][:, None] != trees[1][None, :]
            return
        if own:
            m = (a0 + a1) // 2
            join(a0, m, a0, m)
            join(a0, m, m, a1)
            join(m, a1, m, a1)
        elif a1 - a0 >= b1 - b0:
            join(a0, (a0 + a1) // 2, b0, b1)
            join((a0 + a1) // 2, a1, b0, b1)
        else:
            join(a0, a1, b0, (b0 + b1) // 2)
            join(a0, a1, (b0 + b1) // 2, b1)

    join(0, len(a.lo), 0, len(b.lo))
    degrees: dict = {}
    for interval, degree in ((a, degree_a),) if same else ((a, degree_a), (b, degree_b)):
        degrees.update((int(interval.pos[i]), int(degree[i])) for i in np.flatnonzero(degree))
    return degrees, forest


def joined_blocks(blocks: DataFrame, pairs: DataFrame, axes: dict, cosine: float, wide: bool,
                  block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """(a, b, n): rows with b are links of a spanning forest, rows without it add n to the links of the vector at position a."""
    shared = blocks.sparkSession.sparkContext.broadcast(axes)
    names = ["block", "reps", "ns", "sizes", "vectors"]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                one = _intervals(row["x"], shared.value, wide, block, leaf)
                two = one if row["a"] == row["b"] else _intervals(row["y"], shared.value, wide, block, leaf)
                for size in one.keys() & two.keys():
                    degrees, forest = join_intervals(one[size], two[size], cosine)
                    if degrees:
                        a = [*degrees, *[x for x, _ in forest]]
                        b = [*[None] * len(degrees), *[y for _, y in forest]]
                        n = [*degrees.values(), *[0] * len(forest)]
                        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (a, b, n)], names=["a", "b", "n"])

    data = blocks.select("block", F.struct(*names).alias("data"))
    both = (pairs.join(data.toDF("a", "x"), "a")
            .join(data.toDF("b", "y"), "b").select("a", "b", "x", "y"))
    both = both.repartition(F.xxhash64("a", "b"))
    return both.mapInArrow(run, "a bigint, b bigint, n bigint")


def near_duplicates(vectors: DataFrame, *, cosine: float = COSINE, id_col: str = "vec_id",
                    vector_col: str = "embedding", block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """(id, n_links, component): a row for each row of ``vectors``; a null id is ``NULL_ID``."""
    eps = math.sqrt(2 - 2 * cosine)
    rows = vectors.select(id_order(F.col(id_col)).alias("id"), F.col(vector_col).alias("embedding"))
    usable = F.when(is_usable(F.col("embedding")), F.col("embedding"))
    name = lambda v: F.when(F.col(v).isNotNull(), F.struct(F.xxhash64(v), F.xxhash64(F.lit(17), v)))
    named = rows.select("id", usable.alias("embedding")).withColumn("name", name("embedding"))
    classes = stored(named.where("name IS NOT NULL").groupBy("name").agg(
        F.min("id").alias("rep"), F.count("*").alias("n"), F.first("embedding").alias("embedding")), "vector-classes")
    axes = rotations(classes)
    wide = vectors.schema[vector_col].dataType.elementType.simpleString() == "double"
    sequence = stored(ego_sequence(classes, axes, eps, block), "ego-order")
    blocks = stored(block_table(sequence, axes), "ego-blocks")
    pairs = near_block_pairs(blocks, eps)
    with arrow_rows(vectors.sparkSession, 2):  # a row holds two blocks
        found = stored(joined_blocks(blocks, pairs, axes, cosine, wide, block, leaf), "ego-links")
    copies = named.join(classes.select("name", "rep", "n"), "name").select("id", "name", "rep", "n")
    links = found.where("b IS NOT NULL").select("a", "b").union(copies.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    component = connected_components(links).toDF("id", "component")
    others = found.where("b IS NULL").groupBy(F.col("a").alias("pos")).agg(F.sum("n").alias("others"))
    counted = sequence.select("pos", "n", name("embedding").alias("name")).join(others, "pos", "left").select(
        "name", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return (named.select("id", "name").join(counted, "name", "left").join(component, "id", "left")
            .select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component")))
