"""Near-duplicate vectors by an epsilon grid order join, exact for every pair.

Unit vectors have cosine >= c exactly when they lie within eps = sqrt(2 - 2c). They are
projected on their leading principal directions, cut into grid cells of side eps and
sorted lexicographically by cell; the sorted sequence is cut into intervals (blocks)
with the bounding box of their projections and of the norms of what these leave. Interval
pairs are found recursively, from long intervals of intervals down to blocks, and within
a task on to intervals of some dozen rows: a pair whose boxes are more than eps apart
holds no link and is dropped with everything below it. What is left is compared in double
precision.

Equal vectors are one class with a count. A pair of blocks yields sums of links per
class and the edges of a spanning forest, never all its pairs.

Rows: a vector that is null, empty, zero, or holds a null or a value that is not finite
is linked with nothing and forms its own component; so do vectors of different length.
Repeated ids keep their rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm import common

COSINE = 0.9
#: Vectors the principal directions are fitted on, at most about this many. The fit
#: decides only how well distant blocks are skipped.
DIRECTIONS_SAMPLE = 20_000
#: Leading directions that make the grid order and bound a block, and sides of its box.
BOX_DIRECTIONS = 12
BOX_SIDES = BOX_DIRECTIONS + 1
BLOCK_ROWS = 2_048
#: Rows of the smallest intervals, compared or skipped as a whole.
STEP_ROWS = 16
FAN_OUT = 16
_NEAR_BORDER = 1e-9

_USABLE = (
    "{c} is not null and size({c}) > 0"
    " and forall({c}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    " and exists({c}, x -> x <> 0)"
)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _directions(classes: DataFrame, total: int) -> dict[int, np.ndarray]:
    """Leading principal directions for each vector length in a bounded sample."""
    share = 1 << 20
    cut = max(1, min(share, share * DIRECTIONS_SAMPLE // max(1, total)))
    rows = classes.where(F.pmod(F.xxhash64("vector"), F.lit(share)) < cut).select("vector").collect()
    by_size: dict[int, list] = {}
    for (vector,) in sorted(rows):
        by_size.setdefault(len(vector), []).append(vector)
    out = {}
    for size, vectors in by_size.items():
        unit = _unit(np.array(vectors))
        _, axes = np.linalg.eigh(unit.T @ unit)
        out[size] = axes[:, ::-1][:, :BOX_DIRECTIONS]
    return out


def _project(unit: np.ndarray, directions: dict[int, np.ndarray]) -> np.ndarray:
    """Coordinates on the directions, then the norm of the rest. As a rest differs from
    another by no less than their norms do, rows are at least as far apart as these
    points are."""
    axes = directions.get(unit.shape[1], np.eye(unit.shape[1])[:, :BOX_DIRECTIONS])
    at = unit @ axes
    return np.column_stack([at, np.linalg.norm(unit - at @ axes.T, axis=1)])


def _by_size(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the vectors of each length."""
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, flat[offsets[at][:, None] + np.arange(size)]


def _classes(vectors: DataFrame, column: str) -> DataFrame:
    """Distinct usable vectors, numbered, with how often each occurs."""
    usable = vectors.where(_USABLE.format(c=f"`{column}`"))
    counted = usable.groupBy(F.col(column).alias("vector")).agg(F.count("*").alias("copies"))
    return common.staged(counted.withColumn("cid", F.monotonically_increasing_id()), "classes")


def _ordered_blocks(classes: DataFrame, directions: dict[int, np.ndarray], total: int, eps: float, rows: int) -> DataFrame:
    """The classes in grid order, packed into blocks: part, seq, size, low, high (box),
    cids, copies and vectors as binary."""

    def locate(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("vector")
        cells: list = [None] * len(column)
        for at, matrix in _by_size(column):
            grid = np.floor(_project(_unit(matrix), directions)[:, :-1] / eps).astype(int)
            for k, cell in zip(at.tolist(), grid.tolist()):
                cells[k] = cell
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.diff(column.offsets.to_numpy()), pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
            names=[*batch.schema.names, "size", "cell"],
        )

    fields = [*classes.schema.fields, T.StructField("size", T.IntegerType()), T.StructField("cell", T.ArrayType(T.IntegerType()))]
    located = common.staged(common.map_batches(classes, locate, fields), "located")
    parts = max(1, math.ceil(total / (4 * rows)))
    ordered = located.repartitionByRange(parts, "size", "cell", "cid").sortWithinPartitions("size", "cell", "cid")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        left: list[pa.Table] = []

        def blocks(held: pa.Table, last: bool):
            while held.num_rows:
                size = held.column("size")[0].as_py()
                same = int(np.argmax(np.append(held.column("size").to_numpy() != size, True)))
                if same < rows and same == held.num_rows and not last:
                    break
                cut = held.slice(0, min(rows, same)).combine_chunks()
                held = held.slice(cut.num_rows)
                column = cut.column("vector").combine_chunks()
                column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
                matrix = next(_by_size(column))[1]
                at = _project(_unit(matrix), directions)
                yield (
                    size,
                    at.min(axis=0).tolist(),
                    at.max(axis=0).tolist(),
                    cut.column("cid").to_numpy().tobytes(),
                    cut.column("copies").to_numpy().tobytes(),
                    np.ascontiguousarray(matrix).tobytes(),
                )
            left[:] = [held]

        for batch in batches:
            made = list(blocks(pa.concat_tables([*left, pa.Table.from_batches([batch])]), False))
            if made:
                yield _block_batch(made, part, seq)
                seq += len(made)
        if left and left[0].num_rows:
            yield _block_batch(list(blocks(left[0], True)), part, seq)

    return common.staged(ordered.mapInArrow(pack, _BLOCK_SCHEMA), "blocks")


_BLOCK_SCHEMA = (
    "part int, seq int, size int, low array<double>, high array<double>, cids binary, copies binary, vectors binary"
)


def _block_batch(made: list[tuple], part: int, seq: int) -> pa.RecordBatch:
    size, low, high, cids, copies, vectors = zip(*made)
    boxes = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * len(made), pa.int32()),
            pa.array(range(seq, seq + len(made)), pa.int32()),
            pa.array(size, pa.int32()),
            pa.array(low, boxes),
            pa.array(high, boxes),
            *(pa.array(x, pa.binary()) for x in (cids, copies, vectors)),
        ],
        names=["part", "seq", "size", "low", "high", "cids", "copies", "vectors"],
    )


def _extreme(function: str, column: str) -> F.Column:
    """Element-wise minimum or maximum of the boxes of a group."""
    ends = [F.__dict__[function](F.get(column, F.lit(k))) for k in range(BOX_SIDES)]
    return F.array_compact(F.array(*ends))


def _interval_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs (a, b), a >= b, of block numbers whose boxes are close enough."""
    boxes = blocks.select("number", "size", "low", "high")
    levels = [common.staged(boxes.select("number", F.col("size").alias("lowest"), F.col("size").alias("highest"), "low", "high"), "level")]
    count = levels[0].count()
    while count > FAN_OUT:
        parents = levels[-1].groupBy(F.floor(F.col("number") / FAN_OUT).alias("number")).agg(
            F.min("lowest").alias("lowest"),
            F.max("highest").alias("highest"),
            _extreme("min", "low").alias("low"),
            _extreme("max", "high").alias("high"),
        )
        levels.append(common.staged(parents, "level"))
        count = -(-count // FAN_OUT)

    def side(level: DataFrame, name: str) -> DataFrame:
        return level.select(*(F.col(c).alias(f"{name}_{c}") for c in level.columns), F.floor(F.col("number") / FAN_OUT).alias(f"{name}_parent"))

    top = levels.pop()
    # At most FAN_OUT intervals are left at the top.
    pairs = top.select(F.col("number").alias("a_parent"), F.explode(F.sequence(F.lit(0).cast("long"), "number")).alias("b_parent"))
    if not levels:
        a, b = side(top, "a").drop("a_parent"), side(top, "b").drop("b_parent")
        found = pairs.join(a, F.col("a_parent") == F.col("a_number")).join(b, F.col("b_parent") == F.col("b_number"))
        return found.where(_boxes_meet(eps)).select(F.col("a_number").alias("a"), F.col("b_number").alias("b"))
    while levels:
        level = levels.pop()
        found = pairs.join(side(level, "a"), "a_parent").join(side(level, "b"), "b_parent")
        found = found.where("a_number >= b_number").where(_boxes_meet(eps))
        pairs = common.staged(found.select(F.col("a_number").alias("a_parent"), F.col("b_number").alias("b_parent")), "pairs")
    return pairs.select(F.col("a_parent").alias("a"), F.col("b_parent").alias("b"))


def _boxes_meet(eps: float) -> F.Column:
    """Whether intervals a and b share a vector length and have boxes within eps.
    Where an interval holds several lengths its box covers their common directions."""
    gaps = (
        "aggregate(zip_with(zip_with(a_low, b_high, (x, y) -> x - y), zip_with(b_low, a_high, (x, y) -> x - y),"
        " (x, y) -> greatest(x, y, 0D)), 0D, (s, g) -> s + coalesce(g, 0D) * coalesce(g, 0D))"
    )
    return F.expr(
        f"a_lowest <= b_highest and b_lowest <= a_highest and {gaps} <= {eps * eps + _NEAR_BORDER!r}"
    )


def _meeting(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Which intervals of ``STEP_ROWS`` rows have boxes within eps: a row for each of a's,
    a column for each of b's."""

    def box(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(0, len(points), STEP_ROWS)
        return np.minimum.reduceat(points, at), np.maximum.reduceat(points, at)

    (a_low, a_high), (b_low, b_high) = box(a), box(b)
    apart = np.zeros((len(a_low), len(b_low)))
    for k in range(a.shape[1]):
        gap = np.maximum(np.subtract.outer(a_low[:, k], b_high[:, k]), np.subtract.outer(b_low[:, k], a_high[:, k]).T)
        apart += np.maximum(gap, 0) ** 2
    return apart <= eps * eps + _NEAR_BORDER


def compare_blocks(
    left: np.ndarray, right: np.ndarray, same: bool, cosine: float, directions: dict[int, np.ndarray]
) -> tuple[np.ndarray, int]:
    """Matrix of links between two blocks of vectors, and how many of its entries were
    compared; a vector is not linked with itself."""
    a, b = _unit(left), _unit(right)
    meeting = _meeting(_project(a, directions), _project(b, directions), math.sqrt(2 - 2 * cosine))
    links, compared = np.zeros((len(a), len(b)), bool), 0
    for step in np.flatnonzero(meeting.any(axis=1)):
        rows = slice(step * STEP_ROWS, (step + 1) * STEP_ROWS)
        near = np.flatnonzero(np.repeat(meeting[step], STEP_ROWS)[: len(b)])
        dots = a[rows] @ (b if len(near) == len(b) else b[near]).T
        compared += dots.size
        found = dots >= cosine
        for i, j in zip(*np.nonzero(np.abs(dots - cosine) < _NEAR_BORDER)):
            x, y = left[rows][i].astype(np.float64), right[near[j]].astype(np.float64)
            found[i, j] = float(x @ y) / math.sqrt(float(x @ x) * float(y @ y)) >= cosine
        links[rows, near] = found
    if same:
        np.fill_diagonal(links, False)
    return links, compared


def _forest(links: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Spanning edges of the linked rows and columns; columns are numbered after rows
    unless both sides are one block."""
    n = len(links)
    rows, columns = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
    if same:
        few = links[np.ix_(rows, rows)]
        forest = common.local_forest(len(rows), lambda i, rest: rest[few[i, rest]])
        return [(int(rows[a]), int(rows[b])) for a, b in forest]
    few = links[np.ix_(rows, columns)]
    names = np.concatenate([rows, n + columns])
    split = len(rows)

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        if i < split:
            other = rest[rest >= split]
            return other[few[i, other - split]]
        other = rest[rest < split]
        return other[few[other, i - split]]

    forest = common.local_forest(len(names), near)
    return [(int(names[a]), int(names[b])) for a, b in forest]


def _compare(
    blocks: DataFrame, pairs: DataFrame, cosine: float, kind: type, directions: dict[int, np.ndarray]
) -> DataFrame:
    """Per block pair: rows (a, b, null) for forest edges, (a, null, n) for link sums, and
    (null, null, n), the pairs of rows compared."""

    def side(name: str) -> DataFrame:
        return blocks.select(
            F.col("number").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("size", "cids", "copies", "vectors"))
        )

    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows_a, rows_b, rows_n = [], [], []
        for row in range(batch.num_rows):
            get = lambda c: batch.column(c)[row].as_py()
            same = get("a") == get("b")
            if get("a_size") != get("b_size"):
                continue
            ids = [np.frombuffer(get(f"{s}_cids"), np.int64) for s in "ab"]
            copies = [np.frombuffer(get(f"{s}_copies"), np.int64) for s in "ab"]
            data = [np.frombuffer(get(f"{s}_vectors"), kind).reshape(len(i), -1) for s, i in zip("ab", ids)]
            links, compared = compare_blocks(data[0], data[1], same, cosine, directions)
            rows_a.append(pa.nulls(1, pa.int64()))
            rows_b.append(pa.nulls(1, pa.int64()))
            rows_n.append(pa.array([(compared - len(links)) // 2 if same else compared], pa.int64()))
            if not links.any():
                continue
            names = ids[0] if same else np.concatenate(ids)
            edges = np.array(_forest(links, same), np.int64).reshape(-1, 2)
            sums = [(ids[0], links @ copies[1])] + ([] if same else [(ids[1], copies[0] @ links)])
            rows_a.append(pa.array(names[edges[:, 0]]))
            rows_b.append(pa.array(names[edges[:, 1]]))
            rows_n.append(pa.nulls(len(edges), pa.int64()))
            for name, total in sums:
                some = total > 0
                rows_a.append(pa.array(name[some]))
                rows_b.append(pa.nulls(int(some.sum()), pa.int64()))
                rows_n.append(pa.array(total[some].astype(np.int64)))
        if not rows_a:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(rows_a), pa.concat_arrays(rows_b), pa.concat_arrays(rows_n)], names=["a", "b", "n"]
        )

    fields = [T.StructField(c, T.LongType()) for c in ("a", "b", "n")]
    return common.staged(common.map_batches(joined, work, fields), "links")


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with their place in the whole sequence: the blocks of earlier partitions
    (one number per partition on the driver) plus the place in the own one."""
    counts = sorted((r[0], r[1]) for r in blocks.groupBy("part").agg(F.count("*")).collect())
    base, total = [], 0
    for part, count in counts:
        base.append((part, total))
        total += count
    offsets = blocks.sparkSession.createDataFrame(base, "part int, base long")
    return blocks.join(offsets, "part").withColumn("number", F.col("base") + F.col("seq")).drop("base")


def _links(classes: DataFrame, total: int, cosine: float, kind: type, rows: int) -> DataFrame:
    """What ``_compare`` finds among all classes."""
    eps = math.sqrt(2 - 2 * cosine)
    directions = _directions(classes, total)
    blocks = _numbered(_ordered_blocks(classes, directions, total, eps, rows))
    return _compare(blocks, _interval_pairs(blocks, eps), cosine, kind, directions)


def compared_share(vectors: DataFrame, column: str = "embedding", cosine: float = COSINE, rows: int = BLOCK_ROWS) -> float:
    """Share of all pairs of different vectors that the join compares; it skips the rest."""
    kind = np.float64 if isinstance(vectors.schema[column].dataType.elementType, T.DoubleType) else np.float32
    classes = _classes(vectors, column)
    total = classes.count()
    compared = _links(classes, total, cosine, kind, rows).where("a is null").agg(F.sum("n")).first()[0]
    return (compared or 0) / max(1, total * (total - 1) // 2)


def groups(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = COSINE, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Per vector: its key, ``n_links`` (other vectors within the cosine),
    ``component_id`` (smallest key reachable) and ``kept``."""
    kind = np.float64 if isinstance(vectors.schema[column].dataType.elementType, T.DoubleType) else np.float32
    vectors = vectors.select(F.col(key), F.col(column).alias("vector"))
    classes = _classes(vectors, "vector")
    found = _links(classes, classes.count(), cosine, kind, rows)
    roots = common.components(found.where("b is not null").select("a", "b"))
    sums = found.where("a is not null and n is not null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("others"))
    known = (
        classes.join(sums, "cid", "left")
        .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        .select(
            "vector",
            (F.coalesce("others", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "cid").alias("root"),
        )
    )
    usable = F.expr(_USABLE.format(c="vector"))
    rows_known = common.staged(vectors.where(usable).join(known, "vector").select(key, "n_links", "root"), "known")
    names = rows_known.groupBy("root").agg(F.min(key).alias("component_id"))
    linked = rows_known.join(names, "root").select(key, "n_links", "component_id")
    alone = vectors.where(~usable | usable.isNull()).select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col(key) == F.col("component_id"))
