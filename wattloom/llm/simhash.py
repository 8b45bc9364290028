"""Near duplicates by SimHash, found exactly through a vantage-point tree.

Fingerprints that differ in at most ``RADIUS`` of 64 bits are linked. A tree of vantage
points, fitted on a bounded sample, cuts the space into shards: at each node the points
within some Hamming distance of the vantage point go inside, the others outside. By the
triangle inequality a pair across that border has its outer point within the border
plus the radius (its inner point beyond the border less the radius), so copying that
thin rim over the border brings every close pair together in some shard. Shards are
compared in parallel, block by block.

Rows: a null or wordless text has fingerprint zero, linked like any other. Documents of
one fingerprint are one class, whatever their number. A null ``doc_id`` keeps its row
and never names a component while the component has another id. Columns other than the
two that are read are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm import common

RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
#: Fingerprints the tree is fitted on, at most about this many.
TREE_SAMPLE = 50_000
#: Members (own and copied) a shard should have: this times the square root of the
#: number of fingerprints. Smaller shards compare fewer pairs but copy more points: each
#: halving of a shard copies about a quarter of its points.
SHARD_FACTOR = 48
#: A slice of a shard's comparison holds at most this many pairs.
SLICE_PAIRS = 4_000_000

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the three-word shingles of a text, repeats counted."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE_WORDS))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], np.uint64)
    octets = hashes.byteswap().view(np.uint8).reshape(-1, 8)
    ones = np.empty(64, np.int64)
    for k in range(8):
        ones[8 * k : 8 * k + 8] = np.bincount(octets[:, k], minlength=256) @ _BITS
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, kept: list[str], text: str = "text") -> DataFrame:
    """The kept columns of every document and its ``fingerprint`` as a signed 64-bit
    integer."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(t) for t in batch.column(text).to_pylist()]
        prints = np.array(values, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(prints)], names=[*kept, "fingerprint"])

    fields = [*(common.renamed(docs.schema[c], c) for c in kept), T.StructField("fingerprint", T.LongType())]
    return common.map_batches(docs.select(*dict.fromkeys([*kept, text])), run, fields)


def _distance(points: np.ndarray, to) -> np.ndarray:
    return np.bitwise_count(points ^ to).astype(np.int16)


class Tree:
    """Vantage points by node; a negative child -1-s is shard s."""

    def __init__(self, sample: np.ndarray, scale: float, members: int, radius: int = RADIUS):
        self.radius = radius
        self.vantage: list[int] = []
        self.border: list[int] = []
        self.rim_inside: list[bool] = []  # the outer rim is copied inside, else the inner rim outside
        self.inside: list[int] = []
        self.outside: list[int] = []
        self.shards = 0
        waiting = [(sample, None, None)]
        while waiting:
            points, parent, children = waiting.pop()
            split = self._split(points) if len(points) * scale > members and len(points) >= 16 else None
            if split is None:
                node = -1 - self.shards
                self.shards += 1
            else:
                node = len(self.vantage)
                vantage, border, rim_inside, inner, outer = split
                self.vantage.append(vantage)
                self.border.append(border)
                self.rim_inside.append(rim_inside)
                self.inside.append(0)
                self.outside.append(0)
                waiting += [(inner, node, self.inside), (outer, node, self.outside)]
            if children is not None:
                children[parent] = node
            else:
                self.root = node

    def _split(self, points: np.ndarray):
        """The vantage point and border that leave the fewest pairs to compare."""
        best = None
        for vantage in points[:: max(1, len(points) // 6)][:6]:
            apart = _distance(points, vantage)
            below = np.cumsum(np.bincount(apart, minlength=65 + self.radius))
            n = len(points)
            for border in range(64):
                inner = below[border]
                if not 0 < inner < n:
                    continue
                over = below[border + self.radius] - inner
                under = inner - (below[border - self.radius] if border >= self.radius else 0)
                for rim_inside, cost in (
                    (True, (inner + over) ** 2 + (n - inner) ** 2),
                    (False, inner**2 + (n - inner + under) ** 2),
                ):
                    if best is None or cost < best[0]:
                        best = (cost, int(vantage), border, rim_inside)
        if best is None or best[0] > 0.9 * len(points) ** 2:
            return None
        _, vantage, border, rim_inside = best
        apart = _distance(points, np.uint64(vantage))
        inner = apart <= border + (self.radius if rim_inside else 0)
        outer = apart > border - (0 if rim_inside else self.radius)
        return vantage, border, rim_inside, points[inner], points[outer]

    def shards_of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``points`` and the shards they belong or are copied to."""
        at = np.arange(len(points))
        node = np.full(len(points), self.root)
        vantage, border = np.array(self.vantage, np.uint64), np.array(self.border, np.int16)
        rim_inside = np.array(self.rim_inside, bool)
        inside, outside = np.array(self.inside, np.int64), np.array(self.outside, np.int64)
        done_at, done_shard = [at[node < 0]], [-1 - node[node < 0]]
        at, node = at[node >= 0], node[node >= 0]
        while len(at):
            apart = _distance(points[at], vantage[node])
            inner = apart <= border[node] + np.where(rim_inside[node], self.radius, 0)
            outer = apart > border[node] - np.where(rim_inside[node], 0, self.radius)
            at, node = np.concatenate([at[inner], at[outer]]), np.concatenate([inside[node[inner]], outside[node[outer]]])
            done_at.append(at[node < 0])
            done_shard.append(-1 - node[node < 0])
            at, node = at[node >= 0], node[node >= 0]
        return np.concatenate(done_at), np.concatenate(done_shard)


def close_edges(points: np.ndarray, block: np.ndarray, across: bool, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that connect whatever a shard's comparison connects (positions).

    ``across``: the points come from two blocks, and only pairs between them count as
    found here; which points have any partner is established first, in slices.
    """
    left, right = (np.flatnonzero(block == b) for b in (block.min(), block.max())) if across else (np.arange(len(points)),) * 2
    linked = np.zeros(len(points), bool)
    step = max(1, min(256, SLICE_PAIRS // max(1, len(right))))
    for begin in range(0, len(left), step):
        rows = left[begin : begin + step]
        columns = right if across else right[begin:]
        near = np.bitwise_count(points[rows][:, None] ^ points[columns][None, :]) <= radius
        if not across:
            near[np.arange(len(rows)), np.arange(len(rows))] = False
        linked[rows[near.any(axis=1)]] = True
        linked[columns[near.any(axis=0)]] = True
    some = np.flatnonzero(linked)
    few = points[some]
    forest = common.local_forest(len(few), lambda i, rest: rest[np.bitwise_count(few[rest] ^ few[i]) <= radius])
    return [(int(some[a]), int(some[b])) for a, b in forest]


def _sample(classes: DataFrame, total: int) -> np.ndarray:
    share = 1 << 20
    cut = max(1, min(share, share * TREE_SAMPLE // max(1, total)))
    rows = classes.where(F.pmod(F.xxhash64("fingerprint"), F.lit(share)) < cut).select("fingerprint").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64)).view(np.uint64)


def links(classes: DataFrame, members: int | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect the same components as
    all pairs within the radius. ``classes``: one row per distinct ``fingerprint``."""
    total = classes.count()
    members = members or max(64, int(SHARD_FACTOR * total**0.5))
    block = 2 * members
    sample = _sample(classes, total)
    np.random.default_rng(0).shuffle(sample)
    tree = Tree(sample, total / max(1, len(sample)), members)

    def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at, shard = tree.shards_of(points.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(points[at]), pa.array(shard)], names=["fingerprint", "shard"])

    fields = [T.StructField("fingerprint", T.LongType()), T.StructField("shard", T.LongType())]
    members_df = common.staged(common.map_batches(classes.select("fingerprint"), assign, fields), "vantage")
    # A shard that stays large (a dense neighbourhood) is compared block against block.
    # At most one row per shard of the tree, whose size the sample bounds.
    blocks = members_df.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(float(block))).alias("blocks"))
    placed = (
        members_df.join(F.broadcast(blocks), "shard")
        .withColumn("block", F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "shard",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "fingerprint",
        )
    )

    def compare(group: pa.Table) -> pa.Table:
        points = group.column("fingerprint").to_numpy().view(np.uint64)
        across = group.column("low")[0].as_py() != group.column("high")[0].as_py()
        edges = close_edges(points, group.column("block").to_numpy(), across)
        pairs = points.view(np.int64)[np.array(edges, np.int64).reshape(-1, 2)]
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return placed.groupBy("shard", "low", "high").applyInArrow(compare, "a long, b long")


def _roots(prints: DataFrame) -> DataFrame:
    """(fingerprint, root) of every fingerprint; one root per component."""
    classes = common.staged(prints.select("fingerprint").distinct(), "classes")
    roots = common.components(links(classes)).withColumnRenamed("node", "fingerprint")
    return classes.join(roots, "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its key, ``fingerprint`` (long) and ``component_id``, the smallest
    key among the documents reachable by links, its own included."""
    prints = common.staged(fingerprints(docs, [key], text), "prints")
    first = prints.groupBy("fingerprint").agg(F.min(key).alias("first"))
    rooted = first.join(_roots(prints), "fingerprint")
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(key, "fingerprint", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each group kept: that of the smallest key, of the
    smallest text hash among equal keys. A row without a key stays only for a group in
    which no row has one. Of equal rows one stays."""
    hidden, back = common.sheltered(docs, key, text)
    marked = hidden.withColumn("_print", F.xxhash64(text))
    prints = common.staged(fingerprints(marked, [key, "_print"], text), "prints")
    order = F.struct(F.col(key).isNull().alias("missing"), F.col(key).alias("key"), F.col("_print").alias("print"))
    first = prints.groupBy("fingerprint").agg(F.min(order).alias("first"))
    best = first.join(_roots(prints), "fingerprint").groupBy("root").agg(F.min("first").alias("first"))
    kept = best.select(F.col("first.key").alias("_key"), F.col("first.print").alias("_kept"))
    joined = marked.join(kept, (marked["_print"] == kept["_kept"]) & marked[key].eqNullSafe(kept["_key"]), "left_semi")
    return back(joined.dropDuplicates([key, "_print"]))


def hexadecimal(column) -> F.Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")
