"""A Merkle manifest of a dataset: every row a leaf, one tree a source, one tree over the sources.

Nodes carry nested-interval labels: a node covers the leaves of ranks [low, high) of its tree, a
leaf [r, r + 1). A node's parent is the node one level up whose interval contains its own, and its
siblings are what is left of the parent's interval without its own.

* Ranks come from `ranks.ranked`: a source of any size is spread over many tasks.
* Up: the nodes of `BAND` levels meet in the bucket low div 3^(end of the band), at most 3^BAND
  base nodes; each bucket gives its inner nodes, among them one base node of the next band.
* Down: a bucket of each band, from the highest to the lowest, holds its base nodes, its inner
  nodes and the path from its top to the root, joined by bucket. Base nodes find their ancestors
  by containment and their siblings by the difference of intervals.

All groups are bounded by 3^BAND base nodes and the height of the tree, whatever the input; there
are log3(n) / BAND rounds, each over 3^BAND times fewer rows than the one before.

`build` gives the manifest itself, a table of nodes; `prove` gives each row its path of siblings,
with which anybody who knows the root can check the row (`fold`).

Cases: nulls are written `-` and differ from empty texts; rows without an id come first in their
source; equal ids of a source are ordered by their leaf, and repeated rows are leaves of their own;
a null source is a source, and the first one; a lone leaf is its tree's root and has no siblings;
texts of any length are hashed whole; an empty table has no nodes and no proofs. Only the named
fields are hashed. Carried columns travel in one struct, so their names clash with nothing inside;
`prove` refuses a carried column named as one of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flagstone.llm.ranks import ranked
from flagstone.sources.scratch import staged

FANOUT = 3
BAND = 6  # levels handled at once; a bucket has at most FANOUT ** BAND base nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = ("tree", "leaves", "level", "low", "high", "digest")
NODE_SCHEMA = "tree string, leaves long, level int, low long, high long, digest string"
STEP = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])
PATH = T.ArrayType(STEP)


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value behind its length in bytes, or a dash for null, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(changed: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS) -> Column:
    """The leaf of a row; `changed` stands in for some of its columns."""
    changed = changed or {}
    return digest(*[field(changed.get(c, F.col(c))) for c in fields])


@dataclass(frozen=True)
class Manifest:
    """`leaves`: rows with tree, leaves (of the tree), low, high, digest. `nodes`: all inner nodes
    with level besides. `height`: levels above the leaves of the highest tree."""

    leaves: DataFrame
    nodes: DataFrame
    height: int

    @property
    def bands(self) -> int:
        return max(1, -(-self.height // BAND))

    @property
    def roots(self) -> DataFrame:
        """tree, leaves and digest of each tree's root: its only node that covers all leaves."""
        all_nodes = self.leaves.select("tree", "leaves", "low", "high", "digest").unionByName(
            self.nodes.drop("level")
        )
        whole = (F.col("low") == 0) & (F.col("high") == F.col("leaves"))
        return all_nodes.where(whole).select("tree", "leaves", "digest")


def _bucket(band: int) -> Column:
    return F.expr(f"low div {FANOUT ** (BAND * (band + 1))}")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _grow(band: int) -> Callable[[pa.Table], pa.Table]:
    bottom, top = BAND * band, BAND * (band + 1)
    return lambda table: _nodes_above(table, bottom, top)


def _nodes_above(table: pa.Table, bottom: int, top: int) -> pa.Table:
    """All nodes above the base nodes of a bucket, up to level `top`. Above a node that covers its
    whole tree nothing is built."""
    leaves = table.column("leaves")[0].as_py()
    order = np.argsort(table.column("low").to_numpy())
    low = table.column("low").to_numpy()[order]
    high = table.column("high").to_numpy()[order]
    hashes = [table.column("digest")[i].as_py() for i in order.tolist()]
    out: dict[str, list] = {"level": [], "low": [], "high": [], "digest": []}
    for level in range(bottom + 1, top + 1):
        if FANOUT ** (level - 1) >= leaves:
            break
        first = np.flatnonzero(np.diff(low // FANOUT**level, prepend=-1))
        last = np.append(first[1:], len(low))
        hashes = [_sha("".join(hashes[a:b])) for a, b in zip(first.tolist(), last.tolist())]
        low, high = low[first], high[last - 1]
        out["level"] += [level] * len(low)
        out["low"] += low.tolist()
        out["high"] += high.tolist()
        out["digest"] += hashes
    n = len(out["low"])
    return pa.table(
        [
            pa.array([table.column("tree")[0].as_py()] * n, pa.string()),
            pa.array([leaves] * n, pa.int64()),
            pa.array(out["level"], pa.int32()),
            pa.array(out["low"], pa.int64()),
            pa.array(out["high"], pa.int64()),
            pa.array(out["digest"], pa.string()),
        ],
        names=list(NODE),
    )


def build(rows: DataFrame) -> Manifest:
    """The trees of rows (tree, key, digest, other columns): one a tree, leaves by key and digest."""
    leaves = ranked(rows, ["tree"], ["key", "digest"], "low", "leaves").drop("key")
    leaves = staged(leaves.withColumn("high", F.col("low") + 1), "leaves")
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    height = 0
    while FANOUT**height < most:
        height += 1
    base = leaves.select("tree", "leaves", "low", "high", "digest")
    nodes = leaves.sparkSession.createDataFrame([], NODE_SCHEMA)
    for band in range(-(-height // BAND)):
        grown = base.withColumn("bucket", _bucket(band)).groupBy("tree", "bucket")
        grown = staged(grown.applyInArrow(_grow(band), NODE_SCHEMA), "nodes")
        base = grown.where(F.col("level") == BAND * (band + 1))
        nodes = nodes.unionByName(grown)
    return Manifest(leaves, nodes, height)


def _descend(band: int, keep: list[str]) -> Callable[[pa.Table], pa.Table]:
    bottom, top = BAND * band, BAND * (band + 1)
    return lambda table: _paths_below(table, bottom, top, keep)


def _paths_below(table: pa.Table, bottom: int, top: int, keep: list[str]) -> pa.Table:
    """Paths of the base nodes of a bucket: siblings up to the bucket's top, then the path above."""
    kind = table.column("level").to_numpy()
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy(zero_copy_only=False)
    hashes = table.column("digest").to_pylist()
    over = int(np.flatnonzero(kind == -1)[0])  # the row from above, one a bucket
    above = [(s["left"], s["right"]) for s in table.column("path")[over].as_py()]
    base = np.flatnonzero(kind == bottom)
    base = base[np.argsort(low[base])]
    steps: list[list[tuple[str, str]]] = [[] for _ in base]
    children, at = base, np.arange(len(base))  # at: each base node's ancestor among the children
    for level in range(bottom + 1, top + 1):
        parents = np.flatnonzero(kind == level)
        if not len(parents):
            break
        parents = parents[np.argsort(low[parents])]
        # Containment: the last parent that begins no later than the child; it ends no earlier.
        up = np.searchsorted(low[parents], low[children], "right") - 1
        # The parent's interval without the child's own: what is before it and what is after it.
        begin = np.searchsorted(low[children], low[parents][up]).tolist()
        end = np.searchsorted(low[children], high[parents][up]).tolist()
        names = [hashes[i] for i in children.tolist()]
        step = [
            ("".join(names[a:i]), "".join(names[i + 1 : b])) for i, (a, b) in enumerate(zip(begin, end))
        ]
        for row, i in zip(steps, at.tolist()):
            row.append(step[i])
        children, at = parents, up[at]
    sizes = [len(row) + len(above) for row in steps]
    flat = [s for row in steps for s in (*row, *above)]
    pairs = pa.StructArray.from_arrays(
        [pa.array([a for a, _ in flat], pa.string()), pa.array([b for _, b in flat], pa.string())],
        names=["left", "right"],
    )
    offsets = np.append(0, np.cumsum(sizes, dtype=np.int64)).astype(np.int32)
    rows = table.select(keep).take(pa.array(base)).combine_chunks()
    for name in ("subroot", "root"):
        rows = rows.append_column(name, pa.array([table.column(name)[over].as_py()] * len(base), pa.string()))
    return rows.append_column("path", pa.ListArray.from_arrays(pa.array(offsets), pairs))


def paths(manifest: Manifest, above: DataFrame) -> DataFrame:
    """The leaves with subroot, root and their path, given (tree, leaves, subroot, root, path) of
    each tree's root."""
    nodes, over = manifest.nodes, None
    for band in reversed(range(manifest.bands)):
        bottom, top = BAND * band, BAND * (band + 1)
        inner = nodes.where((F.col("level") > bottom) & (F.col("level") <= top))
        base = manifest.leaves.withColumn("level", F.lit(0))
        if band:
            base = nodes.where(F.col("level") == bottom)
        keep = [c for c in base.columns if c not in ("level", "high")]
        # A tree is entered from its root in the highest band in which it has base nodes.
        enters = F.lit(True)
        if over is not None:
            enters = enters & (F.col("leaves") <= FANOUT ** (top - 1))
        if band:
            enters = enters & (F.col("leaves") > FANOUT ** (bottom - 1))
        entry = above.where(enters).withColumn("low", F.lit(0).cast("long"))
        over = entry if over is None else over.unionByName(entry)
        parts = base.unionByName(inner, allowMissingColumns=True).unionByName(
            over.withColumn("level", F.lit(-1)), allowMissingColumns=True
        )
        fields = [base.schema[c] for c in keep]
        fields += [over.schema["subroot"], over.schema["root"], T.StructField("path", PATH)]
        found = (
            parts.withColumn("bucket", _bucket(band))
            .groupBy("tree", "bucket")
            .applyInArrow(_descend(band, keep), T.StructType(fields))
        )
        if band:
            over = staged(found.select("tree", "leaves", "low", "subroot", "root", "path"), "paths")
    return found


def prove(
    df: DataFrame,
    carry: dict[str, Column] | None = None,
    by: str = "source",
    key: str = "doc_id",
    fields: tuple[str, ...] = FIELDS,
) -> DataFrame:
    """Each row's carried columns (the key if none are given) with leaf, subroot, root and path.

    `path` lists what stands left and right of the node in each run from the leaf to the root, as
    concatenated digests; both are empty where a run has one node.
    """
    carry = carry or {key: F.col(key)}
    own = {"leaf", "subroot", "root", "path"}
    if own & {c.lower() for c in carry}:
        raise ValueError(f"carried columns must not be named {sorted(own)}")
    rows = df.select(
        F.col(by).cast("string").alias("tree"),
        F.col(key).alias("key"),
        leaf(fields=fields).alias("digest"),
        F.struct(*[c.alias(name) for name, c in carry.items()]).alias("row"),
    )
    sources = build(rows)
    roots = staged(sources.roots, "roots")
    forest = build(roots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest",
                                F.struct("tree", "leaves").alias("row")))
    root = forest.roots.select(
        "tree", "leaves", F.lit("").alias("subroot"), F.col("digest").alias("root"),
        F.array().cast(PATH).alias("path"),
    )
    above = staged(
        paths(forest, root).select("row.tree", "row.leaves", F.col("digest").alias("subroot"), "root", "path"),
        "roots",
    )
    proved = paths(sources, above)
    return proved.select("row.*", F.col("digest").alias("leaf"), "subroot", "root", "path")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def path_digest(path: Column) -> Column:
    """One digest for all siblings of a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
