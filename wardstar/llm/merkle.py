"""Merkle manifest of a table, with a witness for every row.

A row's leaf is the digest of its fields. Leaves of one group (say a language)
stand in key order and make a tree in which every run of eight consecutive
nodes becomes its parent, the last run being shorter; the group's subroots, in
group order, make a tree of the same kind, whose root is the manifest's.

The trees are built by aligned appends. A block of ``BLOCK`` leaves is one
append stream: a completed node is appended to the open run of the level above,
and its witness (what stands left and right of it) is begun with the siblings
that are complete; each later sibling extends it on the right, until the run
closes. Blocks are worked on in parallel wherever they lie. Their roots are
the appends of the next round, in blocks again, so that a group of n rows takes
log(n) / log(BLOCK) rounds and no task ever holds more than a block. What is
stored per run of eight leaves is their digests and the run's witness up to the
block's root, not a path per leaf. A leaf's path is its run's other digests,
the run's witness, and then the witnesses of its block's root in the rounds
above, which all leaves of a block share and get by one join per round.

Digests are lower-case hexadecimal SHA-256; a node's is that of its children's
digests joined as text.

Defined cases: a null field is hashed as ``-``, any other as its UTF-8 byte
count, a colon and its text, so that no two rows of fields read alike; rows
with a null group are a group, which comes first, as rows with a null key come
first in their group; equal keys are ordered by their leaf, and repeated rows
are leaves of their own; a lone leaf is its group's subroot and a lone subroot
the root, both with an empty path; an empty table has no rows and a null root.
A long text is hashed where it is read, only its digest is moved. Columns that
are carried along lie in a struct of their own and clash with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.operators.rownum import global_row_number
from wardstar.session import materialize

from .common import quoted

ARITY = 8
BLOCK_LEVELS = 3
BLOCK = ARITY ** BLOCK_LEVELS

STEP = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])
WITNESS = T.ArrayType(STEP)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """The digest of a row's fields in the given order."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


# ------------------------------------------------------------ one append stream
class _Node:
    __slots__ = ("digest", "left", "right", "parent")

    def __init__(self, value: str, left: str):
        self.digest, self.left, self.right, self.parent = value, left, "", None


class AppendStream:
    """Appends to a tree of ``height`` levels above the appended nodes. Open
    runs hold the completed subtrees that still wait for siblings."""

    def __init__(self, height: int):
        self.height = height
        self.open: list[list[_Node]] = [[] for _ in range(height + 1)]

    def append(self, value: str, level: int = 0) -> _Node:
        run = self.open[level]
        node = _Node(value, "".join([x.digest for x in run]))
        for x in run:
            x.right += value
        run.append(node)
        if len(run) == ARITY and level < self.height:
            self._complete(level)
        return node

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        parent = self.append(digest("".join([x.digest for x in run])), level + 1)
        for x in run:
            x.parent = parent

    def finish(self) -> str:
        """Close the open runs, the lowest first; the digest of the root."""
        for level in range(self.height):
            if self.open[level]:
                self._complete(level)
        return self.open[self.height][0].digest


def witness(node: _Node | None) -> list[dict]:
    """What stands left and right of a node and of its ancestors, upwards."""
    out = []
    while node is not None and node.parent is not None:
        out.append({"left": node.left, "right": node.right})
        node = node.parent
    return out


def height_of(total: int) -> int:
    """Levels above ``total`` nodes until one is left, within a block."""
    if total > BLOCK:
        return BLOCK_LEVELS
    height = 0
    while ARITY ** height < total:
        height += 1
    return height


# ------------------------------------------------------------ rounds of blocks
def _append_blocks(nodes: DataFrame) -> DataFrame:
    """One round: nodes (grp, pos, total, digest, row) to a row per run of
    eight, with the run's witness within its block and the block's root."""
    kinds = {f.name: f.dataType for f in nodes.schema}
    node = T.StructType([T.StructField("digest", T.StringType()), T.StructField("row", kinds["row"])])
    out = T.StructType([
        T.StructField("grp", kinds["grp"]), T.StructField("block", T.LongType()),
        T.StructField("total", T.LongType()), T.StructField("run", T.LongType()),
        T.StructField("height", T.IntegerType()), T.StructField("root", T.StringType()),
        T.StructField("nodes", T.ArrayType(node)), T.StructField("witness", WITNESS)])

    def build(block: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(out)
        block = block.sort_by("pos").combine_chunks()
        total = block.column("total")[0].as_py()
        height = height_of(total)
        stream = AppendStream(height)
        leaves = [stream.append(d) for d in block.column("digest").to_pylist()]
        root = stream.finish()
        starts = list(range(0, len(leaves), ARITY))
        first = block.column("pos")[0].as_py()
        one = lambda name: block.column(name).chunk(0) if block.num_rows else None
        kept = pa.StructArray.from_arrays([one("digest"), one("row")], fields=list(target.field("nodes").type.value_type))
        n = len(starts)
        columns = [
            one("grp").take(pa.array([0] * n)), pa.array([first // BLOCK] * n, pa.int64()),
            pa.array([total] * n, pa.int64()), pa.array([(first + s) // ARITY for s in starts], pa.int64()),
            pa.array([height] * n, pa.int32()), pa.array([root] * n),
            pa.ListArray.from_arrays(pa.array([*starts, len(leaves)], pa.int32()), kept),
            pa.array([witness(leaves[s].parent) for s in starts], target.field("witness").type)]
        return pa.Table.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, target)],
                                    schema=target)

    blocks = nodes.withColumn("block", F.shiftright("pos", 3 * BLOCK_LEVELS))
    return blocks.groupBy("grp", "block").applyInArrow(build, out)


def _rounds(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Rounds of appends until every group is one node; each is written."""
    done = []
    while True:
        runs = materialize(_append_blocks(nodes), name)
        done.append(runs)
        most = runs.agg(F.max("total")).first()[0]
        if most is None or most <= BLOCK:
            return done
        nodes = _block_roots(runs)


def _block_roots(runs: DataFrame) -> DataFrame:
    first_run = F.col("run") == F.col("block") * (BLOCK // ARITY)
    return runs.where(first_run).select(
        "grp", F.col("block").alias("pos"),
        F.shiftright(F.col("total") + (BLOCK - 1), 3 * BLOCK_LEVELS).alias("total"),
        F.col("root").alias("digest"), F.lit(0).alias("row"))


def _steps(col: Column | None = None) -> Column:
    return F.coalesce(col, F.array().cast(WITNESS)) if col is not None else F.array().cast(WITNESS)


def _witnessed(rounds: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """Nodes of the first round with their whole witness. ``above`` has, per
    group, a witness that goes on from the group's root, and more columns."""
    extra = [c for c in above.columns if c not in ("grp_above", "steps")] if above is not None else []
    for at in range(len(rounds) - 1, -1, -1):
        runs = rounds[at].drop("root", "total")
        if above is not None:
            same = F.col("grp").eqNullSafe(F.col("grp_above"))
            if at < len(rounds) - 1:
                same = same & (F.col("block") == F.col("pos_above"))
            runs = runs.join(above, same)
        rest = F.concat("witness", _steps(F.col("steps") if above is not None else None))
        one = runs.withColumn("rest", rest).select(
            "*", F.posexplode("nodes").alias("at", "node"))
        digests = F.col("nodes.digest")
        own = F.struct(F.array_join(F.slice(digests, F.lit(1), F.col("at")), "").alias("left"),
                       F.array_join(F.slice(digests, F.col("at") + 2, F.lit(ARITY)), "").alias("right"))
        path = F.when(F.col("height") > 0, F.concat(F.array(own), "rest")).otherwise(F.col("rest"))
        nodes = one.select("grp", (F.col("run") * ARITY + F.col("at")).alias("pos"), F.col("node.digest").alias("digest"),
                           F.col("node.row").alias("row"), path.alias("steps"), *extra)
        if at:
            above = nodes.select(F.col("grp").alias("grp_above"), F.col("pos").alias("pos_above"), "steps", *extra)
    return nodes


# ------------------------------------------------------------ the manifest
@dataclass
class Manifest:
    """``rounds``: written runs of each round, from the leaves up. ``groups``:
    group, subroot, root and the subroot's witness, one row per group."""
    rounds: list[DataFrame]
    groups: DataFrame

    @property
    def root(self) -> str | None:
        row = self.groups.select("root").first()
        return row[0] if row else None

    def witnesses(self) -> DataFrame:
        """A row per leaf: group, pos (in its group), leaf, the carried columns
        in ``row``, subroot, root, and ``witness``: left and right siblings
        level by level up to the root."""
        above = self.groups.select(F.col("group").alias("grp_above"), "subroot", "root",
                                   F.col("witness").alias("steps"))
        out = _witnessed(self.rounds, above)
        return out.select(F.col("grp").alias("group"), "pos", F.col("digest").alias("leaf"), "row",
                          "subroot", "root", F.col("steps").alias("witness"))


def build_manifest(df: DataFrame, leaf: Column, group_col: str, order_col: str,
                   carry: Sequence[Column] = ()) -> Manifest:
    """Build the trees over the rows of ``df``. ``carry`` are named columns that
    come back with each leaf."""
    row = F.struct(*carry) if carry else F.lit(0)
    leaves = materialize(df.select(F.col(quoted(group_col)).alias("grp"), F.col(quoted(order_col)).alias("key"),
                                   leaf.alias("digest"), row.alias("row")), "leaves")
    placed = global_row_number(leaves, ["key", "digest"], out="place", partition_cols=["grp"], total_col="total")
    rounds = _rounds(placed.select("grp", (F.col("place") - 1).alias("pos"), "total", "digest", "row"), "merkle")
    top = rounds[-1].where("run = 0").select("grp", F.col("root").alias("digest"))
    order = global_row_number(top, ["grp"], out="place", total_col="total")
    trees = _rounds(order.select(F.lit(0).alias("grp"), (F.col("place") - 1).alias("pos"), "total", "digest",
                                 F.struct("grp").alias("row")), "merkle-groups")
    root = trees[-1].where("run = 0").select(F.col("grp").alias("grp_above"), "root", _steps().alias("steps"))
    groups = _witnessed(trees, root).select(F.col("row.grp").alias("group"), F.col("digest").alias("subroot"),
                                            "root", F.col("steps").alias("witness"))
    return Manifest(rounds, materialize(groups, "merkle-tops"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def audit(manifest: Manifest, claim: Column) -> DataFrame:
    """Recompute the root from each row's claimed leaf and its own witness."""
    return manifest.witnesses().withColumn("folded_root", fold(claim, F.col("witness"))).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
