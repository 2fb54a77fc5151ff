"""Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf: the hash of some of its columns. The leaves of a group (a language, say) ascend by
id. A run of `fanout` nodes becomes one node of the next level, until one is left, the group's subroot;
subroots, in order of their groups, give the root in the same way.

Leaves are dealt into partitions of fanout ** levels leaves, aligned with the tree, so that a partition
is a whole subtree. It hashes that by itself. Then subtree roots are swapped: in round r, the partitions
that differ only in digit r of their number (base `fanout`) form a group of at most `fanout` and send
each other what they hold, the hash of the ancestor at level r; all of them hash the next ancestor, each
for itself, and keep the others' hashes as part of their proofs. After the last round every partition
holds the root and the upper part of all its proofs, and nothing has to be sent down again. Where the last
subtree of a run has fewer partitions than its siblings, its partitions send to several, in turn; the
rounds over groups work alike. A round is one shuffle of at most `fanout` short rows a partition.

Positions come from one range partitioning of (group, id, leaf): ordinals within its tasks and prefix sums
over the counts of its tasks, so the largest group is no task's alone. Texts are hashed where they are
read and never shuffled.

Defined results: a null column hashes as `-`. Null groups are one group, the first. Null ids come first in
their group, and are never among the tampered rows of `verify_report`; repeated ids are ordered by leaf,
and equal rows are leaves of their own. An empty table gives no rows. Texts are hashed whole, however
long. Other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlink.llm.common import ascii_lower, joined, kept, out_schema

FANOUT = 8
#: Levels of the tree within a partition: 8 ** 4 leaves each.
LEVELS = 4
HEX = 64


def field(value: Column) -> Column:
    """`-` for null, else the length in bytes, `:` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def node_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- positions ---------------------------------------------------------------------------


def _before(size: str, window: Window) -> Column:
    """Sum of `size` over the earlier rows of the window."""
    return F.coalesce(F.sum(size).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _placed(leaves: DataFrame, per_partition: int) -> tuple[DataFrame, DataFrame]:
    """The leaves with partition `g` and `slot` in it; and the groups: rank, blocks, first partition."""
    ordered = leaves.repartitionByRange("group", "id", "leaf").sortWithinPartitions("group", "id", "leaf")
    rows = kept(ordered.withColumn("at", F.monotonically_increasing_id()), "merkle_leaves")
    rows = rows.withColumn("task", F.shiftright("at", 33))
    runs = kept(rows.groupBy("group", "task").agg(F.count("*").alias("n"), F.min("at").alias("first")), "merkle_runs")

    # A group begins in one task; so its rank follows from the groups that begin in earlier tasks and in its own.
    groups = runs.groupBy("group").agg(F.sum("n").alias("n"), F.min("task").alias("begins"))
    groups = groups.withColumn("blocks", F.ceil(F.col("n") / per_partition))
    tasks = groups.groupBy("begins").agg(F.count("*").alias("groups"), F.sum("blocks").alias("all_blocks"))
    over_tasks = Window.orderBy("begins")  # a row per task of the range partitioning
    tasks = tasks.select("begins", _before("groups", over_tasks).alias("rank0"), _before("all_blocks", over_tasks).alias("g0"))
    within = Window.partitionBy("begins").orderBy("group")
    groups = groups.withColumns({"nth": F.row_number().over(within) - 1, "earlier": _before("blocks", within)}).join(tasks, "begins")
    groups = kept(
        groups.select("group", "blocks", (F.col("rank0") + F.col("nth")).alias("rank"), (F.col("g0") + F.col("earlier")).alias("first_g")),
        "merkle_groups",
    )

    runs = runs.withColumn("before", _before("n", Window.partitionBy("group").orderBy("task")))
    placed = joined(rows, joined(runs, groups, ["group"]), ["group", "task"])
    position = F.col("before") + F.col("at") - F.col("first")
    return placed.withColumns({"g": F.col("first_g") + F.floor(position / per_partition), "slot": position % per_partition}), groups


# ---- within a partition ------------------------------------------------------------------


def subtree(leaves: list[str], fanout: int, levels: int, alone: bool) -> list[list[str]]:
    """Nodes by level, leaves first. A partition that is not its group's only one is raised by all levels."""
    tree = [leaves]
    while len(tree[-1]) > 1 or (not alone and len(tree) <= levels):
        last = tree[-1]
        tree.append([node_hash("".join(last[i : i + fanout])) for i in range(0, len(last), fanout)])
    return tree


def paths(tree: list[list[str]], fanout: int) -> Callable[[int], list[tuple[str, str]]]:
    """For a leaf's slot: what stands before and after it and each of its ancestors in their runs."""
    runs = [["".join(level[i : i + fanout]) for i in range(0, len(level), fanout)] for level in tree[:-1]]

    def of(slot: int) -> list[tuple[str, str]]:
        steps = []
        for level in runs:
            slot, at = divmod(slot, fanout)
            steps.append((level[slot][: at * HEX], level[slot][(at + 1) * HEX :]))
        return steps

    return of


def folded(node: str, steps: list[tuple[str, str]]) -> str:
    for before, after in steps:
        node = node_hash(before + node + after)
    return node


# ---- between partitions ------------------------------------------------------------------


def _swap(state: DataFrame) -> DataFrame:
    """One round. `run` has (digit, first partition, partitions) of each subtree in the run, the own one included."""
    own_size = F.element_at(F.filter("run", lambda t: t["digit"] == F.col("digit")), 1)
    state = state.withColumns({"first": own_size["first"], "size": own_size["size"]})
    low = F.col("g") - F.col("first")
    sent = state.withColumn("to", F.explode("run")).withColumn(
        "x",
        F.explode(
            F.when(low < F.col("to.size"), F.sequence(low, F.col("to.size") - 1, F.col("size"))).otherwise(F.array().cast("array<bigint>"))
        ),
    )
    target = F.col("to.first") + F.col("x")
    own = F.when(target == F.col("g"), F.struct("rank", "block", "blocks", "first_g", "subroot", "hash", "proof", "digit", "active"))
    met = (
        sent.select(target.alias("g"), F.struct("digit", "hash").alias("node"), own.alias("own"))
        .groupBy("g")
        .agg(F.sort_array(F.collect_list("node")).alias("nodes"), F.first("own", ignorenulls=True).alias("own"))
        .select("g", "own.*", "nodes")
    )
    others = F.filter("nodes", lambda x: x["digit"] != F.col("digit"))["hash"]
    step = F.struct(F.col("digit").alias("at"), others.alias("siblings"))
    return met.withColumns(
        {
            "hash": F.when(F.col("active"), F.sha2(F.array_join(F.col("nodes.hash"), ""), 256)).otherwise(F.col("hash")),
            "proof": F.when(F.col("active"), F.array_append("proof", step)).otherwise(F.col("proof")),
        }
    ).drop("nodes", "digit", "active")


def _subtree_run(unit: int, fanout: int) -> dict[str, Column]:
    """The run of a partition's subtree of `unit` partitions, within its group."""
    blocks = F.col("blocks")
    nodes, node = F.ceil(blocks / unit), F.floor(F.col("block") / unit)
    first = F.floor(node / fanout) * fanout
    run = F.transform(
        F.sequence(first, F.least(first + fanout, nodes) - 1),
        lambda t: F.struct(
            (t - first).cast("int").alias("digit"),
            (F.col("first_g") + t * unit).alias("first"),
            F.least(F.lit(unit).cast("long"), blocks - t * unit).alias("size"),
        ),
    )
    return {"run": run, "digit": (node - first).cast("int"), "active": nodes > 1}


def _group_runs(groups: DataFrame, unit: int, fanout: int) -> DataFrame:
    """The runs of subtrees of `unit` groups: parent, run."""
    nodes = groups.groupBy(F.floor(F.col("rank") / unit).alias("node")).agg(F.min("first_g").alias("first"), F.sum("blocks").alias("size"))
    parent = F.floor(F.col("node") / fanout)
    digit = (F.col("node") - parent * fanout).cast("int").alias("digit")
    return nodes.groupBy(parent.alias("parent")).agg(F.sort_array(F.collect_list(F.struct(digit, "first", "size"))).alias("run"))


def _rounds(n: int, fanout: int) -> int:
    rounds = 0
    while n > 1:
        n, rounds = -(-n // fanout), rounds + 1
    return rounds


def butterfly(blocks: DataFrame, groups: DataFrame, fanout: int) -> DataFrame:
    """From (g, rank, block, blocks, first_g, hash) of every partition to its subroot, root and upper proof."""
    most, count = groups.agg(F.max("blocks"), F.count("*")).first()
    empty = F.array().cast("array<struct<at:int,siblings:array<string>>>")
    state = blocks.withColumns({"proof": empty, "subroot": F.lit(None).cast("string")})
    for r in range(_rounds(most or 0, fanout)):
        state = _swap(state.withColumns(_subtree_run(fanout**r, fanout)))
    state = state.withColumn("subroot", F.col("hash"))
    for r in range(_rounds(count, fanout)):
        unit = fanout**r
        state = state.withColumn("parent", F.floor(F.col("rank") / (unit * fanout))).join(_group_runs(groups, unit, fanout), "parent")
        node = F.floor(F.col("rank") / unit)
        state = _swap(state.withColumns({"digit": (node - F.col("parent") * fanout).cast("int"), "active": F.lit(True)}))
    return state.select("g", "blocks", "subroot", F.col("hash").alias("root"), "proof")


# ---- the manifest ------------------------------------------------------------------------


@dataclass
class Manifest:
    """`leaves`: id, group, leaf, other (a leaf to verify in its place, or null), g, slot. `partitions`: g,
    blocks, subroot, root and the upper proof, one row for each fanout ** levels leaves."""

    leaves: DataFrame
    partitions: DataFrame
    id_: str
    fanout: int
    levels: int

    def _each(self, schema: StructType, rows: Callable) -> DataFrame:
        """Runs `rows(leaves, paths, partition, steps)` for every partition, with its part of the tree."""
        fanout, levels = self.fanout, self.levels

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            left = left.sort_by("slot")
            (part,) = right.to_pylist()
            tree = subtree(left.column("leaf").to_pylist(), fanout, levels, part["blocks"] == 1)
            steps = []
            for step in part["proof"]:
                at, siblings = step["at"], step["siblings"]
                steps.append(("".join(siblings[:at]), "".join(siblings[at:])))
            return rows(left, paths(tree, fanout), part, steps)

        return self.leaves.groupBy("g").cogroup(self.partitions.groupBy("g")).applyInArrow(run, schema)

    def _schema(self, more: str) -> StructType:
        return StructType([self.leaves.schema["id"], *out_schema(more).fields])

    def proofs(self) -> DataFrame:
        """Every leaf with its whole proof: id, leaf, subroot, root, and per level the hashes before and after it."""

        def rows(left, path, part, steps):
            found = [
                [{"before": _cut(b), "after": _cut(a)} for b, a in path(slot) + steps] for slot in left.column("slot").to_pylist()
            ]
            kind = pa.list_(pa.struct([("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))
            n = left.num_rows
            return pa.table(
                {
                    "id": left.column("id"),
                    "leaf": left.column("leaf"),
                    "subroot": pa.repeat(pa.scalar(part["subroot"]), n),
                    "root": pa.repeat(pa.scalar(part["root"]), n),
                    "proof": pa.array(found, kind),
                }
            )

        more = "leaf string, subroot string, root string, proof array<struct<before:array<string>,after:array<string>>>"
        return self._each(self._schema(more), rows).withColumnRenamed("id", self.id_)

    def verify_report(self) -> DataFrame:
        """Folds `other`, or else the leaf, with the leaf's proof: id, leaf, subroot, root, proof_sha256, folded_root, verified."""

        def rows(left, path, part, steps):
            upper = "".join(b + a for b, a in steps)
            known: dict[str, str] = {}
            digests, roots = [], []
            for slot, leaf, other in zip(*(left.column(c).to_pylist() for c in ("slot", "leaf", "other"))):
                own = path(slot)
                digests.append(node_hash("".join([b + a for b, a in own]) + upper))
                top = folded(other or leaf, own)
                if top not in known:  # untampered leaves of a partition fold to the same node
                    known[top] = folded(top, steps)
                roots.append(known[top])
            n = left.num_rows
            return pa.table(
                {
                    "id": left.column("id"),
                    "leaf": left.column("leaf"),
                    "subroot": pa.repeat(pa.scalar(part["subroot"]), n),
                    "root": pa.repeat(pa.scalar(part["root"]), n),
                    "proof_sha256": pa.array(digests, pa.string()),
                    "folded_root": pa.array(roots, pa.string()),
                    "verified": pa.array([r == part["root"] for r in roots], pa.bool_()),
                }
            )

        more = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return self._each(self._schema(more), rows).withColumnRenamed("id", self.id_)


def _cut(run: str) -> list[str]:
    return [run[i : i + HEX] for i in range(0, len(run), HEX)]


def build(
    docs: DataFrame,
    id_: str = "doc_id",
    group: str = "lang",
    columns: Iterable[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    other: Column | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> Manifest:
    """The manifest of a table. `other` gives a row's leaf as it is found later; by default there is none."""
    leaves = docs.select(
        F.col(id_).alias("id"),
        F.col(group).alias("group"),
        leaf_hash([F.col(c) for c in columns]).alias("leaf"),
        (F.lit(None).cast("string") if other is None else other).alias("other"),
    )
    placed, groups = _placed(leaves, fanout**levels)

    def root(table: pa.Table) -> pa.Table:
        table = table.sort_by("slot")
        first = table.slice(0, 1).select(["g", "rank", "block", "blocks", "first_g"])
        tree = subtree(table.column("leaf").to_pylist(), fanout, levels, first.column("blocks")[0].as_py() == 1)
        return first.append_column("hash", pa.array([tree[-1][0]], pa.string()))

    rows = placed.select("g", "rank", (F.col("g") - F.col("first_g")).alias("block"), "blocks", "first_g", "slot", "leaf")
    roots = rows.groupBy("g").applyInArrow(root, "g long, rank long, block long, blocks long, first_g long, hash string")
    partitions = kept(butterfly(roots, groups, fanout), "merkle_partitions")
    return Manifest(placed.select("id", "group", "leaf", "other", "g", "slot"), partitions, id_, fanout, levels)


def tampered_leaf(columns: Iterable[str], text: str = "text", id_: str = "doc_id") -> Column:
    """Leaf of a row whose text was lower-cased (A to Z), where 3 divides the crc32 of its decimal id; else null."""
    hit = F.crc32(F.col(id_).cast("string").cast("binary")) % 3 == 0
    return F.when(hit, leaf_hash([ascii_lower(F.col(c)) if c == text else F.col(c) for c in columns]))


def manifest_report(docs: DataFrame) -> DataFrame:
    """Manifest of the documents, verified after every third one (by crc32) was tampered with."""
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    return build(docs, columns=columns, other=tampered_leaf(columns)).verify_report()
