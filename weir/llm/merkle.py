"""A Merkle manifest of the rows of a dataset, written as append logs in postorder.

Each row's digest is a leaf. Per language the leaves ascend by id and a binary tree stands over them, whose last
node of a level has no sibling where their number is odd; the languages' roots are the leaves of a last tree.

Aligned builders: 2^``HEIGHT`` leaves in a row, from a multiple of that on, are one block. A task that builds a block
appends each node as soon as its children are there, so its log is the block's tree in postorder. The roots of the
blocks are the leaves of the next tier, built the same way, so a tree of any size takes blocks of a bounded size.

Closed form: before leaf ``i`` starts, the whole subtrees over the leaves before it stand in the log: 2i - popcount(i)
nodes. So node ``i`` of level ``l`` over leaves of which the last is ``e`` stands at 2e - popcount(e) + l. The nodes
at the right edge that never get a second child are appended last, by level. A proof reads each sibling at its place
in its block's log; what lies above the block is the same for all its leaves, and comes from the next tier's proof.

Defined cases: NULL fields are spelled ``-``; equal ids are ordered by their digests, and rows that are equal
altogether stand in any order, which no digest shows; a language that is NULL comes first; one row alone is
its own root, with the digest of nothing as its proof; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import keep

#: Levels of a block: 256 leaves, and at most 511 nodes of 32 bytes in its log.
HEIGHT = 8
#: What a proof says of each level: no sibling, a sibling to the left, a sibling to the right; then its 32 bytes.
ALONE, LEFT, RIGHT = b"\0", b"\1", b"\2"
#: Rows are tampered with, as a test of the proofs, where this divides the crc32 of the id.
TAMPERED = 7

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_LOGS = "tree binary, block long, root binary, log binary, leaves long, count long"


def digest(*children: bytes) -> bytes:
    """The digest of a node: of its children's digests as hexadecimal text."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def levels(count: int) -> int:
    """How many levels a tree over ``count`` leaves has above them."""
    return max(count - 1, 0).bit_length()


def place(level: int, index: int, count: int) -> int:
    """Where node ``index`` of ``level`` stands in the log of a tree over ``count`` leaves."""
    last = ((index + 1) << level) - 1
    if last < count:
        return 2 * last - last.bit_count() + level
    # A node at the right edge: all whole subtrees come first, then such nodes by level.
    partial = sum(1 for k in range(1, level) if count & ((1 << k) - 1))
    return 2 * count - count.bit_count() + partial


def append_log(leaves: list[bytes], height: int) -> list[bytes]:
    """The nodes of a tree over ``leaves`` up to level ``height``, in the order in which they are complete."""
    log: list[bytes] = []
    open_: list[tuple[int, bytes]] = []  # nodes that wait for their sibling, with their levels
    for leaf in leaves:
        level, node = 0, leaf
        log.append(node)
        while open_ and open_[-1][0] == level and level < height:
            node = digest(open_.pop()[1], node)
            level += 1
            log.append(node)
        open_.append((level, node))
    # The right edge: a node without a sibling is carried up until it meets the one that waits for it.
    if len(open_) > 1 or open_[0][0] < height:
        level, node = open_.pop()
        while level < height:
            node = digest(open_.pop()[1], node) if open_ and open_[-1][0] == level else digest(node)
            level += 1
            log.append(node)
    return log


def siblings(rank: int, count: int, height: int, log: bytes, width: int = 32) -> bytes:
    """The proof of leaf ``rank`` of a block of ``count`` leaves up to level ``height``: 33 bytes for each level."""
    steps = []
    for level in range(height):
        index = rank >> level
        beside = index ^ 1
        if beside << level >= count:
            steps.append(ALONE + bytes(width))
        else:
            at = place(level, beside, count) * width
            steps.append((LEFT if index & 1 else RIGHT) + log[at : at + width])
    return b"".join(steps)


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof give."""
    node = leaf
    for at in range(0, len(proof), 33):
        side, beside = proof[at : at + 1], proof[at + 1 : at + 33]
        node = digest(node) if side == ALONE else digest(beside, node) if side == LEFT else digest(node, beside)
    return node


def proof_digest(proof: bytes) -> str:
    """The digest of a proof's siblings, from the leaf's to the last tree's."""
    beside = [proof[at + 1 : at + 33].hex() for at in range(0, len(proof), 33) if proof[at : at + 1] != ALONE]
    return hashlib.sha256("".join(beside).encode()).hexdigest()


def build(leaves: DataFrame) -> list[DataFrame]:
    """The logs of every tree, a table for each tier. ``leaves`` has tree, rank (from 0), count and digest.

    A row of a table is the log of one block. The last table has one row for each tree, whose ``root`` is the tree's.
    """

    def builder(key: tuple, table: pa.Table) -> pa.Table:
        order = table.column("rank").to_numpy().argsort()
        count = table.column("count")[0].as_py()
        found = table.column("digest").to_pylist()
        log = append_log([found[i] for i in order], min(HEIGHT, levels(count)))
        tree, block = key[0].as_py(), key[1].as_py()
        columns = [[tree], [block], [log[-1]], [b"".join(log)], [len(found)], [count]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, logs, strict=True)], schema=logs)

    logs = pa.schema(
        [("tree", pa.binary()), ("block", pa.int64()), ("root", pa.binary()), ("log", pa.binary())]
        + [("leaves", pa.int64()), ("count", pa.int64())]
    )
    tiers, below = [], leaves
    while True:
        blocks = below.select("tree", F.shiftright("rank", HEIGHT).alias("block"), "rank", "count", "digest")
        built = keep(blocks.groupBy("tree", "block").applyInArrow(builder, _LOGS), f"merkle-tier-{len(tiers)}")
        tiers.append(built)
        whole = 1 << HEIGHT
        if not built.where(F.col("count") > whole).limit(1).count():
            return tiers
        # A tree that is one block already is a leaf without siblings in the tiers above.
        below = built.select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("count") / whole).alias("count"), F.col("root").alias("digest")
        )


def roots(tiers: list[DataFrame]) -> DataFrame:
    """tree and root."""
    return tiers[-1].select("tree", "root")


def _with_proofs(rows: DataFrame, logs: DataFrame, above: DataFrame, schema: str, finish: Callable) -> DataFrame:
    """``finish(rows of a block, their proofs, the block's log)`` for each block.

    ``above`` has tree, block and proof: what follows the proofs of a block. Its other columns come with the log.
    """
    logs = logs.drop("root").join(above, ["tree", "block"])

    def extract(mine: pa.Table, logged: pa.Table) -> pa.Table:
        log, rest = logged.column("log")[0].as_py(), logged.column("proof")[0].as_py()
        count, height = logged.column("leaves")[0].as_py(), min(HEIGHT, levels(logged.column("count")[0].as_py()))
        inside = (1 << HEIGHT) - 1
        found = [siblings(r & inside, count, height, log) + rest for r in mine.column("rank").to_pylist()]
        return finish(mine, found, logged)

    keyed = rows.withColumn("block", F.shiftright("rank", HEIGHT))
    return keyed.groupBy("tree", "block").cogroup(logs.groupBy("tree", "block")).applyInArrow(extract, schema)


def block_proofs(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """tree, block and proof: what every leaf of a block of the first tier has above that block.

    ``above`` has tree and proof: what follows each tree's root.
    """
    proofs = above.select("tree", F.lit(0).cast("long").alias("block"), "proof")
    for logs, below in zip(tiers[:0:-1], tiers[-2::-1], strict=True):

        def finish(mine: pa.Table, found: list[bytes], logged: pa.Table) -> pa.Table:
            columns = [mine.column("tree"), mine.column("rank"), pa.array(found, pa.binary())]
            return pa.Table.from_arrays(columns, names=["tree", "block", "proof"])

        rows = below.select("tree", F.col("block").alias("rank"))
        proofs = keep(_with_proofs(rows, logs, proofs, "tree binary, block long, proof binary", finish), "merkle-proofs")
    return proofs


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add rank (from 0) and count within each ``tree``, in the order of the columns named.

    Rows are dealt into ranges of the whole order, counted by range and numbered within it. Equal rows are told
    apart by the row's number in the table, so a range never holds more of them than others.
    """
    placed = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange("tree", *order, "_row").withColumn("_range", F.spark_partition_id())
    ranged = keep(ranged, "merkle-ranges")
    counted = ranged.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    # A row for each range of a tree, not for each leaf.
    starts = counted.select(
        F.col("tree").alias("_tree"),
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(whole).alias("count"),
    )
    inside = Window.partitionBy("_range", "tree").orderBy(*order, "_row")
    numbered = ranged.withColumn("_at", F.row_number().over(inside) - 1)
    joined = numbered.join(starts, (F.col("tree") == F.col("_tree")) & (F.col("_range") == F.col("_of")))
    return joined.withColumn("rank", F.col("_start") + F.col("_at")).drop("_row", "_range", "_tree", "_of", "_start", "_at")


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row, as 32 bytes."""

    def spelled(value: Column) -> Column:
        shown = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[spelled(c) for c in (doc_id, source, lang, n_chars, text)]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree, digest and tampered: the digest of the row with one more character, where it is tampered with."""
    named = [F.col(c) for c in FIELDS]
    more = [F.col(c).cast("long") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    # The tree of a language that is NULL is the empty key; a name follows a byte of its own.
    tree = F.when(F.col("lang").isNull(), F.lit(b"")).otherwise(F.concat(F.lit(b"="), F.encode("lang", "UTF-8")))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        tree.alias("tree"),
        leaf(*named).alias("digest"),
        F.when(hit, leaf(*more)).alias("tampered"),
    )


class Manifest:
    """The trees over a table: leaves with their ranks, the logs of each tier, and the last tree over the languages."""

    def __init__(self, docs: DataFrame) -> None:
        # Digests are written before they are ordered: choosing the ranges reads their rows once more.
        self.leaves = keep(ranked(keep(leaves(docs), "merkle-digests"), ["doc_id", "digest"]), "merkle-leaves")
        self.tiers = build(self.leaves.select("tree", "rank", "count", "digest"))
        subroots = ranked(roots(self.tiers).select(F.lit(b"").alias("tree"), F.col("tree").alias("_lang"), "root"), ["_lang"])
        self.subroots = keep(subroots.withColumnRenamed("root", "digest"), "merkle-subroots")
        self.top = build(self.subroots.select("tree", "rank", "count", "digest"))

    @property
    def root(self) -> bytes | None:
        """The digest of the whole table; None for an empty one."""
        found = self.top[-1].select("root").first()
        return bytes(found["root"]) if found else None

    def tree_proofs(self) -> DataFrame:
        """tree and proof of each language's root, up to the last root."""
        start = self.top[-1].select("tree", F.lit(b"").alias("proof"))

        def finish(mine: pa.Table, found: list[bytes], logged: pa.Table) -> pa.Table:
            return pa.Table.from_arrays([mine.column("_lang"), pa.array(found, pa.binary())], names=["tree", "proof"])

        rows = self.subroots.select("tree", "rank", "_lang")
        above = block_proofs(self.top, start)
        return keep(_with_proofs(rows, self.top[0], above, "tree binary, proof binary", finish), "merkle-tree-proofs")

    def log(self) -> DataFrame:
        """tree, tier, block, at and node: every log spelled out, a row for each node."""

        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    nodes = [row["log"][at : at + 32] for at in range(0, len(row["log"]), 32)]
                    n = len(nodes)
                    columns = [[row["tree"]] * n, [row["tier"]] * n, [row["block"]] * n, list(range(n)), nodes]
                    kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["tree", "tier", "block", "at", "node"])

        tiers = [t.select("tree", F.lit(i).alias("tier"), "block", "log") for i, t in enumerate(self.tiers)]
        rows = tiers[0]
        for more in tiers[1:]:
            rows = rows.union(more)
        return rows.mapInArrow(spell, "tree binary, tier int, block long, at long, node binary")

    def verify(self) -> DataFrame:
        """Every row with its digest, its roots, its proof's digest and the root that its tampered self folds to."""
        root = self.root
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

        def finish(mine: pa.Table, found: list[bytes], logged: pa.Table) -> pa.Table:
            own, tampered = mine.column("digest").to_pylist(), mine.column("tampered").to_pylist()
            folded = [fold(t or d, p) for d, t, p in zip(own, tampered, found, strict=True)]
            n = len(own)
            columns = [
                mine.column("doc_id"),
                pa.array([d.hex() for d in own], pa.string()),
                pa.array([logged.column("subroot")[0].as_py().hex()] * n, pa.string()),
                pa.array([root.hex()] * n, pa.string()),
                pa.array([proof_digest(p) for p in found], pa.string()),
                pa.array([f.hex() for f in folded], pa.string()),
                pa.array([f == root for f in folded], pa.bool_()),
            ]
            return pa.Table.from_arrays(columns, names=names)

        schema = ", ".join(f"{name} string" for name in names[1:-1])
        schema = f"doc_id long, {schema}, verified boolean"
        above = block_proofs(self.tiers, self.tree_proofs())
        # A subroot and what lies above a block come with the block's log, not with each leaf.
        above = above.join(roots(self.tiers).withColumnRenamed("root", "subroot"), "tree")
        return _with_proofs(self.leaves, self.tiers[0], above, schema, finish)


def manifest(docs: DataFrame) -> Manifest:
    """The manifest of ``docs``; it needs the columns of ``FIELDS``."""
    return Manifest(docs)
