"""SimHash near-duplicates by exact tiled comparison of all fingerprints.

Distinct fingerprints are dealt into tiles by the bit counts of their four 16-bit quarters. Two
fingerprints within ``radius`` bits have quarter counts whose differences add up to at most
``radius``, so a pair of tiles whose counts lie further apart is skipped; inside a pair of tiles the same test
skips pairs of sub-tiles. What is left is compared with an exclusive-or and a bit count. No pair within the
radius is lost, and no bucket, cap or candidate search is involved.

A pair of tiles hands on a spanning forest of its links, so a group of thousands of near copies gives a few links
for each member and tile instead of all pairs; components come from star contraction over the links.

Defined cases: a NULL or wordless text has fingerprint zero, which links like any other; fewer
words than a shingle form one shingle; equal fingerprints are one class with a distance of zero; repeated rows share their
component; a NULL doc_id is ignored in the smallest id and gives NULL where no other id is in the component; an
empty table gives an empty result; columns other than doc_id and text are ignored, or passed on by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.common import keep

HASH_SEED = 42
#: Fingerprints in a tile, about; two tiles meet in one task.
TILE = 4096
SUB_TILE = 256
#: Stands for a NULL doc_id within ``one_of_each``.
NO_ID = -(1 << 63)

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit SimHash of a text: each bit by majority over the shingles' XXH64."""
    found = (text or "").encode().translate(_LOWER).split()  # splits at the word breaks of bytes, U+0009 to U+000D and space
    if not found:
        return 0
    joined, n = b" ".join(found), len(found)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    votes, count = np.zeros(64, np.int64), n - shingle + 1
    for at in range(0, count, 1 << 16):  # bounded memory for very long texts
        to = min(at + (1 << 16), count)
        spans = zip(starts[at:to].tolist(), ends[at + shingle - 1 : to + shingle - 1].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in spans], np.uint64)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of ``text`` as a signed long; the other columns are passed on."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), shingle) for x in batch.column("text")]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signed)], names=schema.names)

    return docs.mapInArrow(add, schema)


def _quarters(found: np.ndarray) -> np.ndarray:
    """Bit counts of the four quarters, highest first, as an array (n, 4)."""
    return np.bitwise_count(found[:, None] >> np.array([48, 32, 16, 0], np.uint64) & np.uint64(0xFFFF)).astype(np.int16)


def _boxes(quarters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest bit counts of each sub-tile of sorted fingerprints."""
    starts = np.arange(0, len(quarters), SUB_TILE)
    return np.minimum.reduceat(quarters, starts), np.maximum.reduceat(quarters, starts)


def _forest(left: np.ndarray, right: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as the links left[i], right[i]: each node to the smallest it reaches."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = np.minimum(new, new[new])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(nodes))
    return moved, label[moved]


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between tiles ``a`` and ``b``, or within ``a`` where ``b`` is None."""

    def arranged(tile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q = _quarters(tile)
        order = np.lexsort((q[:, 3], q[:, 2], q[:, 1], q[:, 0]))
        return tile[order], q[order]

    a, qa = arranged(a)
    b_, qb = (a, qa) if b is None else arranged(b)
    (low_a, high_a), (low_b, high_b) = _boxes(qa), _boxes(qb)
    gap = np.maximum(0, np.maximum(low_b[None] - high_a[:, None], low_a[:, None] - high_b[None])).sum(axis=2)
    lefts, rights = [], []
    for i, j in np.argwhere(gap <= radius).tolist():
        if b is None and j < i:
            continue
        x, y = a[i * SUB_TILE : (i + 1) * SUB_TILE], b_[j * SUB_TILE : (j + 1) * SUB_TILE]
        near = np.bitwise_count(x[:, None] ^ y[None]) <= radius
        if b is None and i == j:
            np.fill_diagonal(near, False)
        p, q = np.nonzero(near)
        if len(p):
            lefts.append(p + i * SUB_TILE)
            rights.append(q + j * SUB_TILE + (0 if b is None else len(a)))
        if sum(map(len, lefts)) > 1 << 20:
            l, r = _forest(np.concatenate(lefts), np.concatenate(rights), len(a) + (0 if b is None else len(b_)))
            lefts, rights = [l], [r]
    if not lefts:
        return a[:0], a[:0]
    nodes = a if b is None else np.concatenate((a, b_))
    moved, to = _forest(np.concatenate(lefts), np.concatenate(rights), len(nodes))
    return nodes[moved], nodes[to]


def _blocks(cells: list[tuple[int, int, int, int]], radius: int, tile: int) -> tuple[list, list]:
    """Put the cells (three bit counts and how many fingerprints have them) into blocks of neighbours.

    Returns a row (cell, block, tiles of the block) for each cell and a row (block, partner blocks, not
    below it, with their numbers of tiles) for each block. There are at most 17^3 cells, however many fingerprints.
    """
    blocks: list[list] = []
    for q1, q2, q3, n in sorted(cells):
        if not blocks or blocks[-1][0] + n > tile or blocks[-1][1][:1] != (q1,):
            blocks.append([0, (q1, q2, q3), []])
        blocks[-1][0] += n
        blocks[-1][2].append((q1, q2, q3))
    sizes = [max(1, -(-n // tile)) for n, _, _ in blocks]
    low = np.array([np.min(b[2], axis=0) for b in blocks])
    high = np.array([np.max(b[2], axis=0) for b in blocks])
    placed = [(c[0] * 289 + c[1] * 17 + c[2], i, sizes[i]) for i, b in enumerate(blocks) for c in b[2]]
    partners = []
    for i in range(len(blocks)):
        gap = np.maximum(0, np.maximum(low[i:] - high[i], low[i] - high[i:])).sum(axis=1)
        partners.append((i, [(int(j + i), sizes[j + i]) for j in np.flatnonzero(gap <= radius)]))
    return placed, partners


def links(found: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (left, right) that connect all distinct fingerprints within ``radius`` bits, as signed longs."""
    spark = found.sparkSession
    quarter = lambda at: F.bit_count(F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit(0xFFFF).cast("long")))
    distinct = found.select("fingerprint").distinct()
    cells = distinct.select((quarter(48) * 289 + quarter(32) * 17 + quarter(16)).alias("cell"), "fingerprint")
    counts = [(r[0] // 289, r[0] // 17 % 17, r[0] % 17, r[1]) for r in cells.groupBy("cell").count().collect()]  # 17^3 at most
    placed, partners = _blocks(counts, radius, tile)
    where = spark.createDataFrame(placed, "cell int, block int, parts int")
    tiles = keep(
        cells.join(F.broadcast(where), "cell")
        .groupBy("block", F.pmod(F.xxhash64("fingerprint"), "parts").cast("int").alias("part"))
        .agg(F.collect_list("fingerprint").alias("prints")),
        "simhash-tiles",
    )
    to = spark.createDataFrame(partners, "block int, partners array<struct<other:int, parts:int>>")
    met = (
        tiles.join(F.broadcast(to), "block")
        .withColumn("p", F.explode("partners"))
        .withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("p.parts") - 1)))
        .where((F.col("p.other") > F.col("block")) | (F.col("other_part") >= F.col("part")))
        .select("block", "part", "prints", F.col("p.other").alias("to_block"), F.col("other_part").alias("to_part"))
    )
    right = tiles.select(
        F.col("block").alias("to_block"), F.col("part").alias("to_part"), F.col("prints").alias("to_prints")
    )
    pairs = met.join(right, ["to_block", "to_part"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                same = row["block"].as_py() == row["to_block"].as_py() and row["part"].as_py() == row["to_part"].as_py()
                a, b = (row[k].values.to_numpy().view(np.uint64) for k in ("prints", "to_prints"))
                x, y = tile_links(a, None if same else b, radius)
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["left", "right"]
                    )

    return pairs.mapInArrow(compare, "left long, right long")


def stars(found: DataFrame) -> DataFrame:
    """(node, root) for every linked node: root is the smallest node of its component.

    Large and small star contraction alternate until nothing moves; each round is a written table of
    at most as many links as before.
    """
    now = keep(
        found.where("left <> right").select(F.greatest("left", "right").alias("u"), F.least("left", "right").alias("v")).distinct(),
        "simhash-links",
    )
    before = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = seen
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select(F.col("e.a").alias("u"), F.col("e.b").alias("v"))
            .where("u <> v")
            .distinct()
        )
        now = keep(small, "simhash-stars")


def near_duplicates(docs: DataFrame, shingle: int, radius: int, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (signed long) and component_id: the smallest doc_id that links reach."""
    found = keep(fingerprints(docs.select("doc_id", "text"), shingle).drop("text"), "simhash")
    return found.join(classes(found, radius, tile), "fingerprint").select("doc_id", "fingerprint", "component_id")


def classes(found: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """fingerprint, root (the component's least fingerprint) and component_id for each distinct fingerprint."""
    roots = stars(links(found, radius, tile))
    own = found.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    rooted = keep(
        own.join(roots, own["fingerprint"] == roots["node"], "left").select(
            "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
        ),
        "simhash-classes",
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(smallest, "root").select("fingerprint", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int, radius: int, tile: int = TILE) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest doc_id.

    Among rows with that doc_id the one with the smallest fingerprint and text hash stays.
    """
    names = docs.columns
    # A NULL doc_id gets a number of its own, so that plain equality joins.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("key"),
        F.xxhash64("text").alias("hash"),
        F.col("text"),
    )
    found = keep(fingerprints(rows.select("key", "hash", "text"), shingle).drop("text"), "simhash")
    ids = found.select(F.nullif("key", F.lit(NO_ID)).alias("doc_id"), "fingerprint")
    chosen = (
        found.join(classes(ids, radius, tile), "fingerprint")
        .groupBy("root")  # ids may repeat, so two components may have one component_id
        .agg(F.min(F.struct((F.col("key") == NO_ID).alias("none"), "key", "hash")).alias("best"))
        .select("best.key", "best.hash")
        .distinct()
    )
    # Rows that repeat as a whole are one document; the join has dealt them by key and hash already.
    kept = rows.drop("text").join(chosen, ["key", "hash"], "left_semi").dropDuplicates(["key", "hash"])
    return kept.select(*[F.col("doc")[c].alias(c) for c in names])
