"""Shards of near equal bytes by histogram sort.

Documents are sorted by (hash of the text, hash of the id, row number), so copies of a text stay together
unless a shard has to end among them. The 15 (or so) splitters are found by counting: each round
sums the exact bytes below a few hundred candidate keys around every splitter that isn't good enough yet, and
refines around the one that is nearest. One exchange follows.

Defined cases: a NULL text has one byte of size and the checksum of no bytes; NULL and repeated ids and
repeated rows are rows like any other, each with its own slot; an empty table gives an empty result; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import keep, running_before

#: A splitter is good when the bytes below it miss their target by at most this share of a shard.
TOLERANCE = 0.001
#: Each round looks at 2^PROBE_BITS candidates for a splitter.
PROBE_BITS = 8
#: Rows, about, whose slots are numbered by one task.
SLOT_BLOCK = 100_000

#: The parts of the sort key, each a signed long.
KEY = ("text_hash", "id_hash", "row")
_LOW = -(1 << 63)


@dataclass
class Probe:
    """Where the splitter for one target may lie: keys that start with ``fixed`` and then ``bits`` of ``prefix``."""

    target: float
    fixed: tuple[int, ...] = ()
    bits: int = 0
    prefix: int = 0
    below: int = 0
    found: tuple[int, ...] | None = None
    error: float = field(default=float("inf"))

    def place(self) -> tuple:
        """What rows have in common among which this probe looks."""
        return self.fixed, self.bits, self.prefix

    def offer(self, key: tuple[int, ...], below: int) -> None:
        """Take ``key`` as the splitter if it is nearer than any before."""
        if abs(below - self.target) < self.error:
            self.found, self.error = key, abs(below - self.target)


def sort_keys(docs: DataFrame) -> DataFrame:
    """The written table of doc_id, size, text_crc32 and the sort key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return keep(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
            F.xxhash64("doc_id").alias("id_hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-keys",
    )


def _unsigned_top(part: str, bits: int) -> Column:
    """The first ``bits`` bits of a key part, in the order of signed longs."""
    return F.shiftrightunsigned(F.col(part).bitwiseXOR(F.lit(_LOW)), 64 - bits)


def _count(keys: DataFrame, places: list[tuple]) -> dict[tuple, list]:
    """For each place: (piece, bytes, rows, smallest and largest value of the key part) in order of the piece."""
    which, piece, part = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for n, (fixed, bits, prefix) in enumerate(places):
        name = KEY[len(fixed)]
        inside = F.lit(True)
        for k, value in zip(KEY, fixed, strict=False):
            inside = inside & (F.col(k) == value)
        if bits:
            inside = inside & (_unsigned_top(name, bits) == prefix)
        which = F.when(inside, F.lit(n)).otherwise(which)
        step = _unsigned_top(name, bits + PROBE_BITS).bitwiseAND(F.lit((1 << PROBE_BITS) - 1))
        piece = F.when(inside, step).otherwise(piece)
        part = F.when(inside, F.col(name)).otherwise(part)
    rows = (
        keys.select("size", which.alias("which"), piece.alias("piece"), part.alias("part"))
        .where("which is not null")
        .groupBy("which", "piece")
        .agg(F.sum("size"), F.count(F.lit(1)), F.min("part"), F.max("part"))
        .collect()  # at most 2^PROBE_BITS rows for each splitter
    )
    out: dict[tuple, list] = {p: [] for p in places}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        out[places[r[0]]].append(tuple(r)[1:])
    return out


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, ...]]:
    """The keys at which shards 1, 2, ... begin; a shorter key stands for the smallest that starts with it."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    probes = [Probe(total * k / shards) for k in range(1, shards)]
    active = probes if total else []
    while active:
        counted = _count(keys, list(dict.fromkeys(p.place() for p in active)))
        still = []
        for p in active:
            below, pieces = p.below, counted[p.place()]
            for at, (piece, size, rows, low, high) in enumerate(pieces):
                # The candidates are the smallest keys of the pieces that have rows.
                p.offer((*p.fixed, low), below)
                if below + size > p.target:
                    break
                below += size
            if at + 1 < len(pieces):
                p.offer((*p.fixed, pieces[at + 1][3]), below + size)
            if p.error <= tolerance * total / shards or rows == 1:
                continue
            p.below = below
            if low < high:
                p.bits, p.prefix = p.bits + PROBE_BITS, p.prefix << PROBE_BITS | piece
            elif len(p.fixed) + 1 < len(KEY):
                p.fixed, p.bits, p.prefix = (*p.fixed, low), 0, 0
            else:
                continue
            still.append(p)
        active = still
    return [p.found or (_LOW,) for p in probes] if total else [(_LOW,)] * (shards - 1)


def shard_of(found: list[tuple[int, ...]]) -> Column:
    """The shard of a row with a sort key: how many splitters are at or below it."""
    number = F.lit(0)
    for key in found:
        reached = F.lit(True)
        for name, value in reversed(list(zip(KEY, key, strict=False))):
            reached = (F.col(name) > value) | ((F.col(name) == value) & reached)
        number = number + F.when(reached, 1).otherwise(0)
    return number.cast("int")


def shards(docs: DataFrame, number: int, tolerance: float = TOLERANCE, block: int = SLOT_BLOCK) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot: the place in the shard, from 0 without gaps.

    Slots follow the sort key. A range of the key with many rows, which a hot text can be, is numbered in parts.
    """
    keys = sort_keys(docs)
    placed = keys.withColumn("shard", shard_of(splitters(keys, number, tolerance)))
    placed = placed.withColumn("range", _unsigned_top("text_hash", 12))
    dense = keep(
        placed.groupBy("shard", "range")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("part_bits", F.ceil(F.log2(F.greatest(F.col("n") / block, F.lit(1.0)))).cast("int"))
        .where("part_bits > 0")
        .drop("n"),
        "shard-ranges",
    )  # at most 4096 rows and one for each shard
    part = F.when(
        F.col("part_bits") > 0,
        F.call_function("shiftrightunsigned", F.col("id_hash").bitwiseXOR(F.lit(_LOW)), 64 - F.col("part_bits")),
    ).otherwise(F.lit(0).cast("long"))
    blocked = (
        placed.join(F.broadcast(dense), ["shard", "range"], "left")
        .withColumn("block", F.struct("range", part.alias("part")))
        .withColumn("one", F.lit(1).cast("long"))
    )
    numbered = running_before(blocked, ["shard"], "block", list(KEY), "one", "slot")
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot")
