"""Removal of long repeated strings by a collection's Burrows-Wheeler transform, built column by column.

A byte goes if it is covered by a string of ``length`` bytes, by default ``LENGTH``, that starts anywhere else too. Windows that can
be equal are brought together, and the suffixes of the texts around them are sorted by column-wise construction:
each round puts one more symbol of every text in front, finds where the longer suffixes go from
where the shorter ones stood, and updates the transform and the common prefixes of neighbours. Windows whose
suffix shares ``length`` bytes with a neighbour are repeated.

A round costs a pass over all that was inserted before, so the construction needs many short texts rather than
few long ones. Hence, before it:

* A window's key is the least hash of the 16-byte strings in it. Equal windows have equal keys, so a stretch of windows
  with a key that no other stretch has is unique, unless the key's place moves within it, and stretches with one key and
  equal bytes are repeated as they are. Only keys whose stretches differ, or move, are contested.
* Contested stretches are cut into blocks of ``BLOCKS[0]`` windows, aligned at the place of the key, and
  compared again by the bytes that all windows of a block share. What is still contested, about one block for each
  end of a repeated run, goes into the construction, in collections of bounded size. There the shared bytes
  are one symbol, so a text has about 128 columns.
* A group that is too large for one collection is cut into smaller blocks, down to single windows,
  so a passage in any number of documents never meets in one task.

Stretches and blocks are compared by two hashes of 48 and 64 bits or of 64 bits each; the rest is exact. Nothing is dropped or capped.

Defined cases: a NULL text is empty; texts shorter than ``length`` lose nothing; texts that occur twice lose
everything if they are as long; repeated rows count as occurrences of their own; an empty table gives an
empty result; columns other than doc_id and text are ignored, or passed on by ``remove_repeats``. A text that
was cut in the midst of a character keeps only whole characters; one that loses all its bytes becomes empty.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.common import discard, keep, keep_at

LENGTH = 400
#: Bytes that make a hash; a power of two.
GRAM = 16
#: Windows of a block, at first and for groups that are too large.
BLOCKS = (64, 8, 1)
#: Texts of one collection, about, and texts of one group that may go into one.
COLLECTION = 2_000
LARGEST_GROUP = 8_000
#: Windows whose hashes are in memory at a time; their places fit into ``PLACE_BITS`` bits.
WINDOWS_AT_ONCE = 1 << 15
PLACE_BITS = np.uint64(16)

#: A word, as bytes.
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_TABLE = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of 64 - PLACE_BITS bits of the ``GRAM`` bytes that start at each place."""
    found, size = _TABLE[data], 1
    while size < GRAM:
        left, right = found[:-size], found[size:]
        found = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(6364136223846793005)
        size *= 2
    return (found ^ (found >> np.uint64(32))) >> PLACE_BITS


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on."""
    count = len(values) - width + 1
    rows = np.concatenate((values, np.full(-len(values) % width, ~np.uint64(0)))).reshape(-1, width)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    since = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[:count], upto[width - 1 : width - 1 + count])


def stretches(data: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, bool]]:
    """(first window, windows, key, whether the key's place moves) of runs of windows with one key.

    A window's place is the first at which its key is found. While it stays, no two windows can be equal, since
    equal windows have it at the same distance.
    """
    windows = len(data) - length + 1
    for at in range(0, windows, WINDOWS_AT_ONCE):
        part = np.frombuffer(data, np.uint8, min(WINDOWS_AT_ONCE, windows - at) + length - 1, at)
        hashes = gram_hashes(part)
        least = window_minima(hashes << PLACE_BITS | np.arange(len(hashes), dtype=np.uint64), length - GRAM + 1)
        keys = least >> PLACE_BITS
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts = np.diff(np.append(first, len(keys)))
        moves = least[first] != least[first + counts - 1]
        yield from zip((first + at).tolist(), counts.tolist(), keys[first].tolist(), moves.tolist(), strict=True)


def _signed(data: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(data)
    return value - (1 << 64) if value >> 63 else value


def blocks(data: bytes, key: int, size: int, length: int = LENGTH) -> dict[tuple[int, int], list]:
    """Blocks of at most ``size`` windows of a text all of whose windows have ``key``.

    For each (hash of the bytes that the block's windows share, hash of its own bytes): windows, bytes before the shared
    ones and first windows.
    """
    windows = len(data) - length + 1
    places = np.flatnonzero(gram_hashes(np.frombuffer(data, np.uint8)) == key)
    starts = np.arange(windows)
    place = places[np.searchsorted(places, starts)]  # the first place of the key in each window
    number = (place - starts) // size
    cut = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (number[1:] != number[:-1]))))
    out: dict[tuple[int, int], list] = {}
    rows = zip(cut.tolist(), np.append(cut[1:], windows).tolist(), place[cut].tolist(), number[cut].tolist(), strict=True)
    for first, after, at, n in rows:
        begin = at - n * size
        shared = data[begin : begin + length - size + 1]
        names = _signed(shared + n.to_bytes(2, "little") + key.to_bytes(8, "little")), _signed(data[first : after - 1 + length])
        out.setdefault(names, [after - first, begin - first]).append(first)
    return out


def construct(texts: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of a collection in order, and the common prefixes of neighbours.

    Column by column: in round j the suffixes of j symbols are inserted. A suffix is its first symbol and the place of
    the rest, which is known from the round before; among the suffixes that start with that symbol it stands in the
    order of those places. So ``rest``, the place of each suffix's rest, holds the transform: its symbol is the
    one whose segment leads there.

    Symbols are numbers below ``len(weights)``; common prefixes are sums of their symbols' weights. Returns ``rest`` and
    ``common`` over all suffixes, the empty ones of each text first.
    """
    count = len(texts)
    lengths = np.array([len(t) for t in texts])
    by_column = np.zeros((int(lengths.max(initial=0)), count), np.int64)  # row j: the symbols j from the end
    for i, t in enumerate(texts):
        by_column[: len(t), i] = t[::-1]
    place = np.arange(count)
    rest = np.full(count, -1)
    common = np.zeros(count, np.int16)
    segment = np.full(len(weights) + 1, count)  # where the suffixes that start with a symbol begin
    for j in range(len(by_column)):
        active = np.flatnonzero(lengths > j)
        symbols, before = by_column[j, active], place[active]
        order = np.lexsort((before, symbols))
        active, symbols, before = active[order], symbols[order], before[order]
        used, first = np.unique(symbols, return_index=True)
        ends = np.append(first[1:], len(symbols))
        at = np.empty(len(symbols), np.int64)
        for c, lo, hi in zip(used.tolist(), first.tolist(), ends.tolist(), strict=True):
            begin = segment[c]
            at[lo:hi] = begin + rest[begin : segment[c + 1]].searchsorted(before[lo:hi])
        new = at + np.arange(len(at))
        total = len(rest) + len(at)
        merged = np.insert(rest, at, before)  # still places before this round
        grown = np.insert(common, at, 0)
        starts = segment + np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=len(weights)))))
        # Neighbours of which one is new share their first symbol and what their rests share, or nothing.
        touched = np.concatenate((new, np.setdiff1d(new + 1, new, assume_unique=True)))
        touched = touched[touched < total]
        symbol = starts.searchsorted(touched, side="right") - 1
        same = starts[symbol] < touched
        inner = touched[same]
        grown[touched] = 0
        if len(inner):
            grown[inner] = weights[symbol[same]] + _range_minima(common, merged[inner - 1] + 1, merged[inner])
        is_old = np.ones(total, bool)
        is_old[new] = False
        merged[count:] = np.flatnonzero(is_old).take(merged[count:])  # where what was there has gone
        rest, common, segment = merged, grown, starts
        place = place.copy()
        place[active] = new
    return rest, common


def _range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value from each ``first`` to its ``last``, both included."""
    levels = np.log2(last - first + 1).astype(np.int64)
    out = np.empty(len(first), values.dtype)
    table = values
    for level in range(int(levels.max()) + 1):
        if level:
            half = 1 << (level - 1)
            table = np.minimum(table[:-half], table[half:])
        chosen = levels == level
        if chosen.any():
            out[chosen] = np.minimum(table[first[chosen]], table[last[chosen] - (1 << level) + 1])
    return out


def repeated_windows(texts: list[bytes], before: list[int], shared: int, length: int = LENGTH) -> list[np.ndarray]:
    """For each text of a collection the first windows that also start anywhere else in it, as a mask.

    All windows of a text contain the ``shared`` bytes that stand behind its first ``before`` ones. Such bytes are one
    symbol, by their value; the others are a symbol each.
    """
    names: dict[bytes, int] = {}
    spelled = []
    for text, at in zip(texts, before, strict=True):
        middle = names.setdefault(text[at : at + shared], 256 + len(names))
        spelled.append(np.array([*text[:at], middle, *text[at + shared :]], np.int64))
    weights = np.ones(256 + len(names), np.int16)
    weights[256:] = shared
    rest, common = construct(spelled, weights)
    long = common >= length
    twice = long | np.append(long[1:], False)
    count = len(texts)
    back = np.full(len(rest), -1)  # the place of the suffix that is one symbol longer
    back[rest[count:]] = np.arange(count, len(rest))
    masks = [np.zeros(len(t) - length + 1, bool) for t in texts]
    lengths = np.array([len(t) for t in spelled])
    place = np.arange(count)
    for j in range(1, int(lengths.max(initial=0)) + 1):
        active = lengths >= j
        place[active] = back[place[active]]
        for i in np.flatnonzero(active & twice[place]).tolist():
            masks[i][lengths[i] - j] = True
    return masks


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return [(a, b - 1) for a, b in edges.reshape(-1, 2).tolist()]


def _table(columns: dict[str, list], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
    arrays = [pa.array(columns[f.name], kinds[f.dataType.simpleString()]) for f in schema.fields]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_L, _I, _B = T.LongType(), T.IntegerType(), T.BinaryType()
_STRETCHES = _struct(d1=_L, d2=_L, key=_L, own=_L, first=_I, windows=_I, moves=T.BooleanType())
_PASSAGES = _struct(d1=_L, d2=_L, start=_I, end=_I, passages=T.ArrayType(_L))
_ITEMS = _struct(a=_L, b=_L, key=_L, n=_L, data=_B)
_BLOCKS = _struct(c=_L, e=_L, a=_L, b=_L, key=_L, n=_L, windows=_I, before=_I, firsts=T.ArrayType(_I))
_FOUND = _struct(a=_L, b=_L, first=_I, last=_I)


def document_keys() -> list[Column]:
    """Two hashes that name a document's row; rows that repeat as a whole share them."""
    return [
        F.xxhash64("doc_id", "text").alias("d1"),
        F.xxhash64("text", "doc_id", F.lit(1)).alias("d2"),
    ]


def _find_stretches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _STRETCHES.names}
        for d1, d2, text in zip(*(batch.column(c) for c in ("d1", "d2", "text")), strict=True):
            data = (text.as_py() or "").encode()
            if len(data) < length:
                continue
            name = d1.as_py(), d2.as_py()
            for first, windows, key, moves in stretches(data, length):
                row = (*name, key, _signed(data[first : first + windows - 1 + length]), first, windows, moves)
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
        yield _table(out, _STRETCHES)


def _cut_out(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
            data = (text.as_py() or "").encode()
            rows = wanted.as_py()
            yield _table(
                {
                    "a": [w["key"] for w in rows],
                    "b": [w["own"] for w in rows],
                    "key": [w["key"] for w in rows],
                    "n": [w["n"] for w in rows],
                    "data": [data[w["first"] : w["first"] + w["windows"] - 1 + length] for w in rows],
                },
                _ITEMS,
            )


def settle(
    items: DataFrame, sizes: tuple[int, ...] = BLOCKS, collection: int = COLLECTION, largest: int = LARGEST_GROUP, length: int = LENGTH
) -> DataFrame:
    """The runs of repeated windows of each item: a, b, first, last.

    An item is a text of bytes named by (a, b), all of whose windows have ``key``, that occurs ``n`` times. No two
    items have the same name, and an equal window in two items means that they have the same ``a``.
    """
    size = sizes[0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _BLOCKS.names}
            for a, b, key, n, data in zip(*(batch.column(c).to_pylist() for c in _ITEMS.names), strict=True):
                for (c, e), (windows, before, *firsts) in blocks(data, key, size, length).items():
                    row = c, e, a, b, key, n * len(firsts), windows, before, firsts
                    for column, value in zip(out.values(), row, strict=True):
                        column.append(value)
            yield _table(out, _BLOCKS)

    def solve(table: pa.Table) -> pa.Table:
        a, b, n, before, data = (table.column(c).to_pylist() for c in ("a", "b", "n", "before", "data"))
        out: dict[str, list] = {name: [] for name in _FOUND.names}
        for *name, times, mask in zip(a, b, n, repeated_windows(data, before, length - size + 1, length), strict=True):
            for first, last in _runs(mask) if times == 1 else ():  # of the others all windows are repeated
                for column, value in zip(out.values(), (*name, first, last), strict=True):
                    column.append(value)
        return pa.Table.from_batches([_table(out, _FOUND)])

    spark = items.sparkSession
    every, blocks_at = keep_at(items.mapInArrow(cut, _BLOCKS), "repeats-blocks")
    # A block that is alone with its shared bytes is unique; blocks that are equal are repeated.
    kinds = every.groupBy("c").agg(F.sum("n").alias("total"), F.min("e").alias("low"), F.max("e").alias("high"))
    shared, shared_at = keep_at(
        every.join(kinds.where("total > 1").select("c", (F.col("low") < F.col("high")).alias("contested")), "c"),
        "repeats-shared",
    )
    discard(spark, blocks_at)
    run = lambda rows, first, last: rows.select("a", "b", first.cast("int").alias("first"), last.cast("int").alias("last"))
    equal = shared.where("not contested").withColumn("at", F.explode("firsts"))
    found = [
        run(equal, F.col("at"), F.col("at") + F.col("windows") - 1),
        run(items.where("n > 1"), F.lit(0), F.octet_length("data") - length),
    ]
    contested = shared.where("contested")
    chosen = (
        contested.groupBy("c", "e")
        .agg(F.sum("n").alias("n"), F.min(F.struct("a", "b", F.element_at("firsts", 1).alias("at"), "windows", "before", "key")).alias("of"))
        .select("c", "e", "n", "of.*")
    )
    texts, texts_at = keep_at(
        chosen.join(items.select("a", "b", "data"), ["a", "b"]).select(
            F.col("c").alias("a"),
            F.col("e").alias("b"),
            "key",
            "n",
            "before",
            F.substring("data", F.col("at") + 1, F.col("windows") + length - 1).alias("data"),
        ),
        "repeats-texts",
    )
    group_sizes = texts.groupBy("a").agg(F.count(F.lit(1)).alias("size"))
    large = keep(group_sizes.where(F.col("size") > largest).select("a"), "repeats-large")
    total = texts.count()
    if total:
        number = max(1, -(-total // collection))
        small = texts.join(large, "a", "left_anti").withColumn("collection", F.pmod("a", F.lit(number)))
        solved = small.groupBy("collection").applyInArrow(solve, _FOUND)
        solved = solved.union(run(texts.where("n > 1"), F.lit(0), F.octet_length("data") - length))
        if not large.isEmpty():
            solved = solved.union(settle(texts.join(large, "a", "left_semi").select(*_ITEMS.names), sizes[1:], collection, largest, length))
        solved = solved.select(F.col("a").alias("c"), F.col("b").alias("e"), F.col("first").alias("low"), F.col("last").alias("high"))
        back = contested.join(solved, ["c", "e"]).withColumn("at", F.explode("firsts"))
        found.append(run(back, F.col("at") + F.col("low"), F.col("at") + F.col("high")))
    every_run = found[0]
    for more in found[1:]:
        every_run = every_run.union(more)
    runs = keep(every_run, "repeats-runs")
    discard(spark, shared_at)
    discard(spark, texts_at)
    return runs


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """d1, d2 and spans: the places [start, end) that repeated strings cover in each document that has any."""
    if length < GRAM + BLOCKS[0]:
        raise ValueError(f"a repeated string has {GRAM + BLOCKS[0]} bytes at least, for its hashes and blocks")
    keyed = docs.select(*document_keys(), F.coalesce("text", F.lit("")).alias("text"))
    every, stretches_at = keep_at(keyed.mapInArrow(lambda batches: _find_stretches(batches, length), _STRETCHES), "repeats-stretches")
    kinds = every.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        ((F.min("own") < F.max("own")) | F.max("moves")).alias("contested"),
    )
    shared = keep(
        every.join(kinds.where("n > 1 or contested").select("key", "contested"), "key"),
        "repeats-keys",
    )
    discard(docs.sparkSession, stretches_at)
    contested = shared.where("contested")
    chosen = (
        contested.groupBy("key", "own")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d1", "d2", "first", "windows")).alias("at"))
        .groupBy("at.d1", "at.d2")
        .agg(F.collect_list(F.struct("key", "own", "n", "at.first", "at.windows")).alias("wanted"))  # a document's own
    )
    once = keyed
    if not keyed.groupBy("d1", "d2").count().where("count > 1").isEmpty():
        once = keyed.dropDuplicates(["d1", "d2"])
    wanted = once.join(chosen, ["d1", "d2"]).select("text", "wanted")
    items, items_at = keep_at(wanted.mapInArrow(lambda batches: _cut_out(batches, length), _ITEMS), "repeats-items")
    settled = settle(items, length=length)
    discard(docs.sparkSession, items_at)
    runs = settled.select(F.col("a").alias("key"), F.col("b").alias("own"), F.col("first").alias("low"), "last")
    equal = shared.where("not contested").select(
        "d1", "d2", F.col("first").alias("start"), (F.col("first") + F.col("windows") - 1 + length).alias("end")
    )
    inside = contested.join(runs, ["key", "own"]).select(
        "d1", "d2", (F.col("first") + F.col("low")).alias("start"), (F.col("first") + F.col("last") + length).alias("end")
    )
    return equal.union(inside).groupBy("d1", "d2").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted spans with those that touch or overlap joined."""
    out: list[list[int]] = []
    for s in spans or ():
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return [(a, b) for a, b in out]


def _whole_words(data: bytes, start: int, end: int) -> list[tuple[int, int]]:
    """The places of the words of data[start:end] that no end of it cuts."""
    cut_first = start > 0 and not data[start - 1 : start].isspace()
    cut_last = end < len(data) and not data[end : end + 1].isspace()
    places = [m.span() for m in _WORD.finditer(data, start, end)]
    return [(a, b) for a, b in places if not (cut_first and a == start) and not (cut_last and b == end)]


def _long_runs(data: bytes, spans: list[dict], length: int, least_words: int) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, passages) of the runs of repeated windows that have ``least_words`` whole words or ``LENGTH`` bytes.

    The passages are the hashes of each ``least_words`` words in a row, with what is between.
    """
    runs: list[dict] = []
    for s in spans:
        if runs and s["start"] <= runs[-1]["end"] - length + 1:  # its first window is the next one
            runs[-1]["end"] = max(runs[-1]["end"], s["end"])
        else:
            runs.append(dict(s))
    for start, end in ((s["start"], s["end"]) for s in runs):
        words = _whole_words(data, start, end)
        passages = [_signed(data[a[0] : b[1]]) for a, b in zip(words, words[least_words - 1 :], strict=False)]
        if passages or end - start >= LENGTH:
            yield start, end, passages


def _passage_spans(docs: DataFrame, length: int, least_words: int) -> DataFrame:
    """d1, d2 and spans: runs of repeated strings of ``length`` bytes that have ``LENGTH`` bytes or a repeated passage of words.

    Short strings that repeat in different places can join into a run of which no passage of ``least_words`` words
    repeats as a whole. So the passages of a run are counted by their hashes. Those that occur once come out of the
    count with their run, which stays if it has more passages than these; a passage that occurs often is one row
    of a task after the first combination, and is joined with nothing.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _PASSAGES.names}
            for d1, d2, text, spans in zip(*(batch.column(c) for c in ("d1", "d2", "text", "spans")), strict=True):
                for run in _long_runs(text.as_py().encode(), spans.as_py(), length, least_words):
                    for values, value in zip(out.values(), (d1.as_py(), d2.as_py(), *run), strict=True):
                        values.append(value)
            yield _table(out, _PASSAGES)

    texts = docs.select(*document_keys(), "text").join(repeated_spans(docs, length), ["d1", "d2"])
    found = keep(texts.mapInArrow(cut, _PASSAGES).withColumn("run", F.xxhash64("d1", "d2", "start")), "repeats-passages")
    passages = found.select("run", F.explode("passages").alias("passage"))
    once = passages.groupBy("passage").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("run")).where("n = 1")
    unique = once.groupBy("run").agg(F.count(F.lit(1)).alias("unique"))
    repeats = F.coalesce("unique", F.lit(0)) < F.size("passages")
    stays = found.join(unique, "run", "left").where(repeats | (F.col("end") - F.col("start") >= LENGTH))
    return stays.groupBy("d1", "d2").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What is left of the bytes without the spans."""
    edges = [0, *[x for s in spans for x in s], len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _with_spans(docs: DataFrame, carried: Column, spans: DataFrame) -> DataFrame:
    """carried, text and spans of each document."""
    rows = docs.select(*document_keys(), carried.alias("carried"), "text")
    return rows.join(spans, ["d1", "d2"], "left").select("carried", "text", "spans")


def removal_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (of the bytes that stay) of each document."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data, joined = (text.as_py() or "").encode(), _merged(spans.as_py())
                kept = _kept(data, joined)
                out.append((len(data), len(data) - len(kept), len(joined), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("carried").cast(pa.int64()), *arrays], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _with_spans(docs, F.col("doc_id"), repeated_spans(docs)).mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH, least_words: int = 0) -> DataFrame:
    """The documents with repeated strings removed from ``text``; all columns and rows stay.

    With ``least_words`` a run of repeated strings goes only if it has a passage of so many whole words that repeats
    itself, or ``LENGTH`` bytes.
    """
    others = [c for c in docs.columns if c != "text"]
    spans = _passage_spans(docs, length, least_words) if least_words else repeated_spans(docs, length)
    spanned = _with_spans(docs, F.struct(*[F.col(f"`{c}`") for c in others]), spans)
    schema = T.StructType(spanned.schema.fields[:2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                joined = _merged(found.as_py())
                texts.append(_kept(text.as_py().encode(), joined).decode("utf-8", "ignore") if joined else text.as_py())
            yield pa.RecordBatch.from_arrays([batch.column("carried"), pa.array(texts, pa.string())], names=schema.names)

    kept = spanned.mapInArrow(run, schema)
    return kept.select(*[F.col("text") if c == "text" else F.col("carried")[c].alias(c) for c in docs.columns])
