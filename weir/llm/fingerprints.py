"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, weighted by how often they occur. For each of ``SAMPLES`` samples every
term draws two gamma variates r and c and a uniform b, fixed by the term and the number of the sample. With
t = floor(ln(weight) / r + b), the term with the smallest c * exp(-r * (t - b + 1)) is the sample, together with its t.
Two texts have a sample in common with the probability of their generalised Jaccard similarity, the sum of
the smaller weights over the sum of the larger ones. A sample is kept as 16 bits, so two different samples
look alike once in 65,000 times.

Defined cases: a NULL text is empty; an empty or wordless text has the fingerprint of zeros, which is like itself and
like no other; equal texts have equal fingerprints; repeated rows are rows like any other, next to each other
in the order; ids that are NULL come last; the next document of the only one is itself; an empty table gives an
empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import small_batches

SAMPLES = 128
#: Terms whose scores a task remembers; each takes half a KB.
REMEMBERED = 240_000
#: Terms of one text that are looked at together.
TERMS_AT_ONCE = 8_000
#: Bytes of text whose results are in memory at a time.
BATCH_BYTES = 4 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of the splitmix64 generator, in place."""
    part = np.empty_like(x)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        np.right_shift(x, np.uint64(shift), out=part)
        np.bitwise_xor(x, part, out=x)
        np.multiply(x, np.uint64(factor), out=x)
    np.right_shift(x, np.uint64(31), out=part)
    return np.bitwise_xor(x, part, out=x)


def variates(hashes: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln(c) and b for each term and sample; r and c have the gamma distribution of shape 2."""
    steps = np.arange(1, 3 * samples + 1, dtype=np.uint64) * _GOLDEN
    halves = _mixed(hashes[:, None] + steps).view(np.uint32).reshape(len(hashes), 3 * samples, 2)

    def gamma(at: int) -> np.ndarray:
        uniform = halves[:, at : at + samples].astype(np.float32) + np.float32(0.5)  # 2^32 times as large
        return np.maximum(np.float32(64 * np.log(2)) - np.log(uniform[..., 0] * uniform[..., 1]), np.float32(1e-6))

    b = np.minimum(halves[:, 2 * samples :, 0].astype(np.float32) * np.float32(2**-32), np.float32(1 - 2**-24))
    return gamma(0), np.log(gamma(samples)), b


class Memory:
    """Rows of numbers for terms; the half that was used least is forgotten when there is no room."""

    def __init__(self, room: int, samples: int, tables: int) -> None:
        self.room = room
        self.slots: dict[bytes, int] = {}
        self.hashes = np.zeros(room, np.uint64)
        self.hits = np.zeros(room, np.int64)
        self.tables = [np.zeros((room, samples), np.float32) for _ in range(tables)]

    def rows(self, terms: list[bytes], make: Callable[[np.ndarray], tuple[np.ndarray, ...]]) -> np.ndarray:
        """The rows of terms; ``make`` gives the numbers of those that aren't there from their hashes."""
        found = np.fromiter(map(self.slots.get, terms, repeat(-1)), np.int64, len(terms))
        missing = np.flatnonzero(found < 0)
        if len(self.slots) + len(missing) > self.room:
            self._forget()
            return self.rows(terms, make)
        if len(missing):
            new, at = [terms[i] for i in missing.tolist()], len(self.slots)
            to = slice(at, at + len(new))
            self.hashes[to] = np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))
            self.slots.update(zip(new, range(at, at + len(new)), strict=True))
            for table, numbers in zip(self.tables, make(self.hashes[to]), strict=True):
                table[to] = numbers
            found[missing] = np.arange(at, at + len(new))
        self.hits[found] += 1
        return found

    def _forget(self) -> None:
        kept = np.sort(np.argsort(-self.hits[: len(self.slots)], kind="stable")[: self.room // 2])
        names = list(self.slots)
        self.slots = {names[old]: new for new, old in enumerate(kept.tolist())}
        for table in (self.hashes, *self.tables):
            table[: len(kept)] = table[kept]
        self.hits[:] = 0


class Sampler:
    """Fingerprints of texts, with the numbers of frequent terms remembered."""

    def __init__(self, samples: int = SAMPLES, remembered: int = REMEMBERED) -> None:
        self.samples = samples
        # The scores of terms that occur once, and r, ln(c) and b of terms that occur more often.
        self.once = Memory(max(remembered, 2 * TERMS_AT_ONCE), samples, 1)
        self.more = Memory(max(remembered // 16, 2 * TERMS_AT_ONCE), samples, 3)

    def fingerprint(self, text: str) -> np.ndarray:
        """The samples of a text as 16-bit numbers, 0 where it has no words."""
        weights = Counter(text.encode("utf-8", "surrogatepass").split())
        if not weights:
            return np.zeros(self.samples, np.uint16)
        best = np.full(self.samples, np.inf, np.float32)
        sample = np.zeros(self.samples, np.uint64)
        single = [t for t, n in weights.items() if n == 1]
        repeated = [t for t, n in weights.items() if n > 1]
        for terms, scored in ((single, self._single), (repeated, self._repeated)):
            for at in range(0, len(terms), TERMS_AT_ONCE):
                hashes, score, t = scored(terms[at : at + TERMS_AT_ONCE], weights)
                first = score.argmin(axis=0)
                column = np.arange(self.samples)
                least, chosen = score[first, column], hashes[first]
                if t is not None:
                    chosen = chosen ^ (t[first, column].astype(np.int64).view(np.uint64) * _GOLDEN)
                # Among equal scores, which rounding makes possible, the larger number wins.
                better = (least < best) | ((least == best) & (chosen > sample))
                best, sample = np.where(better, least, best), np.where(better, chosen, sample)
        return (_mixed(sample) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _single(self, terms: list[bytes], weights: Counter) -> tuple:
        def score(hashes: np.ndarray) -> tuple[np.ndarray]:
            r, ln_c, b = variates(hashes, self.samples)
            return (ln_c + r * (b - 1),)

        rows = self.once.rows(terms, score)
        return self.once.hashes[rows], self.once.tables[0][rows], None

    def _repeated(self, terms: list[bytes], weights: Counter) -> tuple:
        rows = self.more.rows(terms, lambda hashes: variates(hashes, self.samples))
        r, ln_c, b = (table[rows] for table in self.more.tables)
        weight = np.array([weights[t] for t in terms], np.float32)
        t = np.floor(np.log(weight)[:, None] / r + b)
        return self.more.hashes[rows], ln_c - r * (t - b + 1), t


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of samples that two fingerprints have in common."""
    return float(np.mean(a == b))


def spelled(samples: np.ndarray) -> str:
    """A fingerprint as hexadecimal digits."""
    return samples.astype(">u2").tobytes().hex()


def ordered_with_next(docs: DataFrame, buckets: int, partitions: int) -> DataFrame:
    """doc_id, text, bucket and guest, dealt by bucket and sorted by descending doc_id.

    A bucket is a range of ids; there are several for each partition, so that partitions come out alike. The row after its last one, which is the first of the next bucket, stands behind
    it as a guest, so every task has each row's next one. The texts are shuffled once; guests are a row a bucket.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / buckets for i in range(1, buckets)]
    bounds = np.array(sorted(set(docs.approxQuantile("doc_id", shares, 0.2 / buckets))), np.float64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        found = len(bounds) - np.searchsorted(bounds, ids.to_numpy(np.float64, na_value=-np.inf), side="right")
        return pd.Series(found.astype(np.int32))

    # NULL ids come after all others, in a bucket of their own.
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(range_of("doc_id"))
    placed = rows.withColumn("tie", F.xxhash64("text")).withColumn("bucket", bucket)
    heads = placed.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
    # One row for each bucket.
    around = Window.orderBy("bucket")
    first = F.first("head").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = heads.select("bucket", F.coalesce(F.lead("head").over(around), first).alias("head"))
    wanted = following.select(
        F.col("bucket").alias("to"), F.col("head.doc_id").alias("head_id"), F.col("head.tie").alias("head_tie")
    )
    guests = (
        placed.join(F.broadcast(wanted), placed["doc_id"].eqNullSafe(wanted["head_id"]) & (placed["tie"] == wanted["head_tie"]))
        .groupBy("to")
        .agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("tie").alias("tie"))
        .select("doc_id", "text", "tie", F.col("to").alias("bucket"), F.lit(1).alias("guest"))
    )
    both = placed.withColumn("guest", F.lit(0)).select("doc_id", "text", "tie", "bucket", "guest").union(guests)
    return (
        both.repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
        .drop("tie")
    )


def edited_text(text: str, following: str) -> str:
    """The text with its last half replaced by as many characters of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, samples: int = SAMPLES, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each document."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        before = None  # the row before, with its fingerprint
        for batch in small_batches(batches, "text", BATCH_BYTES):
            out = []
            for doc_id, text, bucket, guest in zip(*(batch.column(c) for c in ("doc_id", "text", "bucket", "guest")), strict=True):
                row = doc_id.as_py(), text.as_py(), bucket.as_py(), guest.as_py()
                own = sampler.fingerprint(row[1])
                if before and not before[0][3]:
                    (last_id, last_text, _, _), last = before
                    edited = edited_text(last_text, row[1])
                    changed = sampler.fingerprint(edited)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((last_id, len(last_text), digest, spelled(last), spelled(changed), likeness(last, changed), likeness(last, own)))
                before = row, own
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered_with_next(docs, buckets or 4 * partitions, partitions).mapInArrow(run, schema)
