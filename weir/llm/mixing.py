"""Mixing sources to target weights by entropy balancing.

Among all document rates from 0 to ``MOST`` that give each source its target of words, the mix takes those
nearest to the documents' own rate of one, by relative entropy. They are exponentially tilted: a document of
``size`` words in source s has the rate ``min(MOST, exp(tilt_s * size / mean_s))``. The tilts solve the convex
dual, whose gradient is words taken minus target, by Newton steps kept within a bracket; each step is a sum
over the table of (source, size) counts. Rates then become whole copies, with the rounding error carried
from long documents to shorter ones, so a source misses its target by about half a short document.

Sums over tasks are of decimals, so reruns agree whatever the order of the tasks.

Defined cases: a NULL text has size 0; documents of size 0 are taken once and add nothing; a NULL source is a
source, the last one; repeated rows are rows like any other; an empty table gives an empty result;
columns other than doc_id, text and source are ignored, or passed on by ``mix``.
"""

from __future__ import annotations

from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.common import keep, word_count

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: No source and no document is taken more often than this.
MOST = 3
#: Newton steps at most, and the miss of a target, as a share of it, that ends them.
STEPS = 60
CLOSE = 1e-7
#: Documents of one source and size, about, that are ranked by one task.
RANKED = 20_000

_EXACT = "decimal(38,9)"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and a hash that breaks ties."""
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("hash")
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """number, source, weight, source_size, target of each source.

    Weights share all words; a source stops at ``most`` times its size and the excess goes to the others by
    weight, until none is above. Ends after as many rounds as sources stop one after the other.
    """
    spark = sized.sparkSession
    totals = keep(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("max_size"), F.count(F.lit(1)).alias("docs")), "mix-sources")
    ordered = totals.orderBy(F.col("source").asc_nulls_last())
    schema = T.StructType([*ordered.schema.fields, T.StructField("number", T.LongType())])
    numbered = spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])), schema)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    numbered = keep(numbered.withColumn("weight", weight.cast("long")), "mix-numbered")
    total = numbered.agg(F.sum("source_size")).first()[0] or 0
    # A source that has stopped takes most * size; the others take level * weight.
    level = 0.0
    stopped_before = -1
    while True:
        stops = F.col("weight") * F.lit(level) >= most * F.col("source_size") if stopped_before >= 0 else F.lit(False)
        row = numbered.agg(
            F.sum(F.when(stops, most * F.col("source_size")).otherwise(0)),
            F.sum(F.when(stops, 0).otherwise(F.col("weight"))),
            F.sum(F.when(stops, 1).otherwise(0)),
        ).first()
        taken, left, stopped = (x or 0 for x in row)
        if stopped == stopped_before or not left:
            break
        level, stopped_before = (total - taken) / left, stopped
    stops = F.col("weight") * F.lit(level) >= most * F.col("source_size")
    target = F.when(stops, (most * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.lit(level))
    return keep(numbered.withColumn("target", target), "mix-targets")


def _rate(tilt: Column, x: Column, most: int) -> Column:
    return F.when(tilt * x >= F.log(F.lit(float(most))), F.lit(float(most))).otherwise(F.exp(tilt * x))


def tilts(counts: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """The tables ``wanted`` with mean_size and the tilt of each source.

    ``counts`` has number, size and n. Each step sums words and their derivative over the counts; a
    step that leaves the bracket halves it instead.
    """
    # At the ends of the bracket the largest document alone decides: its rate is at its cap or next to nothing.
    state = keep(
        wanted.select(
            "number",
            "target",
            "source_size",
            F.greatest(F.col("source_size") / F.col("docs"), F.lit(1.0)).alias("mean_size"),
            F.lit(0.0).alias("tilt"),
            F.lit(-1e9).alias("low"),
            F.lit(1e9).alias("high"),
            ((F.col("target") >= most * F.col("source_size")) | (F.col("target") == F.col("source_size"))).alias("done"),
        ),
        "mix-tilts",
    )
    for _ in range(STEPS):
        x = F.col("size") / F.col("mean_size")
        rate = _rate(F.col("tilt"), x, most)
        words = F.col("n") * F.col("size") * rate
        sums = (
            counts.join(state.where("not done"), "number")
            .groupBy("number")
            .agg(
                F.sum(words.cast(_EXACT)).cast("double").alias("words"),
                F.sum(F.when(rate < most, words * x).otherwise(0.0).cast(_EXACT)).cast("double").alias("slope"),
            )
        )
        miss = F.col("words") - F.col("target")
        low = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - miss / F.when(F.col("slope") > 0, F.col("slope"))
        # Far from the root the derivative says little, so a step is bounded.
        longest = F.abs("tilt") + 2
        near = F.greatest(F.col("tilt") - longest, F.least(F.col("tilt") + longest, newton))
        inside = near.isNotNull() & (near > F.col("new_low")) & (near < F.col("new_high"))
        middle = (
            F.when(F.col("new_high") >= 1e9, F.col("tilt") + longest)
            .when(F.col("new_low") <= -1e9, F.col("tilt") - longest)
            .otherwise((F.col("new_low") + F.col("new_high")) / 2)
        )
        close = F.abs(miss) <= CLOSE * F.greatest(F.col("target"), F.lit(1.0))
        state = keep(
            state.join(sums, "number", "left")
            .withColumn("new_low", F.when(F.col("words").isNull(), F.col("low")).otherwise(low))
            .withColumn("new_high", F.when(F.col("words").isNull(), F.col("high")).otherwise(high))
            .select(
                "number",
                "target",
                "source_size",
                "mean_size",
                F.when(F.col("done") | F.col("words").isNull() | close, F.col("tilt")).when(inside, near).otherwise(middle).alias("tilt"),
                F.col("new_low").alias("low"),
                F.col("new_high").alias("high"),
                (F.col("done") | F.col("words").isNull() | close).alias("done"),
            ),
            "mix-tilts",
        )
        if state.where("not done").isEmpty():
            break
    return state


def _round_source(groups: pd.DataFrame, most: int) -> pd.DataFrame:
    """Whole copies for the groups of one source, from long documents to short ones.

    Each group takes the copies nearest to its own words and those that the groups before it took too
    few or too many of, so what is left over shrinks with the size. Where short documents were at a bound, a second
    pass closes the gap. There is a group for each size, and one more for each ``RANKED`` documents, so a
    source is small here whatever its documents are.
    """
    groups = groups.sort_values(["size", "part"], ascending=[False, True])
    carry, out = 0.0, []
    rows = list(zip(groups["size"].tolist(), groups["n"].tolist(), groups["rate"].tolist(), strict=True))
    for size, n, rate in rows:
        due = n * size * rate + carry
        found = min(max(round(due / size), 0), most * n) if size else n
        carry = due - found * size
        out.append(found)
    for i, (size, n, _) in enumerate(rows):
        more = min(max(round(carry / size), -out[i]), most * n - out[i]) if size else 0
        carry -= more * size
        out[i] += more
    return groups.assign(all_copies=out)


def copies(docs_sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """All columns of ``docs_sized`` with source_size, target, rate, copies and taken.

    ``docs_sized`` has source, size and hash; it is read more than once, so it should be a written table.
    """
    wanted = targets(docs_sized, weights, most)
    parts = F.greatest(F.ceil(F.col("n") / RANKED), F.lit(1)).cast("int")
    same_source = docs_sized["source"].eqNullSafe(wanted["source"])
    by_size = docs_sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    counts = keep(
        by_size.join(wanted.select("source", "number"), by_size["source"].eqNullSafe(wanted["source"]))
        .select("number", "size", "n", parts.alias("parts")),
        "mix-counts",
    )
    solved = tilts(counts, wanted, most)
    numbered = docs_sized.join(wanted.select("source", "number", "source_size", "target"), same_source).drop(wanted["source"])
    placed = keep(
        numbered.join(counts.select("number", "size", "parts"), ["number", "size"]).withColumn(
            "part", F.pmod("hash", "parts").cast("int")
        ),
        "mix-placed",
    )
    groups = placed.groupBy("number", "size", "part").agg(F.count(F.lit(1)).alias("n"))
    full = F.col("target") >= most * F.col("source_size")
    rate = F.when(full & (F.col("source_size") > 0), F.lit(float(most))).otherwise(
        _rate(F.col("tilt"), F.col("size") / F.col("mean_size"), most)
    )
    rated = groups.join(solved.select("number", "mean_size", "tilt", "target", "source_size"), "number").select(
        "number", "size", "part", "n", rate.alias("rate")
    )
    rounded = rated.groupBy("number").applyInPandas(
        partial(_round_source, most=most), "number long, size long, part int, n long, rate double, all_copies long"
    )
    rank = F.row_number().over(Window.partitionBy("number", "size", "part").orderBy("hash"))
    each = F.floor(F.col("all_copies") / F.col("n"))
    more = F.col("all_copies") - each * F.col("n")
    counted = (
        placed.withColumn("rank", rank)
        .join(rounded, ["number", "size", "part"])
        .withColumn("copies", (each + F.when(F.col("rank") <= more, 1).otherwise(0)).cast("int"))
    )
    return counted.select(
        *[F.col(f"`{c}`") for c in docs_sized.columns],
        "source_size",
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed documents, with all their columns: each row as often as it has copies."""
    names = docs.columns
    key = F.xxhash64("source", "doc_id", "text").alias("hash")
    counted = copies(keep(docs.select("source", word_count(F.col("text")).alias("size"), key), "mix-sizes"), weights, most)
    # Rows with one hash are the same document, so its copies are dealt among them by number.
    per_key = keep(counted.groupBy("hash").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")), "mix-keys")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), key)
    rank = F.row_number().over(Window.partitionBy("hash").orderBy("n"))  # dealt as the join has dealt them
    own = F.floor(F.col("copies") / F.col("n")) + F.when(rank <= F.col("copies") % F.col("n"), 1).otherwise(0)
    times = rows.join(per_key, "hash").select("doc", own.cast("int").alias("times")).where("times > 0")
    return times.select("doc", F.explode(F.sequence(F.lit(1), "times"))).select(*[F.col("doc")[c].alias(c) for c in names])
