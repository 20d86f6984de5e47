"""Quality rules with thresholds that follow each language and source.

Fixed cutoffs are replaced by fences over quantiles: per (lang, source) a mergeable sketch counts the
documents by the bucket of each measure, and a document is rejected where a measure lies far outside the
middle half of its own group. A sketch is a table of counts, so sketches merge by adding: a small
group uses the sketch of its language, a small language that of all documents.

Everything is DataFrame expressions; no Python runs on the executors.

Defined cases: a NULL text has no words and fails the base rules; NULL ``lang`` or ``source`` is a group like
any other; repeated rows count as often as they occur and are judged alike; an empty table gives an
empty result; columns other than the named ones are ignored by ``measure`` and passed on by ``filter_quality``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import WORD_BREAKS, keep, words

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 5

#: Groups with fewer accepted documents use the next larger sketch.
SMALL_GROUP = 100
#: A fence lies this many interquartile ranges outside the quartiles.
FENCE = 6
#: A group's upper fence for a rate is at most so many times its language's and that of all documents.
LOOSEST = 4
#: Up to this many groups the table of thresholds is broadcast; its rows have a fixed size.
BROADCAST_GROUPS = 50_000

#: Measures, in thousandths or hundredths so that they are whole numbers, with the smallest
#: spread taken for the interquartile range and whether the lower fence counts too. The spreads leave room
#: for short texts, whose rates vary by chance.
MEASURES = {
    "symbol_rate": (25, False),
    "dup_line_rate": (10, False),
    "repeat_rate": (25, False),
    "word_length": (50, True),
}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, carried: list[Column]) -> DataFrame:
    """The base counts and the verdict of the base rules, beside the columns ``carried``."""
    names = [f"_c{i}" for i in range(len(carried))]
    split = docs.select(
        *[c.alias(n) for c, n in zip(carried, names, strict=True)],
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
    ).select(
        *names,
        words(F.col("_text")).alias("_words"),
        F.length(F.translate("_text", WORD_BREAKS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", "\n"), lambda x: F.translate(x, WORD_BREAKS, "") != "").alias("_lines"),
    )
    hashed = split.select(
        *names,
        "word_chars",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("_words") >= WINDOW_WORDS,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - WINDOW_WORDS),
                lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW_WORDS)]),
            ),
        ).alias("_windows"),
    )
    # Only texts with a repeated window pay for the sort that finds where the repeats are.
    ranked = hashed.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("_windows")
    repeated = ranked.withColumn(
        "_starts",
        F.array_sort(
            F.transform(
                F.filter(
                    "_sorted",
                    lambda s, i: (F.coalesce(F.get("_sorted", i - 1)["h"] == s["h"], F.lit(False)))
                    | (F.coalesce(F.get("_sorted", i + 1)["h"] == s["h"], F.lit(False))),
                ),
                lambda s: s["i"],
            )
        ),
    ).drop("_sorted")
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW_WORDS).alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW_WORDS), x - a["last"])).alias("n"), x.alias("last")),
        lambda a: a["n"],
    )
    counted = repeated.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_starts")
    return counted.select(
        *names,
        *BASE,
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
    )


def rates(n_words: Column) -> dict[str, Column]:
    """The measures that the thresholds are about; 0 for a text without words."""
    per = F.greatest(n_words, F.lit(1))
    return {
        "symbol_rate": F.floor(1000 * F.col("n_symbols") / per).cast("long"),
        "dup_line_rate": F.floor(1000 * F.col("n_dup_lines") / per).cast("long"),
        "repeat_rate": F.floor(1000 * F.col("n_repeat_words") / per).cast("long"),
        "word_length": F.floor(100 * F.col("word_chars") / per).cast("long"),
    }


def bucket(value: Column) -> Column:
    """The sketch's bucket of a whole number: exact below 64, then 32 buckets for each doubling."""
    shift = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(32 * shift + F.call_function("shiftright", value, shift))


def bucket_value(number: Column) -> Column:
    """The smallest value of a bucket."""
    shift = F.floor(number / 32).cast("int") - 1
    return F.when(number < 64, number).otherwise(F.call_function("shiftleft", number - 32 * shift, shift))


def thresholds(measured: DataFrame) -> DataFrame:
    """Fences for each (lang, source): one row a group, with ``<measure>_low`` and ``<measure>_high``.

    ``measured`` has lang, source, the base counts and ``base_failed``; documents that failed the base rules
    don't shape the fences, but their groups get fences too.

    A group's own junk does not widen its fences: the spread is twice the smaller distance of a quartile
    from the median, quartiles count as at most one spread from it, and the levels of the sketch bound the rates' fences.
    """
    named = rates(F.col("n_words"))
    long = measured.where(~F.col("base_failed")).select(
        "lang", "source", F.explode(F.array(*[
            F.struct(F.lit(name).alias("measure"), bucket(value).alias("bucket")) for name, value in named.items()
        ])).alias("m"),
    )
    sketch = keep(
        long.groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count(F.lit(1)).alias("n")), "quality-sketch"
    )

    def fences(level: str, keys: list[str]) -> DataFrame:
        of_measure = Window.partitionBy(*keys, "measure")
        running = of_measure.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
        placed = merged.withColumn("upto", F.sum("n").over(running)).withColumn("all", F.sum("n").over(of_measure))
        value = bucket_value(F.col("bucket"))
        quartiles = placed.groupBy(*keys, "measure").agg(
            F.max("all").alias("size"),
            F.min(F.when(4 * F.col("upto") >= F.col("all"), value)).alias("q1"),
            F.min(F.when(4 * F.col("upto") >= 3 * F.col("all"), value)).alias("q3"),
            F.min(F.when(2 * F.col("upto") >= F.col("all"), value)).alias("q2"),
        )
        least = F.create_map(*[F.lit(x) for name, (spread, _) in MEASURES.items() for x in (name, spread)])
        q1, q2, q3 = F.col("q1"), F.col("q2"), F.col("q3")
        spread = F.greatest(2 * F.least(q2 - q1, q3 - q2), least[F.col("measure")])
        q1, q3 = F.greatest(q1, q2 - spread), F.least(q3, q2 + spread)
        return quartiles.groupBy(*[F.col(k).alias(f"{level}_{k}") for k in keys]).agg(
            F.max("size").alias(f"{level}_size"),
            *[
                F.max(F.when(F.col("measure") == name, bound)).alias(f"{level}_{name}_{side}")
                for name in MEASURES
                for side, bound in (("low", q1 - FENCE * spread), ("high", q3 + FENCE * spread))
            ],
        )

    groups = measured.select("lang", "source").distinct()
    group, lang = fences("group", ["lang", "source"]), fences("lang", ["lang"])
    overall = fences("all", []).first()  # one row of a few numbers
    joined = (
        groups.join(
            group,
            groups["lang"].eqNullSafe(group["group_lang"]) & groups["source"].eqNullSafe(group["group_source"]),
            "left",
        )
        .join(lang, groups["lang"].eqNullSafe(lang["lang_lang"]), "left")
    )
    chosen = lambda what: (
        F.when(F.col("group_size") >= SMALL_GROUP, F.col(f"group_{what}"))
        .when(F.col("lang_size") >= SMALL_GROUP, F.col(f"lang_{what}"))
        .otherwise(F.lit(overall[f"all_{what}"]).cast("long"))
    )
    def bounded(name: str, side: str) -> Column:
        what = f"{name}_{side}"
        if side == "low" or MEASURES[name][1]:
            return chosen(what)
        of_lang = F.when(F.col("lang_size") >= SMALL_GROUP, LOOSEST * F.col(f"lang_{what}"))
        return F.least(chosen(what), of_lang, LOOSEST * F.lit(overall[f"all_{what}"]).cast("long"))

    return joined.select(
        F.col("lang").alias("of_lang"),
        F.col("source").alias("of_source"),
        *[bounded(name, side).alias(f"{name}_{side}") for name in MEASURES for side in ("low", "high")],
    )


def verdicts(measured: DataFrame) -> DataFrame:
    """Add ``failed_rule`` and ``kept`` by joining each document with the fences of its group."""
    fences = keep(thresholds(measured), "quality-fences")
    if fences.count() <= BROADCAST_GROUPS:
        fences = F.broadcast(fences)
    joined = measured.join(
        fences,
        measured["lang"].eqNullSafe(fences["of_lang"]) & measured["source"].eqNullSafe(fences["of_source"]),
        "left",
    )
    failed = F.when(F.col("base_failed"), F.lit("base"))
    for name, value in rates(F.col("n_words")).items():
        failed = failed.when(value > F.col(f"{name}_high"), F.lit(name))
        if MEASURES[name][1]:
            failed = failed.when(value < F.col(f"{name}_low"), F.lit(name))
    return (
        joined.withColumn("failed_rule", failed)
        .withColumn("kept", F.col("failed_rule").isNull())
        .drop(*fences.columns)
    )


def judge(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, lang, source, the base counts, base_failed, failed_rule, kept."""
    carried = ["doc_id", "lang", "source"]
    measured = measure(docs, [F.col(c) for c in carried])
    return verdicts(keep(measured.withColumnsRenamed({f"_c{i}": c for i, c in enumerate(carried)}), "quality"))


def filter_quality(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    names = docs.columns
    # Two hashes of all that a verdict follows from, and the id, so that copies spread. NULLs don't enter a hash by themselves.
    decisive = [x for c in ("doc_id", "text", "lang", "source") for x in (F.col(c).isNull(), F.col(c))]
    hashes = F.xxhash64(*decisive), F.xxhash64(*reversed(decisive), F.lit(1))
    measured = measure(docs, [*hashes, F.col("lang"), F.col("source")]).withColumnsRenamed(
        {"_c0": "h1", "_c1": "h2", "_c2": "lang", "_c3": "source"}
    )
    # Written before any filter: a filter would be pushed below the counts and repeat their expressions. The texts are
    # not written with them: the table stays as long as the result is read, and would be a second copy of the documents.
    kept = verdicts(keep(measured, "quality")).where("kept").select("h1", "h2")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), hashes[0].alias("h1"), hashes[1].alias("h2"))
    return rows.join(kept, ["h1", "h2"], "left_semi").select(*[F.col("doc")[c].alias(c) for c in names])
