"""The corpus pipeline stage by stage against plain versions, and as a whole."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import ordered, tricky_documents
from tests.llm.test_corpus_operators import n_words, plain_components, plain_removal, plain_simhash, plain_targets
from weir.llm import common
from weir.llm.queries import WORD_BPE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tricky, tmp_path_factory):
    """What each stage returns, written and read again."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{tricky}/documents.parquet"), []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, tricky).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
        out.append(docs)
    return out


def rows(frame):
    return [r.asDict() for r in frame.collect()]


def test_columns(stages):
    assert all(set(COLUMNS) <= set(s.columns) for s in stages[:-1])


def test_quality_keeps_what_the_rules_keep(stages, in_sql, tricky):
    kept = Counter((r["doc_id"], r["n_words"]) for r in in_sql("op9_quality_rules", tricky) if r["kept"])
    assert Counter((r["doc_id"], n_words(r["text"])) for r in rows(stages[0])) == kept


def test_one_document_of_each_group_stays(stages):
    before, after = rows(stages[0]), rows(stages[1])
    prints = [plain_simhash(r["text"]) for r in before]
    roots = plain_components(prints)
    best = {}
    for r, p in zip(before, prints, strict=True):
        key = r["doc_id"] is None, r["doc_id"]
        if roots[p] not in best or key < best[roots[p]]:
            best[roots[p]] = key
    assert sorted(map(str, best.values())) == sorted(str((r["doc_id"] is None, r["doc_id"])) for r in after)


def test_repeats_are_cut(stages):
    before = rows(stages[1])
    data = [r["text"].encode() for r in before]
    expected = []
    for r, t, gone in zip(before, data, plain_removal(data), strict=True):
        expected.append({**r, "text": np.frombuffer(t, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")})
    assert ordered(rows(stages[2])) == ordered(expected)


def test_tables_of_the_repeats_stage_go_when_nothing_reads_them(spark, stages, tricky, tmp_path, monkeypatch):
    made = []

    def folder(spark, name):
        made.append(name)
        return f"{tmp_path}/{len(made)}-{name}"

    monkeypatch.setattr(common, "workspace", folder)
    cut = corpus_pipeline.cut_repeats(spark, stages[1], tricky)
    left = Counter(p.name.partition("-")[2] for p in tmp_path.iterdir())
    assert {"repeats-stretches", "repeats-blocks", "repeats-shared", "repeats-texts", "repeats-items"} <= set(made)
    assert set(left) <= {"repeats-keys", "repeats-runs", "repeats-large", "repeats-passages"}
    assert Counter(r["text"] for r in rows(cut)) == Counter(r["text"] for r in rows(stages[2]))


def test_quality_leaves_no_second_copy_of_the_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "workspace", lambda spark, name: f"{tmp_path}/{name}")
    texts = [" ".join(f"w{n}x{i}" for i in range(300)) for n in range(40)]
    docs = spark.createDataFrame([(n, t, "en", "web", len(t)) for n, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_quality(spark, docs, None)
    assert sorted(r["text"] for r in rows(kept)) == sorted(texts)
    for table in tmp_path.iterdir():
        assert "text" not in str(spark.read.parquet(str(table)).schema)


def test_one_verdict_where_nulls_trade_places(spark):
    """Rows that differ only in which column is NULL are judged each by its own."""
    text = " ".join(f"w{i}" for i in range(40))
    docs = [(1, text, None, "en", 1), (1, text, "en", None, 1), (None, text, None, None, 1), (1, None, text, "en", 1), (1, None, "en", text, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_quality(spark, frame, None)
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, docs[:3]))


def test_shuffles_go_when_their_table_is_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "workspace", lambda spark, name: f"{tmp_path}/{name}")
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = set(map(int, str(tracker.shuffleStatuses().keys().mkString(" ")).split()))
    written = common.keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    after = set(map(int, str(tracker.shuffleStatuses().keys().mkString(" ")).split()))
    assert after <= before
    assert written.count() == 7
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == "false"


def test_sources_are_mixed(stages):
    sizes, taken = Counter(), Counter()
    for r in rows(stages[2]):
        sizes[r["source"]] += n_words(r["text"])
    for r in rows(stages[3]):
        taken[r["source"]] += n_words(r["text"])
    for source, target in plain_targets(dict(sizes)).items():
        assert taken[source] == pytest.approx(target, rel=0.01, abs=40)
    copies = Counter((r["doc_id"], r["text"]) for r in rows(stages[3]))
    there = Counter((r["doc_id"], r["text"]) for r in rows(stages[2]))
    assert all(n <= 3 * there[k] for k, n in copies.items())


def test_tokens_are_the_library_s(stages):
    library = Tokenizer.from_file(WORD_BPE)
    expected = []
    for r in rows(stages[3]):
        ids = library.encode(r["text"], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append({"doc_id": r["doc_id"], "lang": r["lang"], "source": r["source"], "n_tokens": len(ids), "token_ids": ids, "decoded": decoded})
    assert ordered(rows(stages[4])) == ordered(expected)


def test_whole_and_empty(spark, query, stages, tricky, empty):
    assert ordered(query("pipeline", tricky)) == ordered(rows(stages[4]))
    assert query("pipeline", empty) == []


def test_documents_are_enough(spark, tricky):
    """The given table has no other columns."""
    docs = spark.createDataFrame([tuple(d[c] for c in COLUMNS) for d in tricky_documents()], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tricky)
        assert docs.columns == COLUMNS
