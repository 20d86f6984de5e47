"""Encoding, token counts, quality rules and chat formatting against plain versions."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import ordered, tricky_documents
from weir.llm import bpe, chat, quality, queries, token_counts
from weir.llm.queries import WORD_BPE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_definition(WORD_BPE))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def plain_ids(vocabulary, text):
    found = list(vocabulary.words(text))
    known = vocabulary.encode_words({w for w in found if isinstance(w, str)})
    return [i for w in found for i in (known[w] if isinstance(w, str) else [w])]


def test_trie_encodes_like_the_library(vocabulary, library):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDE éüñ😀漢かÅÀ'!?.0123 \t\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["".join(rng.choice("aaabnsthein ") for _ in range(rng.randrange(60))) for _ in range(1500)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert plain_ids(vocabulary, text) == ids
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_words_follow_the_library_for_every_character(vocabulary, library):
    """Also those that this Python's Unicode tables don't know yet; joined by spaces, 500 at a time."""

    def pieces(text):
        return [p[0] for p in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))]

    codes = [*range(0xD800), *range(0xE000, 0x110000)]
    for at in range(0, len(codes), 500):
        text = " ".join("a" + chr(c) + "1" + chr(c) for c in codes[at : at + 500])
        assert [vocabulary.symbols(w) for w in vocabulary.words(text)] == pieces(text), hex(codes[at])


@pytest.mark.parametrize("start", [0x105C0, 0x11380, 0x113C0, 0x16100, 0x16D40])
def test_young_characters_compose_as_in_the_library(vocabulary, library, start):
    marks = [0x307, 0x327, 0x345, *range(start, start + 64)]
    for first in range(start, start + 64):
        text = " ".join("É" + chr(first) + chr(second) + "Σ" for second in marks)
        expected = [p[0] for p in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))]
        assert [vocabulary.symbols(w) for w in vocabulary.words(text)] == expected


def test_young_characters_encode_as_in_the_library(vocabulary, library):
    texts = ["\u1c89bc def\u0558 x", "CJK \U000323b0\U000323b1abc'S", "<|endoftext|>\u208f ok\u2003\U00016ea0Z", "É\U000105d2\u0307 \t\u0558"]
    for text in texts:
        assert plain_ids(vocabulary, text) == library.encode(text, add_special_tokens=False).ids


def test_blocks_of_words_join(spark, monkeypatch):
    for name, value in {"FLUSH_PARTS": 3, "KNOWN_PARTS": 5, "KNOWN_WORDS": 2, "LONG_PART": 4}.items():
        monkeypatch.setattr(bpe, name, value)
    known = bpe._Known(bpe.Vocabulary(bpe.read_definition(WORD_BPE)), digits=False, names=True)
    texts = ["one two three four five six seven", None, "", "a b c", "d", " it's\n\n(so-called)  x\t<|endoftext|>y ", "\t \n", "Ünü <|endoftext|>"]
    out = [[] for _ in texts]
    for number, _, found in bpe._in_blocks(texts, known):
        out[number] += [i for ids, _, _ in found for i in ids]
    library = Tokenizer.from_file(WORD_BPE)
    assert out == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_long_texts_encode_as_in_the_library(spark, library):
    """Texts beyond ``LONG_TEXT`` and ``FLUSH_PARTS``, with and without spaces."""
    texts = ["Déjà vu, " * 150_000, "x1-" * 400_000, "word\n" * 600_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in bpe.encode_digests(docs, bpe.read_definition(WORD_BPE)).collect()}
    for number, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[number]["n_tokens"] == len(ids)
        assert rows[number]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_op7(query, tricky, empty, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for row in tricky_documents():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append({"doc_id": row["doc_id"], "n_tokens": len(ids), "ids_sha256": digest(" ".join(map(str, ids))), "decoded_sha256": digest(decoded)})
    assert ordered(query("op7_bpe_encoding", tricky)) == ordered(expected)
    assert query("op7_bpe_encoding", empty) == []


def test_op6(query, tricky, empty):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    lengths = [len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in tricky_documents()]
    expected = [
        {
            "n_tokens": n,
            "n_docs": lengths.count(n),
            "docs_over": sum(x > n for x in lengths),
            "tokens_over": sum(x for x in lengths if x > n),
            "docs_within": sum(x <= n for x in lengths),
            "tokens_within": sum(x for x in lengths if x <= n),
            "cut_total": sum(min(x, n) for x in lengths),
            "quantile": sum(x <= n for x in lengths) / len(lengths),
        }
        for n in {*lengths, *queries.CONTEXT_LIMITS}
    ]
    assert ordered(query("op6_token_counts", tricky)) == ordered(expected)
    nothing = query("op6_token_counts", empty)
    assert sorted(r["n_tokens"] for r in nothing) == queries.CONTEXT_LIMITS
    assert {(r["n_docs"], r["docs_over"], r["cut_total"], r["quantile"]) for r in nothing} == {(0, 0, 0, None)}


def test_any_limit_and_any_quantile(spark):
    lengths = [3, 3, 7, 0, 40, 41, 41, 9000, 5, 5]
    counts = token_counts.histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"))
    limits = [0, 1, 6, 41, 8192, 10**6]
    for block in (4, 4096):
        rows = {r["n_tokens"]: r for r in token_counts.context_table(counts, limits, block).collect()}
        for n in limits:
            assert rows[n]["n_docs"] == lengths.count(n)
            assert rows[n]["docs_over"] == sum(x > n for x in lengths)
            assert rows[n]["tokens_within"] == sum(x for x in lengths if x <= n)
            assert rows[n]["cut_total"] == sum(min(x, n) for x in lengths)
    shares = [0.0, 0.05, 0.1, 0.3, 0.5, 0.9, 0.95, 1.0]
    table = token_counts.context_table(counts, limits)
    found = [(r["share"], r["n_tokens"]) for r in token_counts.quantile_lengths(table, shares).collect()]
    held = lambda n, s: sum(x <= n for x in lengths) / len(lengths) >= s
    assert found == [(s, min(n for n in lengths if held(n, s))) for s in shares]
    none = token_counts.quantile_lengths(token_counts.context_table(counts.limit(0), limits), [0.5]).collect()
    assert [tuple(r) for r in none] == [(0.5, None)]


def test_a_text_read_lazily_has_the_same_words(monkeypatch, vocabulary, library):
    text = "Straße No. 12, ÉTÉ don't 漢字 " * 300
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    assert plain_ids(vocabulary, text) == library.encode(text, add_special_tokens=False).ids


def test_op9(query, in_sql, tricky, empty):
    rows = query("op9_quality_rules", tricky)
    assert ordered(rows) == ordered(in_sql("op9_quality_rules", tricky))
    by_text = {d["text"]: r for d in tricky_documents() for r in rows if r["doc_id"] == d["doc_id"] and r["n_words"] == len((d["text"] or "").split())}
    assert by_text[None]["base_failed"] and not by_text[None]["kept"]
    assert by_text["#$% ### *** " * 30]["n_symbols"] == 270
    assert by_text["ab " * 400]["n_repeat_words"] == 400
    assert query("op9_quality_rules", empty) == []


def test_quality_small_and_large_groups(query, in_sql):
    assert ordered(query("op9_quality_rules", SF)) == ordered(in_sql("op9_quality_rules", SF))


@pytest.mark.parametrize("share", [10, 30, 45, 60])
def test_a_source_with_much_junk_loses_it(spark, share):
    """Other sources are clean or symbol-rich throughout; those stay whole."""
    import corpus_pipeline

    rng = random.Random(share)
    clean = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(60))
    junk = lambda: " ".join(rng.choice(["#$%&", "***|", "<>#", "word"]) + rng.choice("xyz") * 3 for _ in range(60))
    code = lambda: clean().replace("a", "#", rng.randrange(10, 20))
    rows = [(i, junk() if i < 2 * share else clean(), "en", "hot") for i in range(200)]
    rows += [(200 + i, clean(), "en", "web") for i in range(200)]
    rows += [(400 + i, code(), "en", "code") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_quality(spark, docs, "").select("doc_id").collect()}
    assert {r["doc_id"] for r in quality.judge(docs).where("kept").collect()} == kept  # the query's rule is the pipeline's
    assert kept == set(range(2 * share, 500))


def test_sketch_buckets(spark):
    from pyspark.sql import functions as F

    values = [*range(300), 1000, 65535, 10**9, 2**40 + 12345]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.bucket(F.col("v")).alias("b")).withColumn("low", quality.bucket_value(F.col("b"))).collect()
    assert all(r["low"] <= r["v"] < r["low"] * 33 / 32 + 1 for r in rows)
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows)


def test_no_python_in_the_native_plans(spark, tricky):
    docs = spark.read.parquet(f"{tricky}/documents.parquet")
    turns = spark.read.parquet(f"{tricky}/conversations.parquet")
    for frame in (quality.judge(docs), quality.filter_quality(docs), chat.rotate(turns)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_op2(spark, query, in_sql, tricky, empty):
    rows = query("op2_chat_formatting", tricky)
    assert ordered(rows) == ordered(in_sql("op2_chat_formatting", tricky))
    assert query("op2_chat_formatting", empty) == []
    turns = spark.read.parquet(f"{tricky}/conversations.parquet")
    whole = {(r["conv_id"], r["perspective"]): r for r in chat.dialogues(chat.rotate(turns, block=2)).collect()}
    assert whole[1, "assistant"]["rendered"] == "<|system|>\nbe kind<|end|>\n<|user:user|>\nhi<|end|>\n<|assistant|>\nhello\nthere<|end|>\n<|user:user|>\n<|end|>\n"
    assert {k[0] for k in whole} == {1, 2, 4, 5, None}
    for r in rows:  # each span lies on the assistant's words
        text = whole[r["conv_id"], r["perspective"]]["rendered"]
        assert text[r["start"] : r["start"] + len(r["rendered"])] == r["rendered"]
        if r["role"] == "assistant":
            assert text[r["mask_start"] : r["mask_end"]] == r["rendered"].removeprefix("<|assistant|>\n").removesuffix("\n")
        else:
            assert r["mask_start"] == r["mask_end"] == r["start"]


def test_encode_and_decode_agree(spark, tricky):
    docs, definition = spark.read.parquet(f"{tricky}/documents.parquet").select("doc_id", "text"), bpe.read_definition(WORD_BPE)
    both = bpe.encode(docs, definition, decoded="at_once")
    rows = bpe.decode(both, definition).collect()
    assert rows and all(r["decoded"] == r["at_once"] for r in rows)
