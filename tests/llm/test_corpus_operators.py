"""Mixing, suffix dedup, shards, fingerprints, SimHash and toxicity against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import ordered, prose, tricky_documents
from weir.llm import fingerprints, mixing, sharding, simhash, suffix_dedup, toxicity

SF = "/root/testdata/sf0.01"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


# --- mixing -----------------------------------------------------------------------------------------------


def plain_targets(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        if not free:
            break
        level = (total - sum(3 * sizes[s] for s in stopped)) / sum(weight[s] for s in free)
        new = {s for s in free if level * weight[s] >= 3 * sizes[s]}
        if not new:
            break
        stopped |= new
    return {s: 3 * sizes[s] if s in stopped else level * weight[s] for s in names}


def check_mix(rows, documents):
    sizes: dict = defaultdict(int)
    for d in documents:
        sizes[d["source"]] += n_words(d["text"])
    expected, taken = plain_targets(sizes), defaultdict(int)
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(d["doc_id"]), n_words(d["text"])) for d in documents)
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(expected[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 3 * r["size"]
    for source, target in expected.items():  # a source of ten documents can't be met to the word
        assert taken[source] == pytest.approx(target, rel=0.01, abs=40)


def test_op1(query, tricky, empty):
    first = query("op1_mixing", tricky)
    check_mix(first, tricky_documents())
    assert ordered(first) == ordered(query("op1_mixing", tricky))
    assert query("op1_mixing", empty) == []


def test_mix_gives_the_copies(spark, tricky):
    docs = spark.read.parquet(f"{tricky}/documents.parquet")
    mixed = mixing.mix(docs)
    assert mixed.schema.names == docs.schema.names
    counted = mixing.copies(mixing.sizes(docs)).where("copies > 0").groupBy("source").agg(F.sum("taken")).collect()
    again = Counter()
    for r in mixed.collect():
        again[r["source"]] += n_words(r["text"])
    assert {k: v for k, v in again.items() if v} == {r[0]: r[1] for r in counted if r[1]}


def test_rates_are_tilted_exponentially(query):
    rows = query("op1_mixing", "/root/testdata/sf0.001")
    by_source = defaultdict(list)
    for r in rows:
        if r["size"] and 0 < r["rate"] < 3:
            by_source[r["source"]].append((r["size"], np.log(r["rate"])))
    for pairs in by_source.values():
        slopes = [v / s for s, v in pairs]
        assert max(slopes) - min(slopes) < 1e-9


# --- suffix dedup -----------------------------------------------------------------------------------------


def plain_removal(texts: list[bytes], length: int = 400) -> list[np.ndarray]:
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


def removal_rows(documents):
    data = [(d["text"] or "").encode() for d in documents]
    for d, t, gone in zip(documents, data, plain_removal(data), strict=True):
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        yield {"doc_id": d["doc_id"], "n_bytes": len(t), "n_removed": int(gone.sum()), "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest()}


def test_op3(query, tricky, empty):
    assert ordered(query("op3_suffix_array_dedup", tricky)) == ordered(removal_rows(tricky_documents()))
    assert query("op3_suffix_array_dedup", empty) == []


def test_long_texts_lose_what_repeats(spark):
    """Texts of several times ``WINDOWS_AT_ONCE``, with passages across its borders, within one text and in one of another."""
    rng = random.Random(8)
    at = suffix_dedup.WINDOWS_AT_ONCE
    long = rng.randbytes(3 * at).hex()[: 3 * at]
    passage = long[at - 350 : at + 350]
    texts = [long, rng.randbytes(500).hex() + passage, long[2 * at - 200 : 2 * at + 199] + "|", "ab" * at + "." + rng.randbytes(300).hex()]
    docs = [{"doc_id": i, "text": t} for i, t in enumerate(texts)]
    frame = spark.createDataFrame([tuple(d.values()) for d in docs], "doc_id long, text string")
    found = [r.asDict() for r in suffix_dedup.removal_digests(frame).collect()]
    assert ordered(found) == ordered(removal_rows(docs))


def test_construction_sorts_suffixes():
    rng = random.Random(3)
    for trial in range(40):
        letters = b"ab" if trial % 2 else b"abcdz\x00\xff"
        texts = [bytes(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 12))]
        rest, common = suffix_dedup.construct([np.frombuffer(t, np.uint8).astype(np.int64) for t in texts], np.ones(256, np.int16))
        order = sorted([([(c + 1, 0) for c in t[p:]] + [(0, i)], i, p) for i, t in enumerate(texts) for p in range(len(t) + 1)])
        at = {(i, p): k for k, (_, i, p) in enumerate(order)}
        for k, (_, i, p) in enumerate(order):
            if p < len(texts[i]):
                assert rest[k] == at[i, p + 1]
            if k:
                a, b = texts[order[k - 1][1]][order[k - 1][2] :], texts[i][p:]
                shared = next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
                assert common[k] == shared


def test_large_groups_are_cut(spark):
    """A passage in many documents with different surroundings, collections of 4 texts and groups of at most 3."""
    rng = random.Random(8)
    passage = prose(rng, 90).encode()
    texts = [prose(rng, 8).encode() + passage[i % 7 : len(passage) - i % 5] + prose(rng, 8).encode() for i in range(40)]
    rows = [(t, *s) for t in texts for s in suffix_dedup.stretches(t)]
    items = {}
    for t, first, windows, key, _ in rows:
        data = t[first : first + windows - 1 + 400]
        a, b, k, n, _ = items.get((key, data), (key, suffix_dedup._signed(data), key, 0, data))
        items[key, data] = (a, b, k, n + 1, data)
    frame = spark.createDataFrame(list(items.values()), "a long, b long, key long, n long, data binary")
    found = defaultdict(set)
    for r in suffix_dedup.settle(frame, collection=4, largest=3).collect():
        found[r["a"], r["b"]] |= set(range(r["first"], r["last"] + 1))
    counts = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    for a, b, _, _, data in items.values():
        assert found[a, b] == {i for i in range(len(data) - 399) if counts[data[i : i + 400]] > 1}


def test_removal_keeps_columns_and_rows(spark, tricky):
    docs = spark.read.parquet(f"{tricky}/documents.parquet")
    out = suffix_dedup.remove_repeats(docs)
    assert out.schema.names == docs.schema.names and out.count() == docs.count()


def words_of(rng: random.Random, n: int, letters: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(letters)) for _ in range(n))


def test_passages_of_over_50_words_go(spark):
    """Under 400 bytes they go as well; passages of 40 words with as many bytes and other text stay."""
    import corpus_pipeline

    rng = random.Random(12)
    passage, short, long = words_of(rng, 51, 4), words_of(rng, 40, 6), words_of(rng, 40, 10)
    rows, expected = [], {}
    for i in range(12):
        head, tail = words_of(rng, 30 + i, 5), words_of(rng, 60, 5)
        middle = [passage, short, long][i % 3]
        rows.append((i, f"{head} {chr(113 + i // 3)} {middle} {chr(117 + i // 3)} {tail}"))
        expected[i] = rows[-1][1] if middle is short else rows[-1][1].replace(f" {middle} ", "")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(passage) < 400 and len(short) > corpus_pipeline.PASSAGE_BYTES and len(long) >= 400
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()} == expected


def test_short_words_make_short_passages(spark):
    """51 words of one letter have 101 bytes; runs without a repeated passage of 51 words stay, whatever joins in them."""
    import corpus_pipeline

    rng = random.Random(4)
    tiny = " ".join(rng.choice("abcdefgh") for _ in range(51))
    brief = words_of(rng, 70, 2)[:200].rsplit(" ", 1)[0]
    chain = words_of(rng, 64, 4).split(" ")  # its first and last 45 words are elsewhere, but no 51 of them
    parts = {0: tiny, 1: tiny, 2: brief, 3: brief, 4: " ".join(chain), 5: " ".join(chain[:45]), 6: " ".join(chain[19:])}
    rows = [(i, f"{words_of(rng, 40, 5)} {chr(65 + i)} {part} {chr(65 + i)} {words_of(rng, 40, 5)}") for i, part in parts.items()]
    rows += [rows[6], rows[6]]  # rows that repeat as a whole lose all
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.cut_repeats(spark, docs, "").collect())
    expected = [(i, text.replace(f" {parts[i]} ", "") if i < 4 else text) for i, text in rows[:6]] + [(6, "")] * 3
    assert found == expected


def test_shorter_strings(spark, tricky):
    """The removal is exact for other lengths too."""
    docs = spark.read.parquet(f"{tricky}/documents.parquet")
    data = [(d["text"] or "").encode() for d in tricky_documents()]
    for length in (80, 224):
        kept = [np.frombuffer(t, np.uint8)[~gone].tobytes().decode("utf-8", "ignore") for t, gone in zip(data, plain_removal(data, length), strict=True)]
        found = [r["text"] or "" for r in suffix_dedup.remove_repeats(docs, length).select("text").collect()]
        assert sorted(found) == sorted(kept)


# --- shards -----------------------------------------------------------------------------------------------


def check_shards(rows, documents, near):
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(d["doc_id"]), len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in documents
    )
    bytes_of, slots = Counter(), defaultdict(list)
    for r in rows:
        bytes_of[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    fair, largest = sum(bytes_of.values()) / 16, max(r["size"] for r in rows)
    assert all(abs(b - fair) <= max(largest, near * fair) for b in bytes_of.values())


def test_op4(query, tricky, empty):
    check_shards(query("op4_sharding", tricky), tricky_documents(), 0.01)
    assert query("op4_sharding", empty) == []


def test_hot_texts_are_split_and_others_are_not(spark):
    docs = [{"doc_id": i, "text": "hot " * 50} for i in range(600)] + [{"doc_id": 1000 + i // 2, "text": prose(random.Random(i // 2), 40)} for i in range(1200)]
    frame = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string")
    rows = [r.asDict() for r in sharding.shards(frame, 16, block=50).collect()]
    check_shards(rows, docs, 0.01)
    of_text = defaultdict(set)
    for r in rows:
        of_text[r["text_crc32"]].add(r["shard"])
    hot = zlib.crc32(b"hot " * 50)
    assert len(of_text[hot]) > 1 and sum(len(s) > 1 for t, s in of_text.items() if t != hot) <= 15


# --- fingerprints -----------------------------------------------------------------------------------------


def jaccard(a, b):
    x, y = Counter((a or "").encode().split()), Counter((b or "").encode().split())
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 1.0


def test_op5(query, tricky, empty):
    docs, rows = tricky_documents(), query("op5_fingerprints", tricky)
    assert len(rows) == len(docs) and query("op5_fingerprints", empty) == []
    assert Counter((r["doc_id"], r["n_chars"]) for r in rows) == Counter((d["doc_id"], len(d["text"] or "")) for d in docs)
    once = {k for k, n in Counter(d["doc_id"] for d in docs).items() if n == 1 and k is not None}
    order = sorted((d for d in docs if d["doc_id"] is not None), key=lambda d: -d["doc_id"])
    of_text, found = defaultdict(set), {r["doc_id"]: r for r in rows}
    for d, following in zip(order, order[1:], strict=False):
        if d["doc_id"] not in once:
            continue
        r = found[d["doc_id"]]
        of_text[d["text"] or ""].add(r["fingerprint"])
        if following["doc_id"] in once:
            edited = fingerprints.edited_text(d["text"] or "", following["text"] or "")
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert r["near_edited"] == pytest.approx(jaccard(d["text"], edited), abs=0.2)
            assert r["near_next"] == pytest.approx(jaccard(d["text"], following["text"]), abs=0.2)
    assert all(len(f) == 1 for f in of_text.values())


def test_collisions_follow_the_generalised_jaccard_similarity():
    rng = random.Random(2)
    sampler = fingerprints.Sampler(samples=2048, remembered=50)
    for share in (0.1, 0.5, 0.9):
        a = [rng.choice(WIDE) for _ in range(300)]
        b = [w if rng.random() < share else rng.choice(WIDE) for w in a]
        a, b = " ".join(a), " ".join(b)
        assert fingerprints.likeness(sampler.fingerprint(a), sampler.fingerprint(b)) == pytest.approx(jaccard(a, b), abs=0.05)


WIDE = [f"w{i * i % 97}" for i in range(60)] + [f"x{i}" for i in range(200)]


def test_last_document_goes_on_with_the_first(spark):
    frame = spark.createDataFrame([(1, "a b c d"), (2, "e f g h"), (3, "i j k l")], "doc_id long, text string")
    rows = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.compare_with_next(frame, buckets=5).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows == {3: digest("i j e f"[:4] + "e f"), 2: digest("e f " + "a b"), 1: digest("a b " + "i j")}
    alone = fingerprints.compare_with_next(frame.where("doc_id = 1")).collect()[0]
    assert alone["edited_sha256"] == digest("a b a b"[:4] + "a b") and alone["near_next"] == 1.0


# --- SimHash ----------------------------------------------------------------------------------------------


def plain_simhash(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    distinct = sorted(parent)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {p: root(p) for p in distinct}


def test_op8(query, tricky, empty):
    docs = tricky_documents()
    prints = [plain_simhash(d["text"]) for d in docs]
    roots = plain_components(prints)
    least = {}
    for d, p in zip(docs, prints, strict=True):
        if d["doc_id"] is not None:
            least[roots[p]] = min(least.get(roots[p], 1 << 62), d["doc_id"])
    expected = [{"doc_id": d["doc_id"], "fingerprint": f"{p:016x}", "component_id": least.get(roots[p])} for d, p in zip(docs, prints, strict=True)]
    assert ordered(query("op8_simhash_near_dedup", tricky)) == ordered(expected)
    assert query("op8_simhash_near_dedup", empty) == []


def test_long_texts_have_plain_fingerprints():
    """Texts of more than the 65,536 shingles that are counted at a time."""
    rng = random.Random(9)
    for words in (65_538, 65_539, 65_540, 140_000):
        text = " ".join(rng.choice(["Aa", "b\u00e9", "ccc", "D", "e"]) + str(rng.randrange(50)) for _ in range(words))
        assert simhash.fingerprint(text, 4) == plain_simhash(text)


@pytest.mark.parametrize("tile", [8, 64, 4096])
def test_tiles_lose_no_link(spark, tile):
    """Chains of prints a few bits apart among others, with small tiles and a large group of near copies."""
    rng = random.Random(tile)
    prints = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(400):
        p = rng.choice(prints[-50:])
        for b in rng.sample(range(64), rng.randrange(1, 6)):
            p ^= 1 << b
        prints.append(p)
    center = rng.getrandbits(64)
    prints += [center ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(300)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id long, fingerprint long")
    found = {r["fingerprint"]: r["component_id"] for r in simhash.classes(frame, 4, tile).collect()}
    roots, least = plain_components(prints), {}
    for i, p in enumerate(prints):
        least.setdefault(roots[p], i)
    assert found == {s: least[roots[p]] for p, s in zip(prints, signed, strict=True)}


def test_one_of_each(spark, tricky):
    docs = spark.read.parquet(f"{tricky}/documents.parquet")
    kept = simhash.one_of_each(docs, 4, 4)
    prints = plain_components([plain_simhash(d["text"]) for d in tricky_documents()])
    assert kept.columns == docs.columns
    assert sorted(plain_components([plain_simhash(r["text"]) for r in kept.collect()]).values()) == sorted(
        plain_simhash(r["text"]) for r in kept.collect()
    )
    assert kept.count() == len(set(prints.values()))


# --- toxicity ---------------------------------------------------------------------------------------------


def test_op10_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0)
    model = toxicity.fit_sample(docs, labels.where("not held"))
    scored = toxicity.score(docs, model).join(labels.where("held").withColumnRenamed("toxic", "label"), "doc_id")
    row = scored.agg(
        F.avg(F.when(F.col("label") == 0, F.col("toxic").cast("int"))).alias("false"),
        F.avg(F.when(F.col("label") == 1, F.col("toxic").cast("int"))).alias("found"),
        F.avg(F.when(F.col("label") == 0, F.col("expected_severity"))).alias("clean"),
        F.avg(F.when(F.col("label") == 1, F.col("expected_severity"))).alias("bad"),
    ).first()
    assert row["false"] < 0.005 and row["found"] >= 0.93 and row["bad"] > 10 * row["clean"]


def test_severity_does_not_grow_with_length(spark):
    """The same words again are as severe; more clean words around telling ones are less so."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    model = toxicity.fit_sample(docs, spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    text = "the idiot said this and that about the pathetic trash of all the others in the house"
    texts = [text, " ".join([text] * 40), text + " and so it was on all the other days" * 90]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    once, often, thinned = [r["expected_severity"] for r in toxicity.score(frame, model).orderBy("doc_id").collect()]
    assert once == pytest.approx(often) and once > thinned + 0.5
    labelled = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic = 1").select("doc_id").distinct()
    length = F.length("text")
    assert toxicity.score(docs, model).join(docs, "doc_id").join(labelled, "doc_id").agg(F.corr("expected_severity", length)).first()[0] < 0


def plain_sample(documents: list[dict], labels: list[dict]) -> toxicity.Sample:
    """The sample by counting every feature in every text, in one process."""
    label = {}
    for x in labels:
        if x["doc_id"] is not None and x["toxic"] is not None:
            label[x["doc_id"]] = max(label.get(x["doc_id"], 0), x["toxic"])
    texts = {}
    for d in documents:
        if d["doc_id"] in label:
            texts[d["doc_id"]] = min(texts.get(d["doc_id"], d["text"] or ""), d["text"] or "")
    words = {i: re.findall(r"[^\W\d_]+", t.lower()) for i, t in sorted(texts.items())}
    having = {i: {f for w in ws for f in toxicity.word_features(w)} for i, ws in words.items()}
    n, bad = len(words), sum(label[i] for i in words)
    chosen = {}
    for f in sorted(set().union(*having.values())):
        b, a = sum(f in having[i] for i in words), sum(f in having[i] for i in words if label[i])
        spread = b * (n - b) * bad * (n - bad)
        chi2 = n * (a * n - b * bad) ** 2 / spread if spread else 0
        if b >= min(3, n) and chi2 >= min(30, n / 4):
            chosen[f] = a * n > b * bad
    places, amounts, shares = [], [], []
    for ws in words.values():
        found = [(k, 100 * sum(f in toxicity.word_features(w) for w in ws) / len(ws)) for k, f in enumerate(chosen) if ws]
        places.append([k for k, x in found if x]), amounts.append([x for _, x in found if x])
        shares.append(sum(any(chosen.get(f) for f in toxicity.word_features(w)) for w in ws) / max(1, len(ws)))
    return toxicity.Sample(list(chosen), places, amounts, np.array(shares), np.array([bool(label[i]) for i in words]))


def test_op10_is_the_plain_version(spark, query):
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    model = toxicity.fit(plain_sample(documents, labels))
    expected = {}
    for d in documents:
        words = re.findall(r"[^\W\d_]+", (d["text"] or "").lower())
        score = sum(model.weights.get(f, 0) for w in words for f in toxicity.word_features(w)) * 100 / max(1, len(words))
        expected[d["doc_id"]] = sum(1 / (1 + np.exp(min(50, max(-50, t - score)))) for t in model.thresholds)
    rows = query("op10_toxicity", folder)
    assert model.weights and {r["doc_id"]: r["expected_severity"] for r in rows} == pytest.approx(expected, rel=1e-6, abs=1e-9)


def test_op10_defined_cases(query, tricky, empty):
    rows = query("op10_toxicity", tricky)
    assert Counter(r["doc_id"] for r in rows) == Counter(d["doc_id"] for d in tricky_documents())
    assert all(0 <= r["expected_severity"] <= 3 and r["severity"] in range(4) for r in rows)
    assert query("op10_toxicity", empty) == []


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(1)
    score = rng.normal(size=600)
    grades = np.digitize(score + 0.3 * rng.normal(size=600), [-0.5, 0.5, 1.2])
    # Feature k is there once for each tenth by which the score exceeds -3.
    counts = np.maximum(0, np.round((score + 3) * 10)).astype(int)
    rows = np.repeat(np.arange(600), counts)
    weights, thresholds = toxicity._fit_ordinal(rows, np.zeros(len(rows), int), np.ones(len(rows)), 1, grades)
    assert weights[0] > 0 and list(thresholds) == sorted(thresholds)
    model = toxicity.Model({"f": float(weights[0])}, thresholds)
    expected = model.chances(counts * weights[0]).sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.9
