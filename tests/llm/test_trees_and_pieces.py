"""SentencePiece, Merkle manifest and centroid clustering against the library, plain versions and their SQL."""

from __future__ import annotations

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.errors import PySparkException

from tests.llm.conftest import ordered, tricky_documents
from weir.llm import centroids, merkle, pieces
from weir.llm.oracle import ORACLE
from weir.llm.queries import PIECE_BPE, llm_queries

# --- SentencePiece ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


@pytest.fixture(scope="module")
def model():
    return pieces.Model(pieces.read_model(PIECE_BPE))


def library_row(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("folder", ["tricky", "/root/testdata/sf0.001"])
def test_op11_is_the_library(query, library, request, folder):
    folder = request.getfixturevalue(folder) if folder == "tricky" else folder
    documents = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    rows = query("op11_sentencepiece", folder)
    expected = Counter((d["doc_id"], *library_row(library, d["text"])) for d in documents)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == expected


def test_op11_empty(query, empty):
    assert query("op11_sentencepiece", empty) == []


def test_pieces_follow_the_library_for_every_character(model, library):
    wrong = []
    for code in [*range(1, 0xD800), *range(0xE000, 0x33480)]:
        text = f"a{chr(code)}b {chr(code)}"
        if model.encode(text) != library.encode(text, add_bos=True, add_eos=True):
            wrong.append(code)
    assert wrong == []


def test_pieces_follow_the_library_on_mixed_texts(model, library):
    rng = random.Random(5)
    parts = ["▁", " ", "  ", "\t", "\n", "a", "e", "the", "ing", "é", "漢", "😀", "\0", "ß", "1", "<s>", "<0x41>", "�", "中", "́"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(24)))
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert model.encode(text) == ids and model.decode(ids) == library.decode(ids)


def test_long_parts_and_runs_of_spaces(model, library):
    rng = random.Random(6)
    texts = [" " * n + tail for n in range(40) for tail in ("", "the", "漢")]
    texts.append("".join(rng.choice("abcdefghijklmnop漢") for _ in range(3 * pieces.SEARCHED)))  # one part, several stretches
    texts.append(" " * 40_000 + "x")
    for text in texts:
        assert model.encode(text) == library.encode(text, add_bos=True, add_eos=True)


def test_decode_takes_any_ids(model, library):
    rng = random.Random(7)
    for _ in range(5_000):
        ids = [rng.choice((rng.randrange(1, 32_000), rng.randrange(3, 259))) for _ in range(rng.randrange(8))]
        assert model.decode(ids) == library.decode(ids)


def test_a_dead_end_is_taken_back(model):
    """The longest piece first is not always right, so places fail and are not tried again."""
    texts = [d["text"] for d in tricky_documents() if d["text"]]
    longest = 0
    for text in texts:
        for part in model.parts(text):
            greedy, at = [], 0
            while at < len(part):
                known = [n for n in range(1, 17) if part[at : at + n] in model.ids]
                greedy.append(part[at : at + max(known, default=1)])
                at += len(greedy[-1])
            longest += greedy != model.tokens(part)
    assert longest > 100


def test_memory_of_parts_is_bounded(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_PARTS", 50)
    monkeypatch.setattr(pieces, "KNOWN_PAIRS", 20)
    known = pieces._Known(model)
    for d in tricky_documents():
        ids = b"".join(block for block, _ in pieces._blocks(known, d["text"]))
        assert list(memoryview(ids).cast("I")) == library.encode(d["text"] or "")
        assert len(known.held) <= 50 and len(known.older) <= 50


def test_tasks_of_a_worker_share_what_is_known(library):
    content = pieces.read_model(PIECE_BPE)
    known = pieces._shared_known(content)
    for _ in range(2):  # the second task gets its own copy of the content
        again = pieces._shared_known(bytes(bytearray(content)))
        assert again is known and again.model is pieces.shared_model(content)
        for d in tricky_documents():
            ids = b"".join(block for block, _ in pieces._blocks(again, d["text"]))
            assert list(memoryview(ids).cast("I")) == library.encode(d["text"] or "")


def test_encode_and_decode_frames(spark, tricky, library):
    docs = spark.read.parquet(f"{tricky}/documents.parquet")
    content = pieces.read_model(PIECE_BPE)
    rows = pieces.decode(pieces.encode(docs, content), content).collect()
    assert len(rows) == len(tricky_documents()) and set(docs.columns) < set(rows[0].asDict())
    for row in rows:
        ids = library.encode(row["text"] or "", add_bos=True, add_eos=True)
        assert row["piece_ids"] == ids and row["decoded"] == library.decode(ids)


def test_other_kinds_of_models_are_refused(library):
    content = pieces.read_model(PIECE_BPE)
    with pytest.raises(ValueError, match="merge type"):
        pieces.Model(b"".join(bytes([n << 3 | 2]) + _sized(v) for n, v in pieces._fields(content) if n == 1))


def _sized(message: bytes) -> bytes:
    assert len(message) < 128
    return bytes([len(message)]) + message


# --- Merkle manifest --------------------------------------------------------------------------------------


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_levels(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def spelled(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_manifest(documents: list[dict]) -> list[dict]:
    def leaf(d, more=0):
        n = d["n_chars"] if d["n_chars"] is None else d["n_chars"] + more
        return H(*map(spelled, (d["doc_id"], d["source"], d["lang"], n, d["text"])))

    by_lang = defaultdict(list)
    for d in documents:
        by_lang[d["lang"]].append(d)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for rows in by_lang.values():
        rows.sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"], leaf(d)) if d["doc_id"] is not None else (False, 0, leaf(d)))
    trees = {lang: plain_levels([leaf(d) for d in by_lang[lang]]) for lang in langs}
    top = plain_levels([trees[lang][-1][0] for lang in langs])
    out = []
    for number, lang in enumerate(langs):
        for rank, d in enumerate(by_lang[lang]):
            hit = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0
            node, beside = leaf(d, 1) if hit else leaf(d), []
            for levels, place in ((trees[lang], rank), (top, number)):
                for level in levels[:-1]:
                    run = level[place // 2 * 2 : place // 2 * 2 + 2]
                    beside += [x for i, x in enumerate(run) if i != place % 2]
                    run[place % 2] = node
                    node, place = H(*run), place // 2
            root = top[-1][0]
            out.append({"doc_id": d["doc_id"], "leaf": leaf(d), "subroot": trees[lang][-1][0], "root": root,
                        "proof_sha256": H(*beside), "folded_root": node, "verified": node == root})
    return out


@pytest.mark.parametrize("height", [2, 8])
def test_op12_is_the_plain_version(query, tricky, height, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", height)  # low blocks make several tiers
    rows = query("op12_merkle_manifest", tricky)
    assert ordered(rows) == ordered(plain_manifest(tricky_documents()))
    assert {r["verified"] for r in rows} == {True, False}


def test_op12_in_sql(query, tricky, in_sql):
    assert ordered(query("op12_merkle_manifest", tricky)) == ordered(in_sql("op12_merkle_manifest", tricky))


def test_op12_small_tables(spark, query, empty, tmp_path):
    assert query("op12_merkle_manifest", empty) == []
    schema = pq.read_schema(f"{empty}/documents.parquet")
    one = [{"doc_id": 5, "text": "x", "lang": None, "source": "s", "n_chars": None}]
    equal = [{"doc_id": 1, "text": "y", "lang": "en", "source": None, "n_chars": 1}] * 600
    for name, rows in (("one", one), ("equal", equal)):
        (tmp_path / name).mkdir()
        pq.write_table(pa.Table.from_pylist(rows, schema=schema), tmp_path / name / "documents.parquet")
        assert ordered(query("op12_merkle_manifest", str(tmp_path / name))) == ordered(plain_manifest(rows))


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 13, 16])
def test_places_in_the_log_are_closed_forms(count):
    leaves = [bytes([i]) * 32 for i in range(count)]
    height = merkle.levels(count)
    log = merkle.append_log(leaves, height)
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([merkle.digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    places = [(merkle.place(level, i, count), node) for level, nodes in enumerate(levels) for i, node in enumerate(nodes)]
    assert sorted(places) == list(enumerate(log))
    # Postorder: children stand before their parent.
    for level in range(1, height + 1):
        for i in range(len(levels[level])):
            assert merkle.place(level - 1, 2 * i, count) < merkle.place(level, i, count)
    for rank, leaf in enumerate(leaves):
        assert merkle.fold(leaf, merkle.siblings(rank, count, height, b"".join(log))) == log[-1]


def test_log_holds_every_node_once(spark, tricky):
    manifest = merkle.manifest(spark.read.parquet(f"{tricky}/documents.parquet"))
    found = defaultdict(list)
    for row in manifest.log().collect():
        found[bytes(row["tree"])].append((row["at"], bytes(row["node"]).hex()))
    by_lang = defaultdict(int)
    for d in tricky_documents():
        by_lang[b"" if d["lang"] is None else b"=" + d["lang"].encode()] += 1
    assert found.keys() == by_lang.keys()
    for tree, nodes in found.items():
        expected = sum(-(-by_lang[tree] // (1 << level)) for level in range(merkle.levels(by_lang[tree]) + 1))
        assert sorted(at for at, _ in nodes) == list(range(expected))
    assert manifest.root.hex() == plain_manifest(tricky_documents())[0]["root"]


# --- centroid clustering ----------------------------------------------------------------------------------

VECTORS = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32()), ("v", pa.int32()), ("norm", pa.string())])


def tricky_vectors() -> list[dict]:
    """Vectors with ties, repeats, equal ids, NULLs, other lengths and components that are no numbers."""
    rng = np.random.default_rng(3)
    rows = [{"vec_id": i, "embedding": rng.normal(0, 0.3, 64).astype("f4").tolist()} for i in range(120)]
    rows += [dict(rows[3]), {"vec_id": 3, "embedding": rows[4]["embedding"]}, {"vec_id": None, "embedding": rows[5]["embedding"]}]
    rows += [{"vec_id": 200 + i, "embedding": [0.0] * 64} for i in range(5)]
    bad = [None, [], [0.5] * 63, [0.5] * 65, [None, *[0.1] * 63], [float("nan"), *[0.1] * 63], [float("inf"), *[0.1] * 63], [*[0.1] * 63, float("-inf")]]
    rows += [{"vec_id": 300 + i, "embedding": x} for i, x in enumerate(bad)]
    rows += [{"vec_id": 400, "embedding": [1e4, -1e4] * 32}]
    return [{**r, "label": 1, "v": 2, "norm": "n"} for r in rows]


def plain_clusters(rows: list[dict]) -> list[dict]:
    kept = []
    for r in rows:
        x = r["embedding"]
        if x is not None and len(x) == 64 and all(c is not None and np.isfinite(c) for c in x):
            kept.append((r["vec_id"], [int(np.floor(64 * np.float64(np.float32(c)))) for c in x]))
    key = lambda p: (hashlib.sha256(f"1:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1])
    centres = [v for _, v in sorted(kept, key=key)[:16]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(3):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for k, vs in groups.items():
            centres[k] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(vec, *nearest(v)) for vec, v in kept]
    inertia = Counter()
    for _, d, k in found:
        inertia[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [{"vec_id": vec, "cluster": k, "distance": d, "cluster_inertia": inertia[k], "inertia": sum(inertia.values()),
             "centroid_sha256": digest[k]} for vec, d, k in found]


@pytest.fixture
def clustered(spark, tmp_path):
    def run(rows: list[dict]) -> list[dict]:
        pq.write_table(pa.Table.from_pylist(rows, schema=VECTORS), tmp_path / "embeddings.parquet")
        return [r.asDict() for r in llm_queries()["op13_centroid_clustering"](spark, str(tmp_path)).collect()]

    return run


@pytest.mark.parametrize("rows", [tricky_vectors(), tricky_vectors()[:7], tricky_vectors()[-9:-1], []], ids=["all", "few", "none kept", "empty"])
def test_op13_is_the_plain_version(clustered, rows):
    assert ordered(clustered(rows)) == ordered(plain_clusters(rows))


def test_op13_in_sql(clustered, tmp_path):
    found = clustered(tricky_vectors())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet')")
    result = con.execute(ORACLE["op13_centroid_clustering"])
    names = [c[0] for c in result.description]
    assert ordered(found) == ordered([dict(zip(names, r)) for r in result.fetchall()])


def test_a_component_too_large_for_exact_distances_stops_the_job(clustered):
    with pytest.raises(PySparkException, match="lies beyond"):
        clustered([{"vec_id": 1, "embedding": [1e30] * 64}])


def test_products_follow_the_centroids(spark):
    """The kept products equal those computed anew after every round."""
    vectors = centroids.whole_vectors(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
    state, centres = centroids.fit(vectors)
    for row in state.collect():
        assert row["dots"] == [int(x) for x in centres @ np.array(row["v"])] and row["norm"] == sum(x * x for x in row["v"])


def test_only_changed_components_are_carried():
    old, new = np.zeros((3, 4), np.int64), np.zeros((3, 4), np.int64)
    new[1, 2], new[1, 3] = 5, -1
    [(number, at, by)] = centroids.changes(old, new)
    assert (number, at.tolist(), by.tolist()) == (1, [2, 3], [5, -1])
