"""Small tables with every case that the operators define, and plain versions to compare with."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = "the of tion er ing and ou st re an in that it is was on be are ha ti".split()


def prose(rng: random.Random, n: int) -> str:
    """Invented text of n words on lines of ten."""
    words = ["".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 10]) for i in range(0, n, 10))


def tricky_documents() -> list[dict]:
    """Documents with nulls, empty, long and odd texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(11)
    passage = prose(rng, 130)
    base = prose(rng, 300)
    words = base.split(" ")
    texts: list[str | None] = [None, "", " \t\n\x0b\x0c\r ", "one", "two words", "a b c", "a b c d", "A B C D"]
    texts += [prose(rng, n) for n in (9, 10, 12, 40, 80, 150, 200, 260, 5000)]
    texts += [base, base, base, " ".join([*words[:150], "changed", *words[151:]]), " ".join([*words[:20], "x", *words[21:]])]
    texts += [prose(rng, 60) + " " + passage + " " + prose(rng, 30 + i) for i in range(6)]
    texts += ["ab " * 400, "ab " * 500, "a" * 1000, "na " * 700 + passage]
    texts += ["Été ß Σίσυφος ΑΣ 漢字 😀😀 <|endoftext|> don't İ x\x85y ½ é  ", "#$% ### *** " * 30, "la la la la la la la\nla la la la la la la\n" * 4]
    texts += [prose(rng, 90 + 7 * i) for i in range(30)]
    sources = ["web", "books", "Web", None, "é", "zz"]
    rows = [
        {
            "doc_id": i * 7 % 101,
            "text": t,
            "lang": [None, "en", "fr"][i % 3],
            "source": sources[i % len(sources)],
            "n_chars": len(t) if t else None,
        }
        for i, t in enumerate(texts)
    ]
    rows += [dict(rows[20]), dict(rows[20]), dict(rows[0]), {**rows[30], "doc_id": None}, {**rows[31], "doc_id": None}]
    rows.append({"doc_id": rows[10]["doc_id"], "text": rows[12]["text"], "lang": "en", "source": "web", "n_chars": 1})
    for n, row in enumerate(rows):  # names that the operators use themselves
        row |= {"size": n, "key": str(n), "hash": n, "fingerprint": "f", "n": n, "bucket": 1, "target": 0.5, "kept": False, "doc": "d", "d1": 5, "spans": "s", "carried": "c"}
    return rows


DOCUMENT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
    + [("size", pa.int64()), ("key", pa.string()), ("hash", pa.int64()), ("fingerprint", pa.string()), ("n", pa.int64())]
    + [("bucket", pa.int32()), ("target", pa.float64()), ("kept", pa.bool_()), ("doc", pa.string())]
    + [("d1", pa.int64()), ("spans", pa.string()), ("carried", pa.string())]
)
TURN_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("start", pa.int64()), ("name", pa.string())]
)
LABEL_SCHEMA = pa.schema([("doc_id", pa.int64()), ("quality", pa.int64()), ("toxic", pa.int64()), ("text", pa.string())])


def tricky_turns() -> list[dict]:
    """Turns with nulls, repeats, several participants and a conversation of system turns only."""
    said = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello\nthere"), (1, 3, "user", None),
        (2, 0, "ann", "a"), (2, 1, "bob", "b"), (2, 2, "cid", "é😀"), (2, 2, "cid", "é😀"), (2, None, "ann", "first"),
        (3, 0, "system", "alone"), (4, 0, None, "who"), (4, 1, " ", ""), (None, 0, "user", "no id"), (None, 5000, "assistant", "far"),
        (5, 1023, "user", "edge"), (5, 1024, "assistant", "edge"), (5, 1024, "user", "tie"),
    ]
    return [dict(zip(TURN_SCHEMA.names, (*t, 3, "n"), strict=True)) for t in said]


def write_tables(folder, documents: list[dict], turns: list[dict], labels: list[dict]) -> str:
    """Write the three tables as parquet and return their folder."""
    for name, rows, schema in (
        ("documents", documents, DOCUMENT_SCHEMA), ("conversations", turns, TURN_SCHEMA), ("labels", labels, LABEL_SCHEMA),
    ):
        pq.write_table(pa.Table.from_pylist(rows, schema=schema), f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def tricky(tmp_path_factory) -> str:
    """The folder of the tricky tables."""
    labels = [{"doc_id": i, "quality": 1, "toxic": int(i % 5 == 0), "text": "x"} for i in range(40)]
    labels += [{"doc_id": None, "quality": 1, "toxic": 1}, {"doc_id": 3, "quality": None, "toxic": None}, {"doc_id": 5, "quality": 0, "toxic": 0}]
    return write_tables(tmp_path_factory.mktemp("tricky"), tricky_documents(), tricky_turns(), labels)


@pytest.fixture(scope="session")
def empty(tmp_path_factory) -> str:
    """The same tables without rows."""
    return write_tables(tmp_path_factory.mktemp("empty"), [], [], [])


@pytest.fixture(scope="session")
def query(spark):
    """Run a query of the subpackage over a folder and return its rows as dicts."""
    from weir.llm.queries import llm_queries

    def run(name: str, folder: str) -> list[dict]:
        return [r.asDict() for r in llm_queries()[name](spark, folder).collect()]

    return run


@pytest.fixture(scope="session")
def in_sql():
    """Run a query's SQL over a folder and return its rows as dicts."""
    from weir.llm.oracle import ORACLE

    def run(name: str, folder: str) -> list[dict]:
        con = duckdb.connect()
        for table in ("documents", "conversations", "labels"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
        found = con.execute(ORACLE[name])
        return [dict(zip([c[0] for c in found.description], r, strict=True)) for r in found.fetchall()]

    return run


def ordered(rows: list[dict]) -> list[tuple]:
    """Rows as sorted tuples of their columns by name, so that two results can be compared."""
    return sorted((tuple((k, r[k]) for k in sorted(r)) for r in rows), key=repr)
