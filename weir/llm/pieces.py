"""SentencePiece encoding and decoding of merge-type models, by backtracking instead of merging.

A merge-type encoder joins the adjacent pieces with the best score, the leftmost first, until nothing joins. A row
of tokens is that encoding exactly if each token is the encoding of its own text and each two adjacent tokens are
the encoding of theirs. So the encoder walks a text from the left. At each place an Aho-Corasick automaton knows the
pieces that start there, the longest first. The longest is taken if it may follow the last token, which merging
the text of the two again decides; if not, the next shorter one; if none may, the last token is taken back
and its end is marked, in a bitfield, as a place that no encoding reaches. Each place fails once at most.

Where no piece spans a certain pair of characters, such as a letter before a space, a text is cut there: its
parts encode one by one, and a worker remembers the shorter parts for its tasks. A character that no piece has becomes its bytes.

Defined cases: a NULL text is the empty one, whose ids are those of begin and end; an empty table gives an
empty result; repeated rows get equal results; ids outside the vocabulary stop ``decode``; columns other than the named
ones are ignored by ``encode_digests`` and passed on by ``encode``. A text of any length is encoded whole.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice, pairwise

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.common import small_batches

#: The character that stands for a space in pieces.
SPACE = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

#: Parts of texts and pairs of tokens that a worker remembers; longer parts are encoded anew each time.
KNOWN_PARTS, KNOWN_PAIRS, LONGEST_KNOWN = 300_000, 500_000, 48
#: Bytes of text in a batch, or one text that is larger; parts of a text that are looked up at once.
BATCH_BYTES, PARTS_AT_ONCE = 4 << 20, 1 << 16
#: Texts from this length on are cut into parts as these are needed.
LONG_TEXT = 1 << 20
#: Characters of a long part whose pieces are searched at once; rows of ids that are decoded at once.
SEARCHED, DECODED_ROWS = 1 << 14, 256


def read_model(path: str) -> bytes:
    """The model file's content; it travels to the executors with the code that uses it."""
    with open(path, "rb") as file:
        return file.read()


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message; a 4-byte value is given as its bytes."""
    at = 0

    def whole() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = whole()
        kind = key & 7
        if kind == 0:
            yield key >> 3, whole()
            continue
        size = whole() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, message[at : at + size]
        at += size


class Model:
    """Pieces with their ranks, read from a model file of the merge type."""

    def __init__(self, content: bytes) -> None:
        self.texts: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer: dict[int, int | bytes] = {}
        normalizer: dict[int, int | bytes] = {}
        for number, value in _fields(content):
            if number == 1:
                piece = dict(_fields(value))
                self.texts.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("the model is not of the merge type")
        # Fixed values of the file format: names in the normalizer's part, and what they are where absent.
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24, 0):
            raise ValueError("the model normalizes characters or white space, which is not supported")
        if USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("pieces that are user-defined or unused are not supported")
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        self.bytes_ = {int(t[1:-1], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes_.items()}
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown, self.begin, self.end = (trainer.get(40, 0), trainer.get(41, 1), trainer.get(42, 2))

        ids = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == NORMAL}
        # Pieces of one score are of one rank: among these only their places count.
        ranks = {score: rank for rank, score in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        self.rank = {t: ranks[scores[i]] for t, i in ids.items()}
        self.ids = ids
        #: Characters of pieces; one that is no piece itself still takes part in merges.
        self.letters = {c for t in ids for c in t}
        self.longest = max(map(len, ids), default=1)
        #: What ``decode`` writes for each id.
        self.spelled = [self._spell(i) for i in range(len(self.texts))]
        self._pairs: dict[str, dict[str, bool]] = {}
        self._pair_count = 0
        #: The first that fits among the pieces that start where a longest one does, after each token.
        self._firsts: dict[str, dict[str, int]] = {}
        self._first_count = 0
        self._prefixes: dict[str, tuple[str, ...]] = {}
        self._finder = self._automaton()
        self._cut = self._cutter()
        self._spans_space = any(SPACE in t.lstrip(SPACE) for t in ids)

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by merging, as the tests of tokens and pairs need it."""
        parts, rank = list(text), self.rank
        none = len(rank)
        joins = [rank.get(a + b, none) for a, b in pairwise(parts)]
        while joins and (best := min(joins)) < none:
            at = joins.index(best)  # the leftmost
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joins[at]
            if at:
                joins[at - 1] = rank.get(parts[at - 1] + parts[at], none)
            if at < len(joins):
                joins[at] = rank.get(parts[at] + parts[at + 1], none)
        return parts

    def fits(self, a: str, b: str) -> bool:
        """Whether tokens ``a`` and ``b`` may follow each other: their texts merged again give them back."""
        if self._pair_count >= KNOWN_PAIRS:
            self._pairs.clear()
            self._pair_count = 0
        self._pair_count += 1
        found = self._pairs.setdefault(a, {})[b] = self.merged(a + b) == [a, b]
        return found

    def _automaton(self) -> ahocorasick.Automaton:
        """Finds pieces backwards, so that those which start at one place come together, the longest first."""
        finder = ahocorasick.Automaton()
        whole = {p for p in self.ids.keys() | self.letters if len(p) == 1 or self.merged(p) == [p]}
        for piece in whole:
            finder.add_word(piece[::-1], piece)
            # What else starts where a piece starts, when none longer does, are its own beginnings.
            self._prefixes[piece] = tuple(p for n in range(len(piece), 0, -1) if (p := piece[:n]) in whole)
        finder.make_automaton()
        return finder

    def _cutter(self) -> re.Pattern:
        """Parts of a text that no piece spans: spaces with what follows them, if no piece has a space further on."""
        return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def longest_at(self, text: str) -> dict[int, str]:
        """The longest piece that starts at each place of a text, by the place's distance from the last one."""
        # The automaton gives the longest of a place first, so here it is written last.
        return dict(reversed(list(self._finder.iter(text[::-1]))))

    def _first_fit(self, last: str, longest: str) -> int:
        """Which of the pieces that start where ``longest`` does is the first that may follow ``last``."""
        choices, known = self._prefixes[longest], self._pairs.get(last, {})
        for number, piece in enumerate(choices):
            good = known.get(piece)
            if good if good is not None else self.fits(last, piece):
                break
        else:
            number = len(choices)
        if self._first_count >= KNOWN_PAIRS:
            self._firsts.clear()
            self._first_count = 0
        self._first_count += 1
        self._firsts.setdefault(last, {})[longest] = number
        return number

    def _backtrack(self, text: str) -> list[str]:
        """The tokens of a part whose characters all occur in pieces."""
        size = len(text)
        last_place = size - 1
        longest = self.longest_at(text) if size <= SEARCHED else _Stretches(self, text)
        prefixes, firsts = self._prefixes, self._firsts
        failed: bytearray | None = None  # a bit for each place that no encoding reaches
        tokens: list[str] = []
        tried = array("B")  # how many of the pieces that start at a token's place came before it
        at, skip, last = 0, 0, ""
        known: dict[str, int] = {}
        while at < size:
            start = longest[last_place - at]
            choices = prefixes[start]
            number, sure = skip, -1
            if last and not skip:
                number = known.get(start, -1)
                if number < 0:
                    number = self._first_fit(last, start)
                sure = number
            while number < len(choices):
                piece = choices[number]
                end = at + len(piece)
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    # The first that fits is known; those after it are looked at one by one.
                    if number == sure or not last or self._may_follow(last, piece):
                        break
                number += 1
            if number < len(choices):
                tokens.append(piece)
                tried.append(number)
                at, skip, last = end, 0, piece
            else:
                if not tokens:
                    raise ValueError(f"no encoding of {text[:40]!r}")
                if failed is None:
                    failed = bytearray((size >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(tokens.pop())
                skip = tried.pop() + 1
                last = tokens[-1] if tokens else ""
            known = firsts.get(last) or {}
        return tokens

    def _may_follow(self, last: str, piece: str) -> bool:
        """``fits``, looked up first."""
        found = self._pairs.get(last, {}).get(piece)
        return self.fits(last, piece) if found is None else found

    def tokens(self, part: str) -> list[str]:
        """The tokens of a part; characters that no piece has stand alone."""
        if self.letters.issuperset(part):
            return self._backtrack(part)
        out: list[str] = []
        at = 0
        for place, letter in enumerate(part):
            if letter not in self.letters:
                out += self._backtrack(part[at:place])
                out.append(letter)
                at = place + 1
        return out + self._backtrack(part[at:])

    def part_ids(self, part: str) -> list[int]:
        """The ids of a part; what is no piece is spelled as bytes, or is unknown."""
        out: list[int] = []
        for token in self.tokens(part):
            found = self.ids.get(token)
            if found is not None:
                out.append(found)
            elif self.byte_fallback:
                out += [self.bytes_[b] for b in token.encode()]
            else:
                out.append(self.unknown)
        return out

    def parts(self, text: str | None) -> Iterator[str]:
        """The parts of a text that encode one by one."""
        if not text:
            return iter(())
        spelled = self.prefix + text.replace(" ", SPACE)
        if self._spans_space:
            return iter((spelled,))
        if len(text) < LONG_TEXT:
            return iter(self._cut.findall(spelled))
        return (m.group() for m in self._cut.finditer(spelled))

    def encode(self, text: str | None, begin: bool = True, end: bool = True) -> list[int]:
        """All ids of a text."""
        ids = [self.begin] * begin
        for part in self.parts(text):
            ids += self.part_ids(part)
        return ids + [self.end] * end

    def _spell(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == BYTE:
            return bytes([self.byte_of[i]])
        if kind == UNKNOWN:
            return " \u2047 ".encode()
        return self.texts[i].replace(SPACE, " ").encode() if kind == NORMAL else b""

    def decoded_bytes(self, ids: Iterable[int]) -> bytes:
        """What ids stand for, the space before the first piece included."""
        return b"".join(map(self.spelled.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: begin and end say nothing, and the space that encoding put first goes."""
        ids = [i for i in ids if self.kinds[i] != CONTROL]
        out = self.decoded_bytes(ids)
        if self.prefix and ids and self.kinds[ids[0]] == NORMAL and self.texts[ids[0]].startswith(SPACE):
            out = out[1:]
        return _readable(out)


class _Stretches:
    """``longest_at`` of a long part, searched stretch by stretch as the walk gets there; neighbouring stretches stay."""

    def __init__(self, model: Model, text: str) -> None:
        self.model, self.text, self.last, self.held = model, text, len(text) - 1, {}

    def __getitem__(self, back: int) -> str:
        number, at = divmod(self.last - back, SEARCHED)
        if number not in self.held:
            start = number * SEARCHED
            # Pieces that start in the stretch may reach beyond it.
            window = self.text[start : start + SEARCHED + self.model.longest - 1]
            found = len(window) - 1, self.model.longest_at(window)
            self.held = {n: x for n, x in self.held.items() if abs(n - number) <= 1} | {number: found}
        end, longest = self.held[number]
        return longest[end - at]


def _readable(spelled: bytes) -> str:
    """UTF-8 as text; each byte that is no part of a character becomes U+FFFD."""
    out = []
    while True:
        try:
            return "".join([*out, spelled.decode()])
        except UnicodeDecodeError as error:
            out += [spelled[: error.start].decode(), "\ufffd"]
            spelled = spelled[error.start + 1 :]


@lru_cache(maxsize=1)
def shared_model(content: bytes) -> Model:
    """One model for the tasks that a Python worker runs one after the other, with what it remembers of pairs."""
    return Model(content)


@lru_cache(maxsize=1)
def _shared_known(content: bytes) -> _Known:
    return _Known(shared_model(content))


class _Known:
    """What a worker remembers of parts: their ids and what these decode to, as bytes.

    When it is full, the parts seen since it was last full stay until it is full again.
    """

    def __init__(self, model: Model) -> None:
        self.model, self.held, self.older = model, {}, {}

    def __call__(self, part: str) -> tuple[bytes, bytes]:
        found = self.held.get(part)
        if found is not None:
            return found
        found = self.older.get(part)
        if found is None:
            ids = self.model.part_ids(part)
            found = array("I", ids).tobytes(), self.model.decoded_bytes(ids)
        if len(part) <= LONGEST_KNOWN:
            if len(self.held) >= KNOWN_PARTS:
                self.held, self.older = {}, self.held
            self.held[part] = found
        return found


def _blocks(known: _Known, text: str | None) -> Iterator[tuple[bytes, bytes]]:
    """Ids and decoded bytes of a text, a block of parts at a time."""
    parts, first = known.model.parts(text), True
    while block := list(islice(parts, PARTS_AT_ONCE)):
        held = known.held
        found = [held.get(part) or known(part) for part in block]
        decoded = b"".join([f[1] for f in found])
        if first and known.model.prefix and decoded.startswith(b" "):
            decoded = decoded[1:]  # the space that encoding put first
        yield b"".join([f[0] for f in found]), decoded
        first = False


def encode_digests(docs: DataFrame, content: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, begin and end ids included.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the decoded text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _shared_known(content)
        begin, end = (array("I", [i]).tobytes() for i in (known.model.begin, known.model.end))
        for batch in small_batches(batches, "text", BATCH_BYTES):
            counts, ids, texts = [], [], []
            for text in batch.column("text"):
                count, id_digest, text_digest = 2, hashlib.sha256(begin), hashlib.sha256()
                for block, decoded in _blocks(known, text.as_py()):
                    count += len(block) // 4
                    id_digest.update(block)
                    text_digest.update(decoded)
                id_digest.update(end)
                counts.append(count), ids.append(id_digest.hexdigest()), texts.append(text_digest.hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def encode(docs: DataFrame, content: bytes, out: str = "piece_ids") -> DataFrame:
    """Add the ids of ``text``, begin and end included, as an array; the other columns are passed on."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _shared_known(content)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            rows = []
            for text in batch.column("text"):
                ids = array("I", [known.model.begin])
                for block, _ in _blocks(known, text.as_py()):
                    ids.frombytes(block)
                ids.append(known.model.end)
                rows.append(ids)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(pa.int32()))], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, content: bytes, ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """Add the text of an array of ids; NULL ids decode to the empty text."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model(content)
        for batch in batches:
            for at in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(at, DECODED_ROWS)
                texts = [model.decode(x.as_py() or []) for x in part.column(ids)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
