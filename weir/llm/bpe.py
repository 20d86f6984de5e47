"""BPE encoding and decoding by a trie of distinct words.

The text is normalized and cut at spaces and line breaks, which end every word; only what is new among the parts of many
documents is split into words. Their distinct words are put in order, which is their trie of symbols in preorder, and one
depth-first walk gives each node its last token, that is, the token that ends the encoding of the prefix that the node
stands for. That token is the only suffix token that forms a lawful pair with the last token before it, so each prefix
that words share is encoded once. A word's tokens are read by walking back from its node: last token, the node before
that token, and so on.

A pair of tokens is lawful if merging their symbols in order of rank leaves the border between them alone.

Documents are independent, so Spark deals them and nothing is shuffled. Memory is bounded: parts gather up to
``FLUSH_PARTS``, then they are encoded and the documents' digests move on, also in the midst of a long text. A part of
over ``LONG_PART`` characters counts as its words.

Defined cases: a NULL text is empty, an empty text has no tokens; the strings of added tokens in a text are
those tokens; repeated rows give repeated results; an empty table gives an empty result; columns other
than ``text`` are passed on by ``encode`` and ignored by ``encode_digests``.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weir.llm.common import small_batches

#: Parts that are gathered before they are encoded, and parts and words whose encodings are remembered. Beyond that
#: only those that occur among the gathered ones are.
FLUSH_PARTS = 500_000
KNOWN_PARTS = 400_000
KNOWN_WORDS = 300_000
#: Parts of more characters are not remembered as a whole.
LONG_PART = 64
#: Pairs of tokens whose lawfulness a task remembers.
KNOWN_PAIRS = 500_000
#: Bytes of text, or documents, whose tokens are in memory at a time.
BATCH_BYTES = 4 << 20
DECODED_ROWS = 500
#: Texts from this many characters on are split lazily.
LONG_TEXT = 1 << 20
END = "</w>"
_PART = regex.compile(r"[^ \n]+")


def read_definition(path: str) -> str:
    """The tokenizer file as text."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def byte_letters() -> str:
    """A printable letter for each byte: visible Latin-1 characters stand for themselves, the rest for U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b if b in visible else next(spare)) for b in range(256))


class Vocabulary:
    """Tokens, their merges and the text rules of a tokenizer file with word ends."""

    def __init__(self, definition: str) -> None:
        loaded = json.loads(definition)
        model = loaded["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: name for name, i in self.ids.items()}
        self.added = {x["content"]: x["id"] for x in loaded["added_tokens"]}
        self.names |= {i: name for name, i in self.added.items()}
        self.letters = dict(enumerate(byte_letters()))
        split = loaded["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(split)
        self.definition, self.split = definition, split
        self._familiar: set[str] = set()
        self._library: tuple | None = None
        self.special = regex.compile("|".join(map(regex.escape, self.added)) or r"(?!)")
        # rank of a merge by its two tokens, and the merge that made a token
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = self.ids[a], self.ids[b]
            self.ranks[pair] = rank
            self.made.setdefault(self.ids[a + b], (*pair, rank))
        self._edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self._lawful: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._endings: tuple | None = None
        self._encoded: dict[str, list[int]] = {}

    def parts(self, text: str) -> Iterator[str | tuple[str | int]]:
        """What stands between the spaces and line breaks of the normalized text.

        What is long there, or has characters that Python does not know, comes as its words, each as a tuple, and the
        strings of added tokens as their ids.
        """
        at = 0
        if not any(name in text for name in self.added):
            return self._plain(text)
        pieces: list[Iterator] = []
        for found in self.special.finditer(text):
            pieces += self._plain(text[at : found.start()]), iter([(self.added[found.group()],)])
            at = found.end()
        return chain(*pieces, self._plain(text[at:]))

    def _plain(self, text: str) -> Iterator[str | tuple[str]]:
        if not text.isascii():
            if self._young(text):
                return self._by_library(text)
            # Lower case goes by characters, without regard to where in a word a sigma stands.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if len(text) < LONG_TEXT:
            parts = text.replace("\n", " ").split(" ")
            return iter(parts) if max(map(len, parts)) <= LONG_PART else self._short(parts)
        return self._short(m.group() for m in _PART.finditer(text))

    def _short(self, parts: Iterable[str]) -> Iterator[str | tuple[str]]:
        for part in parts:
            if len(part) <= LONG_PART:
                yield part
            else:
                for found in self.word.finditer(part):
                    yield (found.group(),)

    def part_words(self, part: str | tuple[str | int]) -> Sequence[str | int]:
        """The words of a part; letters alone are one."""
        if isinstance(part, tuple):
            return part
        return (part,) if part.isalpha() else self.word.findall(part)

    def words(self, text: str) -> Iterator[str | int]:
        """The words of a text, or ids for the strings of added tokens."""
        return chain.from_iterable(map(self.part_words, self.parts(text)))

    def _young(self, text: str) -> bool:
        """Whether a text has a character that is not assigned in this Python's Unicode tables."""
        new = set(text).difference(self._familiar)
        if any(unicodedata.category(letter) == "Cn" for letter in new):
            return True
        self._familiar |= new
        return False

    def _by_library(self, text: str) -> Iterator[str | tuple[str]]:
        """The words of a text with young characters.

        Python, its ``regex`` module and the tokenizers library each have tables of another Unicode version, which agree
        on what is assigned in the oldest, Python's. So a stretch between spaces that has a young character is
        normalized and split by the library itself; a space ends every word and composes with nothing.
        """
        if self._library is None:
            from tokenizers import Regex, Tokenizer, pre_tokenizers

            normalizer = Tokenizer.from_str(self.definition).normalizer
            self._library = normalizer, pre_tokenizers.Split(Regex(self.split), "removed", invert=True)
        normalizer, splitter = self._library
        for stretch in text.split(" "):
            if self._young(stretch):
                for word, _ in splitter.pre_tokenize_str(normalizer.normalize_str(stretch)):
                    yield (word,)
            else:
                yield from self._plain(stretch)

    def symbols(self, word: str) -> str:
        """A letter for each byte of a word."""
        if word.isascii() and word.isprintable():
            return word
        return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The tokens that stand at one border of ``token`` while it is made, each with the rank that ends it."""
        key = token, right
        if key not in self._edges:
            steps, ends = [], 1 << 60
            while True:
                steps.append((token, ends))
                if token not in self.made:
                    break
                left_part, right_part, ends = self.made[token]
                token = right_part if right else left_part
            self._edges[key] = steps[::-1]
        return self._edges[key]

    def border_stays(self, a: int, b: int, until: int) -> bool:
        """Whether no merge before rank ``until`` joins the end of token ``a`` with the start of token ``b``."""
        left, right, i, j = self._edge(a, True), self._edge(b, False), 0, 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            rank = self.ranks.get((x, y), until)
            # Merges of one rank go from left to right: the left neighbour takes x first, y waits for x.
            if rank < until and rank < x_ends and rank <= y_ends:
                return False
            if min(x_ends, y_ends) >= until:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def lawful(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` may follow each other in an encoding."""
        key = a << 32 | b
        found = self._lawful.get(key)
        if found is None:
            if len(self._lawful) > KNOWN_PAIRS:
                self._lawful.clear()
            found = self._lawful[key] = self.border_stays(a, b, 1 << 59)
        return found

    def whole(self, token: int) -> bool:
        """Whether a token's own text encodes as that token."""
        found = self._whole.get(token)
        if found is None:
            if token not in self.made:
                found = True
            else:
                a, b, rank = self.made[token]
                found = self.whole(a) and self.whole(b) and self.border_stays(a, b, rank)
            self._whole[token] = found
        return found

    def endings(self) -> tuple[list[dict[str, int]], list[int], list[tuple]]:
        """An automaton over letters that knows which whole tokens end at each place.

        For each state: the states that letters lead to, the state of the longest proper suffix, and the tokens that end
        there with their lengths, the longest first.
        """
        if self._endings is None:
            steps: list[dict[str, int]] = [{}]
            ends: list[tuple] = [()]
            for name, token in self.ids.items():
                if not self.whole(token):
                    continue
                letters, state = name.removesuffix(END), 0
                for letter in [*letters[:-1], letters[-1] + END * (letters != name)]:
                    after = steps[state].get(letter)
                    if after is None:
                        after = steps[state][letter] = len(steps)
                        steps.append({})
                        ends.append(())
                    state = after
                ends[state] = ((token, len(letters)),)
            shorter, queue = [0] * len(steps), list(steps[0].values())
            for state in queue:  # shorter states come first
                for letter, after in steps[state].items():
                    back = shorter[state]
                    while back and letter not in steps[back]:
                        back = shorter[back]
                    shorter[after] = steps[back].get(letter, 0)
                    queue.append(after)
                ends[state] += ends[shorter[state]]
            self._endings = steps, shorter, ends
        return self._endings

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """The token ids of distinct words, by a depth-first walk over their trie.

        Words in order are their trie in preorder: what a word shares with the one before it is the path to the node
        where it branches off, whose last tokens are still there. The last letter of a word carries the word end, so it
        is another symbol than that letter within a word and always a leaf.
        """
        (steps, shorter, ends), known = self.endings(), self._lawful
        out: dict[str, list[int]] = {}
        path = ""
        # the last token of each prefix of the path with its length, that of no letters first, and the prefix's state
        lasts, states = [(-1, 0)], [0]
        for letters, word in sorted([(self.symbols(word), word) for word in words]):
            leaf = len(letters) - 1
            shared, most = 0, min(len(lasts) - 1, leaf)
            while shared < most and letters[shared] == path[shared]:
                shared += 1
            del lasts[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for depth, letter in enumerate([*letters[shared:leaf], letters[leaf] + END], shared + 1):
                after = steps[state].get(letter)
                if after is None:
                    back = shorter[state]
                    while back and letter not in steps[back]:
                        back = shorter[back]
                    after = steps[state][letter] = steps[back].get(letter, 0)
                state = after
                # The lawful one among the tokens that end here is the last token.
                for ending in ends[state]:
                    token, length = ending
                    if length > depth:
                        break
                    last = lasts[depth - length][0]
                    fits = known.get(last << 32 | token)
                    if fits or (fits is None and self.lawful(last, token)):
                        break
                else:
                    raise ValueError(f"no token ends {letters[:depth]!r}")
                lasts.append(ending)
                states.append(state)
            found, depth = [], leaf + 1
            while depth:
                token, length = lasts[depth]
                found.append(token)
                depth -= length
            out[word] = found[::-1]
            del lasts[leaf + 1 :], states[leaf + 1 :]  # the leaf is no prefix of other words
            path = letters
        return out

    def encodings(self, words: set[str]) -> dict[str, list[int]]:
        """The token ids of these words at least; known ones are not encoded again."""
        new = words.difference(self._encoded)
        if len(self._encoded) + len(new) > KNOWN_WORDS:
            self._encoded = {word: self._encoded[word] for word in words.difference(new)}
        self._encoded |= self.encode_words(new)
        return self._encoded

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' names, parted by spaces; unknown ids are left out."""
        return " ".join([self.names[i] for i in ids if i in self.names])


@lru_cache(maxsize=1)
def shared_vocabulary(definition: str) -> Vocabulary:
    """One vocabulary for the tasks that a Python worker runs one after the other, with what it remembers."""
    return Vocabulary(definition)


@lru_cache(maxsize=1)
def _shared_known(definition: str, digits: bool, names: bool) -> _Known:
    return _Known(shared_vocabulary(definition), digits, names)


class _Known:
    """What is remembered of parts, for the tasks of a Python worker: (token ids or their number, the ids as text or "",
    what they decode to or ""), or None where a part has no word."""

    def __init__(self, vocabulary: Vocabulary, digits: bool, names: bool) -> None:
        self.vocabulary, self.digits, self.names = vocabulary, digits, names
        self.held: dict[str | tuple[str | int], tuple | None] = {}

    def spell(self, ids: list[int]) -> tuple:
        decoded = self.vocabulary.decode(ids) if self.names else ""
        return (len(ids), " ".join(map(str, ids)), decoded) if self.digits else (ids, "", decoded)

    def learn(self, parts: set[str | tuple[str | int]]) -> None:
        new = parts.difference(self.held)
        if len(self.held) + len(new) > KNOWN_PARTS:
            self.held = {part: self.held[part] for part in parts.difference(new)}
        split = {part: self.vocabulary.part_words(part) for part in new}
        encoded = self.vocabulary.encodings({w for words in split.values() for w in words if isinstance(w, str)})
        for part, words in split.items():
            ids = [i for w in words for i in (encoded[w] if isinstance(w, str) else (w,))]
            self.held[part] = self.spell(ids) if ids else None


def _in_blocks(texts: Iterable[str | None], known: _Known) -> Iterator[tuple[int, bool, list]]:
    """(number of the text, whether it ends, what is known of its next parts) for all texts in turn."""
    waiting: list[tuple[int, bool, list]] = []
    size = 0

    def flush() -> Iterator[tuple[int, bool, list]]:
        known.learn(set().union(*(found for _, _, found in waiting)))
        held = known.held
        for number, ends, found in waiting:
            yield number, ends, [k for part in found if (k := held[part])]

    for number, text in enumerate(texts):
        left = known.vocabulary.parts(text or "")
        while True:
            found = list(islice(left, FLUSH_PARTS - size))
            size += len(found)
            ends = size < FLUSH_PARTS
            waiting.append((number, ends, found))
            if not ends:
                yield from flush()
                waiting, size = [], 0
            else:
                break
    yield from flush()


def encode_digests(docs: DataFrame, definition: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text.

    The digests are of the decimal ids parted by spaces and of the decoded text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _shared_known(definition, digits=True, names=True)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            counts, ids, names = [], [], []
            count, id_digest, name_digest = 0, hashlib.sha256(), hashlib.sha256()
            for _, ends, found in _in_blocks((x.as_py() for x in batch.column("text")), known):
                if found:
                    part = b" " if count else b""
                    id_digest.update(part + " ".join([f[1] for f in found]).encode())
                    name_digest.update(part + " ".join([f[2] for f in found]).encode())
                    count += sum([f[0] for f in found])
                if ends:
                    counts.append(count), ids.append(id_digest.hexdigest()), names.append(name_digest.hexdigest())
                    count, id_digest, name_digest = 0, hashlib.sha256(), hashlib.sha256()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(names, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode(docs: DataFrame, definition: str, out: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """Add the token ids of ``text`` as an array; the other columns are passed on.

    With ``decoded`` the text that the ids decode to is added too, from the same pass over the words.
    """
    added = [T.StructField(out, T.ArrayType(T.IntegerType()))]
    added += [T.StructField(decoded, T.StringType())] if decoded else []
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _shared_known(definition, digits=False, names=decoded is not None)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            encoded: list[list[int]] = [[] for _ in range(batch.num_rows)]
            names: list[list[str]] = [[] for _ in range(batch.num_rows)]
            for number, _, found in _in_blocks((x.as_py() for x in batch.column("text")), known):
                encoded[number].extend(chain.from_iterable([f[0] for f in found]))
                if decoded and found:
                    names[number].append(" ".join([f[2] for f in found]))
            columns = [*batch.columns, pa.array(encoded, pa.list_(pa.int32()))]
            if decoded:
                columns.append(pa.array([" ".join(x) for x in names], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, definition: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the decoded text of an array of token ids; NULL ids decode to the empty text."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared_vocabulary(definition)
        for batch in batches:
            for at in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(at, DECODED_ROWS)
                texts = [vocabulary.decode(x.as_py() or []) for x in part.column(ids)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
