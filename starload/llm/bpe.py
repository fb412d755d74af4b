"""Byte-pair encoding by backtracking, and decoding through an offset table.

The vocabulary file is read once on the driver and broadcast (one vocabulary, a few MB,
whatever the corpus). Inside a task each distinct word is encoded once: an Aho-Corasick
automaton over all tokens gives the longest match that begins at each position, the shorter
ones are its prefixes. The longest is tried first, and a token is accepted only next to one
it is compatible with, which is the case when merging by rank would leave both as they are.
Positions found to lead nowhere are marked, so no position is left twice and the work is
linear in the word.

Tables and caches belong to a task and go with it, since Spark keeps the processes of a step
for those after it, which need the memory. Ids and decoded text come from one step, so from
one process for each core.

Nulls and empty texts give no ids and decode to the empty string. Texts of any length are
taken whole. Repeated rows are encoded alike; extra columns pass through and one called
like the result column is replaced. An empty table gives no rows.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import read_table, with_text_columns

WORD_FILE = "word_bpe_49k.json"
WORD_END = "</w>"
#: Distance between a character and its form at the end of a word in the automaton's alphabet.
END_SHIFT = 0x1000
#: Sizes of the caches; of pieces and words, as many used before are kept besides.
CACHED_PIECES = 200_000
CACHED_WORDS = 200_000
KNOWN_PAIRS = 250_000
CACHED_LENGTH = 64
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Characters that Python's split() takes for white space and Unicode doesn't.
NOT_WHITE = regex.compile("[\\x1c-\\x1f]")

# Letters and numbers that Unicode 16 has beyond 15.1, as first and last character,
# and capitals newer than 15.1 with their small letters (a range by the distance to them).
LETTERS_16 = (
    "\u1c89\u1c8a \ua7cb\ua7cd \ua7da\ua7dc \U000105c0\U000105f3 \U00010d4a\U00010d65 \U00010d6f\U00010d85 "
    "\U00010ec2\U00010ec4 \U00011380\U00011389 \U0001138b\U0001138b \U0001138e\U0001138e \U00011390\U000113b5 "
    "\U000113b7\U000113b7 \U000113d1\U000113d1 \U000113d3\U000113d3 \U00011bc0\U00011be0 \U00013460\U000143fa "
    "\U00016100\U0001611d \U00016d40\U00016d6c \U00018cff\U00018cff \U0001e5d0\U0001e5ed \U0001e5f0\U0001e5f0"
)
NUMBERS_16 = (
    "\U00010d40\U00010d49 \U000116d0\U000116e3 \U00011bf0\U00011bf9 \U00016130\U00016139 "
    "\U00016d70\U00016d79 \U0001ccf0\U0001ccf9 \U0001e5f1\U0001e5fa"
)
SMALL_LETTERS = {
    **{c: c + 1 for c in (0x1C89, 0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA)},
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
    0xA7CB: 0x264,
    0xA7DC: 0x19B,
}
#: Below this character every Unicode version has the same classes, so the short pattern will do.
SETTLED = "\u0370"
NEWER_CAPITALS = regex.compile("[" + "".join(map(chr, SMALL_LETTERS)) + "]")

#: A pattern with this alternative, and none that takes less of them, has a run of letters as one word.
LETTERS = "|[\\p{L}]+|"

ENCODED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
DECODED = T.StructType([T.StructField("text", T.StringType())])
BOTH = T.StructType([*ENCODED.fields, *DECODED.fields])


def character_class(kind: str, added: str) -> str:
    """Inside of a set: the characters of general category ``kind`` in Unicode 16.

    The pattern's own classes follow the Unicode version of whatever engine reads them; the
    tokenizer's is 16. Python's tables are of 15.1 and lack what ``added`` names.
    """
    new = {c for a, b in added.split() for c in range(ord(a), ord(b) + 1)}
    ranges: list[list[int]] = []
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == kind or c in new:
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def byte_characters() -> list[str]:
    """Printable stand-in for each byte: itself where it prints, else the next free code point."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What tasks need of a tokenizer file: token strings, parts of each merge, special tokens, pattern."""

    tokens: tuple[str, ...]
    keys: tuple[str, ...]
    parts: dict[int, tuple[int, int]]
    ranks: dict[int, int]
    special: tuple[tuple[str, int], ...]
    pattern: str
    #: the pattern with the character classes of the tokenizer's Unicode version written out
    exact: str


def load_vocabulary(path: str) -> Vocabulary:
    """Read a word-level BPE file whose words end with a suffix of their last symbol."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    vocab: dict[str, int] = model["vocab"]
    special = tuple((t["content"], t["id"]) for t in spec["added_tokens"])
    tokens = [""] * (1 + max([*vocab.values(), *(i for _, i in special)]))
    for text, i in [*vocab.items(), *special]:
        tokens[i] = text
    keys, parts, ranks = [""] * len(tokens), {}, {}
    for c in byte_characters():
        keys[vocab[c]] = c
        keys[vocab[c + WORD_END]] = chr(ord(c) + END_SHIFT)
    for rank, (left, right) in enumerate(model["merges"]):
        i, a, b = vocab[left + right], vocab[left], vocab[right]
        if i in parts:
            raise ValueError(f"token {i} has two merges")
        parts[i], ranks[i], keys[i] = (a, b), rank, keys[a] + keys[b]
    exact = pattern = split["pattern"]["Regex"]
    for name, kind, added in (("\\p{L}", "L", LETTERS_16), ("\\p{N}", "N", NUMBERS_16)):
        exact = exact.replace(name, character_class(kind, added))
    return Vocabulary(tuple(tokens), tuple(keys), parts, ranks, special, pattern, exact)


class Encoder:
    """Exact merges of one word at a time."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.length = [len(k) for k in vocabulary.keys]
        self.merged = {pair: i for i, pair in vocabulary.parts.items()}
        self.find = regex.compile(vocabulary.pattern).findall
        self.find_exactly = regex.compile(vocabulary.exact).findall
        self.compatible: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        # A token whose own halves don't stay together is never the outcome of merging.
        self.whole = {
            key: i for i, key in enumerate(vocabulary.keys) if key and (i not in vocabulary.parts or self._reachable(i))
        }
        for key, i in self.whole.items():
            self.automaton.add_word(key, (i, len(key) - 1))
        self.automaton.make_automaton()
        #: the longest other token that each begins with; -1 if there is none
        self.shorter = [-1] * len(vocabulary.keys)
        for key, i in self.whole.items():
            heads = (self.whole.get(key[:k], -1) for k in range(len(key) - 1, 0, -1))
            self.shorter[i] = next((h for h in heads if h >= 0), -1)

    def _reachable(self, token: int) -> bool:
        """Whether the last merge of ``token`` is the one its parts would take."""
        left, right = self.v.parts[token]
        return self._stay_apart(left, right, self.v.ranks[token])

    def _stay_apart(self, left: int, right: int, before: int) -> bool:
        """Whether no merge across the border of ``left`` and ``right`` comes at a rank under ``before``.

        Merges inside the two tokens are undone from the latest back. At each step the two
        symbols at the border stood side by side until the earlier of the merges undone, so
        a merge of these two of a lower rank would have been taken first.
        """
        ranks, parts = self.v.ranks, self.v.parts
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and ranks[joined] < before:
                return False
            a, b = ranks.get(left, -1), ranks.get(right, -1)
            if a < 0 and b < 0:
                return True
            # Of two merges of one rank the left one comes first: the right one is undone first, and a
            # border merge of the right one's rank would have come before it.
            if a > b:
                before, left = min(before, a), parts[left][1]
            else:
                before, right = min(before, b + 1), parts[right][0]

    def _fits(self, left: int, right: int) -> bool:
        """Fill the table of compatible pairs, which starts afresh when full."""
        if len(self.compatible) >= KNOWN_PAIRS:
            self.compatible.clear()
        found = self.compatible[left << 20 | right] = self._stay_apart(left, right, 1 << 60)
        return found

    def encode(self, word: str) -> list[int]:
        """Ids of ``word``, which is in the automaton's alphabet."""
        token = self.whole.get(word)
        if token is not None:
            return [token]
        size, length, known, shorter = len(word), self.length, self.compatible, self.shorter
        longest = [-1] * (size + 1)
        for end, (token, back) in self.automaton.iter(word):
            longest[end - back] = token  # of those that begin here the longest ends last
        alive = bytearray(b"\1") * (size + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            while token >= 0:
                if alive[at + length[token]]:
                    if not out:
                        break
                    fits = known.get(out[-1] << 20 | token)
                    if fits or fits is None and self._fits(out[-1], token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at]
            else:
                alive[at] = 0
                token = out.pop()
                at -= length[token]
                token = shorter[token]
        return out


class Cache(dict):
    """What ``make`` gives for strings; when ``size`` are held it starts afresh, with those before besides."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= CACHED_LENGTH:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found

    def make(self, key: str) -> bytes:
        raise NotImplementedError


class Words(Cache):
    """Ids, as bytes, of words."""

    def __init__(self, encoder: Encoder):
        super().__init__(CACHED_WORDS)
        self.encoder, self.characters = encoder, byte_characters()

    def make(self, key: str) -> bytes:
        if not (key.isascii() and key.isprintable()):  # others stand for themselves
            key = "".join([self.characters[b] for b in key.encode()])
        return array("I", self.encoder.encode(key[:-1] + chr(ord(key[-1]) + END_SHIFT))).tobytes()


class Pieces(Cache):
    """Ids, as bytes, of white-space-free stretches of normalised text."""

    def __init__(self, encoder: Encoder):
        super().__init__(CACHED_PIECES)
        self.words = Words(encoder)
        self.find, self.find_exactly = encoder.find, encoder.find_exactly
        self.letters = LETTERS in encoder.v.pattern

    def make(self, key: str) -> bytes:
        if self.letters and key.isascii() and key.isalpha():
            return self.words[key]
        found = (self.find if max(key, default="") < SETTLED else self.find_exactly)(key)
        return b"".join([self.words[word] for word in found])


class Tokenizer:
    """Encode and decode whole texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.pieces = Pieces(Encoder(vocabulary))
        self.special = {text: array("I", [i]).tobytes() for text, i in vocabulary.special}
        strings = [t.encode() for t in vocabulary.tokens]
        self.offsets = [0]
        for s in strings:
            self.offsets.append(self.offsets[-1] + len(s))
        self.table = b"".join(strings)
        self.cuts = regex.compile("|".join(map(regex.escape, self.special)) or "(?!)")
        self.spaces = regex.compile(f"[{WHITE}]+")
        self.found: dict[int, bytes] = {}

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() looks at the end of words
        text = text.lower()
        if not text.isascii() and NEWER_CAPITALS.search(text):
            text = text.translate(SMALL_LETTERS)
        pieces = self.spaces.split(text) if NOT_WHITE.search(text) else text.split()
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        out, at = [], 0
        for m in self.cuts.finditer(text) if "<" in text else ():
            out += [self._plain(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes | None) -> str:
        """Token strings with one space between; ids outside the table raise."""
        numbers = array("I", ids or b"")
        try:
            return b" ".join(map(self.found.__getitem__, numbers)).decode()
        except KeyError:
            for i in set(numbers).difference(self.found):
                self.found[i] = self.table[self.offsets[i] : self.offsets[i + 1]]
            return b" ".join(map(self.found.__getitem__, numbers)).decode()


def _encoded(t: Tokenizer, texts: pa.Array) -> list[pa.Array]:
    ids = [t.encode(x) for x in texts.to_pylist()]
    return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]


def _decoded(t: Tokenizer, ids: pa.Array) -> list[pa.Array]:
    return [pa.array([t.decode(x) for x in ids.to_pylist()], pa.string())]


def steps_for(spark: SparkSession, path: str):
    """Functions that make the steps of a task: encode, decode, and both one after the other."""
    shared = spark.sparkContext.broadcast(load_vocabulary(path))

    def tokenizer() -> Tokenizer:
        pa.default_memory_pool().release_unused()  # what earlier steps of the process have freed
        return Tokenizer(shared.value)

    def encoding():
        t = tokenizer()
        return lambda texts: _encoded(t, texts)

    def decoding():
        t = tokenizer()
        return lambda ids: _decoded(t, ids)

    def both():
        t = tokenizer()

        def step(texts: pa.Array) -> list[pa.Array]:
            encoded = _encoded(t, texts)
            return [*encoded, *_decoded(t, encoded[1])]

        return step

    return encoding, decoding, both


def encode_texts(docs: DataFrame, path: str, text: str = "text", name: str = "encoded", drop_text: bool = False) -> DataFrame:
    """``docs`` with the struct ``name``: n_tokens, and ids as packed 32-bit integers."""
    encoding, _, _ = steps_for(docs.sparkSession, path)
    return with_text_columns(docs, text, name, ENCODED, encoding, drop_text)


def decode_ids(df: DataFrame, path: str, ids: str, name: str = "decoded") -> DataFrame:
    """``df`` with the struct ``name`` that holds the text of the packed ids in column ``ids``."""
    _, decoding, _ = steps_for(df.sparkSession, path)
    return with_text_columns(df, ids, name, DECODED, decoding)


def encode_and_decode(
    docs: DataFrame, path: str, text: str = "text", name: str = "encoded", drop_text: bool = False
) -> DataFrame:
    """``docs`` with the struct ``name``: n_tokens, packed ids, and the text that these decode to."""
    _, _, both = steps_for(docs.sparkSession, path)
    return with_text_columns(docs, text, name, BOTH, both, drop_text)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of each document."""
    encoded = encode_and_decode(docs.select("doc_id", "text"), path, drop_text=True)
    return encoded.select(
        "doc_id",
        "encoded.n_tokens",
        F.sha2("encoded.ids", 256).alias("ids_sha256"),
        F.sha2(F.col("encoded.text").cast("binary"), 256).alias("decoded_sha256"),
    )


def word_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_FILE)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"), word_file())
