"""Byte-level BPE encoding and decoding.

A piece of text starts as a doubly linked list of byte symbols.  A priority
queue holds the rank of every adjacent pair; the lowest rank is merged first,
and entries whose symbols have changed meanwhile are stale and skipped.  Decoding
concatenates vocabulary strings.

Text is first cut where the tokenizer itself always starts a new piece, at single
spaces and line breaks between visible characters, so that equal words are encoded
once per worker.  The word caches have two generations and so a bounded size.

Defined results: null counts as empty; the empty text has no ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hearthstream.llm.common import batch_of, map_batches, texts_of

# The piece pattern of the byte-level vocabulary.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Words a worker remembers in each of two generations, about 200 bytes each.
CACHE_WORDS = 300_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids = model["vocab"]
        letters = byte_alphabet()
        back = {c: b for b, c in enumerate(letters)}
        self.byte_ids = [ids[c] for c in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings: dict[int, bytes] = {
            i: bytes(back[c] for c in s)
            for s, i in ids.items()
            if s not in self.special and all(c in back for c in s)
        }
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("|".join(map(re.escape, names))) if names else None

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        symbols = [self.byte_ids[b] for b in piece]
        n = len(symbols)
        if n < 2:
            return symbols
        merges = self.merges
        following = [*range(1, n), -1]
        before = [-1, *range(n - 1)]
        queue = []
        for i in range(n - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            j = following[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue  # stale: one of the two has been merged since
            symbols[i] = merged
            symbols[j] = -1
            k = following[j]
            following[i] = k
            if k >= 0:
                before[k] = i
                found = merges.get((merged, symbols[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, merged, symbols[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbols[h], merged))
                if found:
                    heapq.heappush(queue, (found[0], h, symbols[h], merged, found[1]))
        out = []
        i = 0
        while i >= 0:
            out.append(symbols[i])
            i = following[i]
        return out

    def encode_part(self, part: str, pieces=regex.compile(PATTERN)) -> list[int]:
        """Ids of a text without special tokens, piece by piece."""
        out: list[int] = []
        for piece in pieces.findall(part):
            out += self.merge(piece.encode())
        return out


class _Words(dict):
    """Encoded words; the previous generation is asked before encoding anew."""

    def __init__(self, encode: Callable[[str], object], prefix: str, size: int):
        super().__init__()
        self.encode, self.prefix, self.size = encode, prefix, size
        self.older: dict = {}

    def __missing__(self, word: str):
        value = self.older.get(word)
        if value is None:
            value = self.encode(self.prefix + word)
        self.learn(word, value)
        return value

    def learn(self, word: str, value) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[word] = value

    def unseen(self, words: set[str]) -> list[str]:
        """Those that neither generation knows."""
        older = self.older
        return [w for w in words if w not in self and w not in older]


_RUNS = re.compile(r"[^\S\n]\s|\s[^\S\n]")
_ODD = re.compile(r"[^\S \n]")


def irregular(text: str) -> bool:
    """Whether white space meets white space: the pieces there depend on the whole run.

    Only two line breaks before a visible character are two pieces of their own.
    """
    return (
        "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text
        or text.endswith("\n\n")
        or (_ODD.search(text) is not None and _RUNS.search(text) is not None)
    )


class WordwiseEncoder:
    """Encodes texts through ``encode``, called once per distinct word.

    ``encode`` maps a string without special tokens to an encoded value, and
    ``special`` maps each special string to its value.  The text comes back as
    the list of values in order.
    """

    def __init__(self, encode, special: dict[str, object], size: int = CACHE_WORDS):
        self.encode = encode
        self.special = special
        names = sorted(special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.first = _Words(encode, "", max(1, size // 4))
        self.rest = _Words(encode, " ", size)
        self.newline = encode("\n")

    def _part(self, part: str) -> list:
        if irregular(part):
            return [self.encode(part)]
        return self._lines([line.split(" ") for line in part.split("\n")])

    def _lines(self, lines: list[list[str]]) -> list:
        """Encoded values of a text cut into lines of words."""
        out: list = []
        for k, words in enumerate(lines):
            if k:
                out.append(self.newline)
            if words[0]:
                out.append(self.first[words[0]])
            if len(words) > 1:
                out += map(self.rest.__getitem__, words[1:])
        return out

    def __call__(self, text: str) -> list:
        if not text:
            return []
        if self.cut is None or not self.cut.search(text):
            return self._part(text)
        out: list = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self._part(part)
        return out


_coders: dict[str, tuple[WordwiseEncoder, dict[str, bytes]]] = {}


def coder(path: str) -> tuple[WordwiseEncoder, dict[str, bytes]]:
    """This worker's encoder to comma-joined decimal ids, and the decoding table."""
    if path not in _coders:
        vocabulary = Vocabulary(path)
        _coders[path] = (
            WordwiseEncoder(
                lambda s: ",".join(map(str, vocabulary.encode_part(s))),
                {s: str(i) for s, i in vocabulary.special.items()},
            ),
            {str(i): s for i, s in vocabulary.strings.items()},
        )
    return _coders[path]


def encode_text(path: str, text: str | None) -> list[int]:
    joined = ",".join(coder(path)[0](text or ""))
    return [int(i) for i in joined.split(",")] if joined else []


def decode_ids(path: str, ids: list[int]) -> str:
    table = coder(path)[1]
    return b"".join(table[str(i)] for i in ids).decode("utf-8", "replace")


def encode_decode(
    documents: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text",
    ids: bool = False,
) -> DataFrame:
    """Per document: token count, digests of the ids and of the decoded text.

    With ``ids`` also the ids and the decoded text themselves.
    """
    schema = pa.schema(
        [(id_column, pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
         ("decoded_sha256", pa.string())]
        + ([("ids", pa.list_(pa.int32())), ("decoded", pa.string())] if ids else [])
    )

    def work(batches):
        encode, table = coder(vocabulary)
        for batch in batches:
            rows: list[list] = [[] for _ in range(len(schema) - 1)]
            for t in texts_of(batch.column(1)):
                joined = ",".join(encode(t))
                tokens = joined.split(",") if joined else []
                decoded = b"".join(map(table.__getitem__, tokens)).decode("utf-8", "replace")
                values = [
                    len(tokens),
                    hashlib.sha256(joined.encode()).hexdigest(),
                    hashlib.sha256(decoded.encode()).hexdigest(),
                ]
                if ids:
                    values += [[int(i) for i in tokens], decoded]
                for r, v in zip(rows, values, strict=True):
                    r.append(v)
            yield batch_of(schema, [batch.column(0).cast(pa.int64()), *rows])

    extra = ", ids array<int>, decoded string" if ids else ""
    return map_batches(
        documents.select(id_column, text), work,
        f"`{id_column}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}",
    )
