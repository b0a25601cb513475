"""Token ids by the tokenizers library, each distinct word once per worker.

A batch of texts is cut into words and dictionary-encoded by Arrow, so Python sees
only the distinct words of a batch.  Ids of known words lie in one array of small
integers; a text's ids are gathered from there.  Words that a worker has not seen
are encoded together, line by line, in one call for many of them: a line break never
joins a neighbour's piece.  What a worker remembers has two generations and so a
bounded size.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hearthstream.llm.bpe import irregular

LINES = 500
# Words of a generation, about 150 bytes each.
CACHE_WORDS = 600_000
# Texts that are cut into words at once.
SLICE = 1000
CUT = "\0"
# Texts without any of this are regular: white space beside white space, or any but a plain
# space or line break.
DOUBTFUL = (
    r"  | \n|\n |\n\n\n|\n\n\z|[\x00\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# A letter, and one mark after it that ends its word.
ENDED = f"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f])([,.;:!?]{CUT})"


class Generation:
    """Encoded words: where the ids of each begin in one array, and how many it has."""

    def __init__(self):
        self.slots: dict[str, int] = {}
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.used = 0

    def add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Learn new words; ``ids`` are those of all of them, one after the other."""
        first, last = len(self.slots), len(self.slots) + len(words)
        if last > len(self.starts):
            self.starts = np.resize(self.starts, 2 * last)
            self.lengths = np.resize(self.lengths, 2 * last)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(ids)))
        self.slots.update(zip(words, range(first, last), strict=True))
        self.lengths[first:last] = lengths
        self.starts[first:last] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``values`` at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


class BatchEncoder:
    """Ids of whole texts; with ``plain`` the strings of special tokens are ordinary text."""

    def __init__(self, path: str, size: int = CACHE_WORDS, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = plain
        self.special = [] if plain else [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.space = re.compile(r"\s")
        self.line = self._ids("\n")
        self.size = size
        self.now, self.older = Generation(), Generation()

    def _ids(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, np.uint32)

    def _alone(self, lines: list[str], block: str) -> bool:
        """Whether no word holds white space but a space in front."""
        if block.isascii() and not any(c in block for c in "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"):
            found = block.count(" ") + block.count("\n")
        else:
            found = len(self.space.findall(block))
        return found == len(lines) - 1 + sum(w[0] == " " for w in lines)

    def _learn(self, words: list[str]) -> None:
        """Remember words, each with the space before it if it has one."""
        older, known, new = self.older.slots, [], []
        for w in words:
            (known if w in older else new).append(w)
        if known:
            at = np.array([older[w] for w in known])
            lengths = self.older.lengths[at]
            self.now.add(known, gather(self.older.ids, self.older.starts[at], lengths), lengths)
        for k in range(0, len(new), LINES):
            lines = new[k : k + LINES]
            block = "\n".join(lines)
            if len(self.line) == 1 and all(lines) and self._alone(lines, block):
                ids = self._ids(block)
                breaks = np.flatnonzero(ids == self.line[0])
                if len(breaks) == len(lines) - 1:
                    lengths = np.diff(np.concatenate([[-1], breaks, [len(ids)]])) - 1
                    self.now.add(lines, np.delete(ids, breaks), lengths)
                    continue
            for w in lines:
                ids = self._ids(w) if w else np.zeros(0, np.uint32)
                self.now.add([w], ids, np.array([len(ids)]))

    def _slots(self, words: list[str]) -> np.ndarray:
        """Where the current generation has these distinct words."""
        if len(self.now.slots) + len(words) > self.size:
            self.older, self.now = self.now, Generation()
        known = self.now.slots
        found = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [words[k] for k in missing.tolist()]
            self._learn(new)
            found[missing] = np.fromiter(map(known.__getitem__, new), np.int64, len(new))
        return found

    def _regular(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts whose words are parted by single spaces and line breaks, and their number for each."""
        # A cut before every space and around every line break: words keep the space before them.
        marked = pc.replace_substring(pc.replace_substring(texts, " ", CUT + " "), "\n", f"{CUT}\n{CUT}")
        # And before a mark that ends a word: it is a piece of its own there.
        marked = pc.replace_substring_regex(marked, ENDED, r"\1" + CUT + r"\2")
        lists = pc.split_pattern(marked, CUT)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        coded = lists.flatten().dictionary_encode()
        # Through numpy: to_pylist makes a scalar of every word first.
        slot = self._slots(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = slot[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.now.lengths[at]
        counts = np.diff(np.concatenate([[0], np.cumsum(lengths)[ends - 1]])) if len(ends) else ends
        return gather(self.now.ids, self.now.starts[at], lengths), counts

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        doubtful = pc.match_substring_regex(pa.array(texts, pa.large_string()), DOUBTFUL).to_pylist()
        odd = np.array(
            [(d and (CUT in t or irregular(t))) or any(s in t for s in self.special)
             for d, t in zip(doubtful, texts, strict=True)],
            bool,
        )
        plain = np.flatnonzero(~odd)
        ids, counts = self._regular(pa.array([texts[k] for k in plain], pa.large_string()))
        if len(plain) == len(texts):
            return ids, counts
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        ends = np.cumsum(counts)
        for k, a, b in zip(plain.tolist(), (ends - counts).tolist(), ends.tolist(), strict=True):
            parts[k] = ids[a:b]
        for k in np.flatnonzero(odd).tolist():
            parts[k] = self._ids(texts[k])
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


_encoders: dict[tuple[str, bool], BatchEncoder] = {}


def encoder(path: str, plain: bool = False, size: int = CACHE_WORDS) -> BatchEncoder:
    """This worker's encoder, which remembers ``size`` words in each generation."""
    if (path, plain) not in _encoders:
        _encoders[path, plain] = BatchEncoder(path, size, plain)
    return _encoders[path, plain]


def token_bytes(path: str, texts: list[str]) -> list[bytes]:
    """The ids of texts as little-endian unsigned 32-bit integers."""
    out = []
    for k in range(0, len(texts), SLICE):
        ids, counts = encoder(path).batch(texts[k : k + SLICE])
        raw = ids.astype("<u4").tobytes()
        ends = 4 * np.cumsum(counts)
        out += [raw[a:b] for a, b in zip((ends - 4 * counts).tolist(), ends.tolist(), strict=True)]
    return out
