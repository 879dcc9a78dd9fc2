"""Byte-level BPE ids of many texts at once, through the tokenizers library, each word once.

A text is cut before single spaces. The vocabulary's pre-tokenizer starts a new
piece at every space that does not stand between two white-space characters, so
chunks cut there are encoded as they would be in place. Distinct chunks of characters on whose classes all
regular-expression engines agree are cut further, as the pre-tokenizer cuts them, and the distinct pieces go to the library
in long rows: a word is encoded once, whatever mark follows it. Arrow finds what is distinct and which pieces are
remembered, and numpy puts the ids together. Other chunks go to the library by themselves, and texts with white space next to a space or
with a special string as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one worker a core

#: Characters of text that are encoded together, and of distinct pieces that go to the library in one call.
BATCH_CHARS = 6_000_000
JOINED_CHARS = 20_000
#: Pieces that a worker goes on with after it remembered twice as many, and the longest one (in characters) that it keeps.
CACHE_ENTRIES = 150_000
CACHE_CHARS = 48

# Letters of Latin, Cyrillic, Japanese, Chinese and Korean script; ASCII and general punctuation; white space.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯぁ-ゖァ-ヺ一-鿌가-힣"
_MARK = re.escape("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") + "‐-‧‰-⁞、。「」"
_BLANK = r" \t\n\r\x0b\x0c"
_SAFE = rf"^[{_LETTER}0-9{_MARK}{_BLANK}]*$"
# The pre-tokenizer's pieces of a chunk, with the space before it. Of several blanks before another character the last one is
# a piece of its own.
_PIECE = rf"'(?:[sdmt]|ll|ve|re)| ?[{_LETTER}]+| ?[0-9]+| ?[{_MARK}]+"
_PIECES = re.compile(rf"{_PIECE}|[{_BLANK}]+(?!\S)|[{_BLANK}]+")
# A chunk, or a piece, that is a space and one word: it may stand between others of its kind.
_WORD = rf"^ (?:[{_LETTER}]+|[0-9]+|[{_MARK}]+)$"
_SEVERAL_BLANKS = rf"[{_BLANK}][{_BLANK}]+[^{_BLANK}]"
# A chunk that is empty or begins with a blank, and white space other than blanks.
_UNCUT = rf"^ $|^ [{_BLANK}]|[\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{180e}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]"
_CUT = "\x1f"  # never in a chunk that is cut


def _large(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def picked(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the items that ``codes`` name, one after the other, and the size of each."""
    begins, own = np.cumsum(sizes) - sizes, sizes[codes]
    ends = np.cumsum(own)
    if not len(ends):
        return flat[:0], own
    return flat[np.repeat(begins[codes] - (ends - own), own) + np.arange(ends[-1])], own


def sums_between(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def call_offsets(pieces: pa.Array) -> np.ndarray:
    """Where the pieces of each call of the library begin, and the end; a call takes about JOINED_CHARS characters."""
    call = np.cumsum(pc.utf8_length(pieces).to_numpy(), dtype=np.int64) // JOINED_CHARS
    return np.append(np.flatnonzero(np.diff(call, prepend=-1)), len(pieces))


class ByteBpe:
    """One tokenizer file; kept for the life of a worker."""

    _open: dict[str, ByteBpe] = {}

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.opens = np.zeros(size, dtype=bool)  # ids whose bytes begin with a blank
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.opens[i] = piece.startswith("Ġ")
        #: Pieces that are remembered, all their ids, how many each has, and the last batch that held it.
        self.known = pa.array([], pa.large_string())
        self.flat, self.sizes, self.met = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.batch = 0

    @classmethod
    def at(cls, path: str) -> ByteBpe:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        first = chars = 0
        for i, text in enumerate(texts):
            chars += len(text)
            if chars >= BATCH_CHARS or i + 1 == len(texts):
                out += self._batch(texts[first : i + 1])
                first, chars = i + 1, 0
        return out

    def _batch(self, texts: Sequence[str]) -> list[bytes]:
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets, values = split.offsets.to_numpy().astype(np.int64), split.values
        coded = values.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        # A text starts with a chunk that has no space before it.
        starts = values.take(pa.array(offsets[:-1]))
        codes[offsets[:-1]] = len(coded.dictionary) + np.arange(len(texts))
        spaced = pc.binary_join_element_wise(_large(" "), coded.dictionary, _large(""))
        flat, sizes, uncut = self._chunks(pa.concat_arrays([spaced, starts]))
        ids, own = picked(flat, sizes, codes)
        lengths = sums_between(own, offsets)
        raw, ends = ids.tobytes(), (4 * np.cumsum(lengths)).tolist()
        out = [raw[a:b] for a, b in zip([0, *ends], ends)]
        alone = sums_between(uncut[codes].astype(np.int64), offsets) > 0
        for i in np.flatnonzero(alone).tolist():
            out[i] = self.whole(texts[i])
        for special in self.specials:
            if " " in special:
                out = [self.whole(t) if special in t else ids for t, ids in zip(texts, out)]
        return out

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the chunks, how many each has, and which must not be cut out of their texts (these get none)."""
        uncut = pc.match_substring_regex(chunks, _UNCUT)
        for special in self.specials:
            uncut = pc.or_(uncut, pc.match_substring(chunks, special))
        uncut = uncut.to_numpy(zero_copy_only=False)
        word = pc.match_substring_regex(chunks, _WORD).to_numpy(zero_copy_only=False) & ~uncut
        words, rest = np.flatnonzero(word), np.flatnonzero(~word & ~uncut)
        mixed = chunks.take(pa.array(rest))
        safe = pc.and_not(pc.match_substring_regex(mixed, _SAFE), pc.match_substring_regex(mixed, _SEVERAL_BLANKS))
        plain = safe.to_numpy(zero_copy_only=False)
        others = rest[~plain]

        # Plain chunks are cut by Arrow; the first of the parts is what stands before the first mark: nothing.
        marked = pc.replace_substring_regex(mixed.filter(safe), f"({_PIECE}|[{_BLANK}]+)", f"{_CUT}\\1")
        parts = pc.split_pattern(marked, _CUT)
        cut = [self._pieces(c) for c in chunks.take(pa.array(others)).to_pylist()]
        cut_pieces = pa.array([p for c in cut for p in c], pa.large_string())
        values = pa.concat_arrays([chunks.take(pa.array(words)), parts.values, cut_pieces])
        coded = values.dictionary_encode()
        flat, sizes = self._encode(coded.dictionary)
        ids, own = picked(flat, sizes, coded.indices.to_numpy())

        # Back into the order of the chunks: words, plain ones, then the others.
        ends = len(words) + len(parts.values) + np.cumsum([len(c) for c in cut], dtype=np.int64)
        offsets = np.concatenate([np.arange(len(words)), len(words) + parts.offsets.to_numpy().astype(np.int64), ends])
        found = sums_between(own, offsets)
        order = np.concatenate([words, rest[plain], others])
        sizes = np.zeros(len(chunks), dtype=np.int64)
        sizes[order] = found
        place = np.full(len(chunks), -1)
        place[order] = np.arange(len(order))
        flat, _ = picked(ids, found, place[place >= 0])
        return flat, sizes, uncut

    def _pieces(self, chunk: str) -> list[str]:
        pieces = _PIECES.findall(chunk)
        # A character of no known class is left out by the pattern; the library takes such a chunk as it is.
        return pieces if sum(map(len, pieces)) == len(chunk) else [chunk]

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some distinct pieces, and how many each has."""
        rows = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy().astype(np.int64)
        gaps = np.flatnonzero(rows < 0)
        joinable = pc.match_substring_regex(pieces.take(pa.array(gaps)), _WORD).to_numpy(zero_copy_only=False)
        gaps = np.concatenate([gaps[joinable], gaps[~joinable]])
        new, n = pieces.take(pa.array(gaps)), int(joinable.sum())
        parts = [(self.flat, self.sizes), self._joined(new[:n]), self._apart(new[n:])]
        flat, sizes = (np.concatenate(x) for x in zip(*parts))
        rows[gaps] = len(self.known) + np.arange(len(gaps))
        found = picked(flat, sizes, rows)
        self._remember(pa.concat_arrays([self.known, new]), flat, sizes, rows)
        return found

    def _remember(self, pieces: pa.Array, flat: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> None:
        """Keep known and new pieces; of too many those that were met last. ``rows`` are met now."""
        self.batch += 1
        met = np.concatenate([self.met, np.zeros(len(pieces) - len(self.met), dtype=np.int64)])
        met[rows] = self.batch
        keep = pc.less_equal(pc.utf8_length(pieces), CACHE_CHARS).to_numpy(zero_copy_only=False)
        if keep.sum() > 2 * CACHE_ENTRIES:
            order = np.argsort(np.where(keep, -met, 1), kind="stable")
            keep[order[CACHE_ENTRIES:]] = False
        if not keep.all():
            pieces, met, flat, sizes = pieces.filter(pa.array(keep)), met[keep], flat[np.repeat(keep, sizes)], sizes[keep]
        self.known, self.flat, self.sizes, self.met = pieces, flat, sizes, met

    def _joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words that begin with a space, many of them as one text, and how many each has."""
        texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(call_offsets(words)), words), _large(""))
        ids, _ = self._library([text] for text in texts.to_pylist())
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(words):
            raise RuntimeError("the vocabulary joins words over a space")
        return ids, np.diff(starts, append=len(ids))

    def _apart(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of pieces that are texts of their own, and how many each has."""
        offsets = call_offsets(pieces).tolist()
        return self._library(pieces[a:b].to_pylist() for a, b in zip(offsets, offsets[1:]))

    def _library(self, calls: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of each call, and how many each has."""
        ids, sizes = [np.zeros(0, dtype="<u4")], []
        for texts in calls:
            found = [row.ids for row in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(found), "<u4"))
            sizes += map(len, found)
        return np.concatenate(ids), np.array(sizes, dtype=np.int64)
