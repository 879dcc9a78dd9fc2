"""SentencePiece encoding and decoding as a shortest path through a weighted transducer.

The model is compiled into three machines. The normaliser turns blanks into the
word mark and puts one in front; it is rewritten on the text itself. The lexicon maps runs
of characters to pieces, and a character in no piece to its bytes. The grammar
weighs a piece by the one before it. A text composed with them is a lattice from
its first to its last character; the path of the least sum of weights
(tropical semiring) spells the ids.

Weights follow the model's kind. In a unigram model a piece costs its negative
score. A BPE model has no such weights: its result is the one path on which
no two neighbours would have been merged differently, so a pair of neighbours costs
nothing if byte-pair merging of their common string stops at just these two pieces,
and infinitely much otherwise. Exactly one path, the model's own result, has a finite weight.

No piece spans a pair of characters that stands in no piece. Texts are cut there, and
the path of each distinct cut is remembered. The words of a batch that are new are composed all together, place by
place (``Lattice``): numpy looks up which substrings are pieces and which pairs have a finite weight.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from siltstone.llm.byte_bpe import picked, sums_between
from siltstone.llm.common import whole_text

MARK = "▁"
#: What a worker remembers in each of its memories (of whole words, in each of two generations), and the longest entry (in characters).
CACHE_ENTRIES = 150_000
CACHE_CHARS = 48
#: Characters of text that are encoded together, and words that are composed together.
BATCH_CHARS = 6_000_000
LATTICE_WORDS = 20_000
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _BYTE = 1, 2, 3, 4, 6
_UNIGRAM, _BPE = 1, 2


class Lattice:
    """Least paths through many words at once, for a grammar whose weights are 0 or infinite.

    Exactly one path leads to each place of a word that can be reached, so the first arc found is the path's.
    Substrings are looked up by 64-bit hashes among the pieces of their length. A character in no piece is an
    arc of its own, which any arc may follow, and spells its bytes.
    """

    _ALONE = 1 << 22  # arcs of characters in no piece: their code points from here on

    _BASE = np.uint64(0x9E3779B97F4A7C15)
    _SLOT_BITS = 21

    def __init__(self, owner: Transducer):
        self.owner = owner
        hashes, lengths = self._hashes(list(owner.usable))
        names, ids = hashes[np.arange(len(lengths)), lengths], np.fromiter(owner.usable.values(), np.int64, len(lengths))
        self.pieces: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            own = own[np.argsort(names[own])]
            self.pieces[length] = names[own], ids[own]
        # Weights of pairs: a slot remembers the last pair that fell into it.
        self.keys = np.full(1 << self._SLOT_BITS, -1, dtype=np.int64)
        self.finite = np.zeros(1 << self._SLOT_BITS, dtype=bool)

    def _hashes(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all prefixes of the words, and the words' lengths."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        longest = int(lengths.max(initial=0))
        table = np.zeros((len(words), longest), dtype=np.uint64)
        table[np.arange(longest) < lengths[:, None]] = codes + np.uint64(1)
        hashes = np.zeros((len(words), longest + 1), dtype=np.uint64)
        for i in range(longest):
            hashes[:, i + 1] = hashes[:, i] * self._BASE + table[:, i]
        return hashes, lengths

    def _allowed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        free = np.maximum(left, right) >= self._ALONE
        if free.any():
            out = free.copy()
            out[~free] = self._allowed(left[~free], right[~free])
            return out
        keys = left << 32 | right
        slots = (keys.astype(np.uint64) * self._BASE >> np.uint64(64 - self._SLOT_BITS)).astype(np.int64)
        known = self.keys[slots] == keys
        out = self.finite[slots]
        if not known.all():
            new, where = np.unique(keys[~known], return_inverse=True)
            weights = np.array([self.owner._pair_weight(k >> 32, k & 0xFFFFFFFF) == 0 for k in new.tolist()])
            out[~known] = weights[where]
            self.keys[slots[~known]] = keys[~known]
            self.finite[slots[~known]] = weights[where]
        return out

    def paths(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words one after the other, and how many each has."""
        hashes, lengths = self._hashes(words)
        longest = hashes.shape[1] - 1
        last = np.full((len(words), longest + 1), -1, dtype=np.int64)
        start = np.zeros((len(words), longest + 1), dtype=np.int16)
        power = np.multiply.accumulate(np.append(np.uint64(1), np.full(longest, self._BASE)))
        for end in range(1, longest + 1):
            here = lengths >= end
            for length in range(min(end, self.owner.longest), 0, -1):
                if length not in self.pieces:
                    continue
                begin = end - length
                rows = np.flatnonzero(here & (last[:, begin] >= 0)) if begin else np.flatnonzero(here)
                if not len(rows):
                    continue
                names, ids = self.pieces[length]
                found = hashes[rows, end] - hashes[rows, begin] * power[length]
                at = np.minimum(np.searchsorted(names, found), len(names) - 1)
                hit = names[at] == found
                if length == 1:
                    # The hash of one character is its code point plus one.
                    piece = np.where(hit, ids[at], self._ALONE + found.astype(np.int64) - 1)
                else:
                    rows, piece = rows[hit], ids[at[hit]]
                if begin and len(rows):
                    fits = self._allowed(last[rows, begin], piece)
                    rows, piece = rows[fits], piece[fits]
                last[rows, end], start[rows, end] = piece, begin
                here[rows] = False
        # Back from the ends, one arc of every word at a time.
        out = np.full((len(words), longest), -1, dtype=np.int64)
        place = np.where(last[np.arange(len(words)), lengths] >= 0, lengths, 0)
        column = longest
        while place.any():
            column -= 1
            rows = np.flatnonzero(place)
            out[rows, column] = last[rows, place[rows]]
            place[rows] = start[rows, place[rows]]
        return self._spelled(out[out >= 0], (out >= 0).sum(axis=1))

    def _spelled(self, arcs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arcs of words with characters in no piece spelled out."""
        alone = np.unique(arcs[arcs >= self._ALONE])
        if not len(alone):
            return arcs.astype("<i4"), sizes
        spelled = [self.owner._fallback(chr(c - self._ALONE)) for c in alone.tolist()]
        own = np.ones(len(arcs), dtype=np.int64)
        for arc, ids in zip(alone, spelled):
            own[arcs == arc] = len(ids)
        word = np.repeat(np.arange(len(sizes)), sizes)
        out = np.repeat(arcs, own)
        for arc, ids in zip(alone, spelled):
            places = np.flatnonzero(out == arc)
            out[places] = np.tile(ids, len(places) // len(ids))
        return out.astype("<i4"), np.bincount(word, weights=own, minlength=len(sizes)).astype(np.int64)


class Transducer:
    _open: dict[str, Transducer] = {}

    @classmethod
    def at(cls, path: str) -> Transducer:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, kind = proto.normalizer_spec, proto.trainer_spec.model_type
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models whose normaliser leaves characters and white space alone")
        if kind not in (_UNIGRAM, _BPE):
            raise ValueError("neither a unigram nor a BPE model")
        self.bpe = kind == _BPE
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.ids: dict[str, int] = {}
        self.scores = [p.score for p in proto.pieces]
        self.bytes_of = [b""] * len(proto.pieces)
        self.byte_ids: dict[int, int] = {}
        self.unknown = 0
        for i, piece in enumerate(proto.pieces):
            if piece.type == _BYTE:
                value = int(piece.piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif piece.type in (_NORMAL, _USER_DEFINED):
                self.ids[piece.piece] = i
                self.bytes_of[i] = piece.piece.replace(MARK, " ").encode()
            elif piece.type == _UNKNOWN:
                self.unknown = i
                self.bytes_of[i] = " ⁇ ".encode()
        if len(self.byte_ids) not in (0, 256):
            raise ValueError("byte fallback needs all 256 bytes")
        self.longest = max(map(len, self.ids))
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.starts_words = all(MARK not in p.lstrip(MARK) for p in self.ids)
        self.pairs: dict[int, float] = {}
        self.atoms: dict[str, bytes] = {}  # cut -> ids
        self.words: dict[str, bytes] = {}  # the same for cuts that follow a word mark, without it
        self.usable = self.ids
        if self.bpe:
            self._compile_merges()
            self.usable = {p: i for p, i in self.ids.items() if i in self.split}
        self.lattice = Lattice(self) if self.bpe else None
        self.known: dict[str, bytes] = {}  # words that follow a blank -> ids
        self.older: dict[str, bytes] = {}  # the generation before; what is met again moves to the new one

    # The grammar of a BPE model.

    def _compile_merges(self) -> None:
        """How each piece is put together, and which pieces merging can reach at all."""
        self.split: dict[int, tuple[int, int]] = {}
        for piece, i in self.ids.items():
            merged = self._merge(piece)
            if merged is not None:
                self.split[i] = merged

    def _merge(self, piece: str) -> tuple[int, int] | None:
        """The last merge that yields ``piece``; itself twice for a character, None if it is not reached."""
        own = self.ids[piece]
        if len(piece) == 1:
            return own, own
        symbols: list[str | None] = list(piece)
        if any(c not in self.ids for c in symbols):
            return None
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        queue: list[tuple[float, int, str, int]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] >= 0:
                both = symbols[left] + symbols[after[left]]
                if both in self.ids:
                    heapq.heappush(queue, (-self.scores[self.ids[both]], left, both, after[left]))

        for i in range(len(symbols)):
            offer(i)
        last = None
        while queue:
            _, left, both, right = heapq.heappop(queue)
            if symbols[left] is None or symbols[right] is None or symbols[left] + symbols[right] != both or after[left] != right:
                continue
            last = (self.ids[symbols[left]], self.ids[symbols[right]])
            symbols[left], symbols[right] = both, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(left)
            offer(before[left])
        return last if symbols[0] == piece else None

    def _pair_weight(self, left: int, right: int) -> float:
        """0 if merging the string of both pieces ends with these two, else infinity.

        The pieces are taken apart from the seam outwards, the later merge first: the
        seam is crossed if parts that met there had a merge that came before the ones undone so far.
        """
        scores, split, ids, pieces = self.scores, self.split, self.ids, self.names
        limit = (math.inf, 0)
        a, b = left, right
        while True:
            both = ids.get(pieces[a] + pieces[b])
            if both is not None and (-scores[both], 1) < limit:
                return math.inf
            whole_a, whole_b = split[a] == (a, a), split[b] == (b, b)
            if whole_a and whole_b:
                return 0.0
            # Equal scores: the left merge came first, so the right one is undone first.
            if whole_a or (not whole_b and scores[b] <= scores[a]):
                limit = (-scores[b], 2)
                b = split[b][0]
            else:
                limit = (-scores[a], 0)
                a = split[a][1]

    @property
    def names(self) -> list[str]:
        found = self.__dict__.get("_names")
        if found is None:
            found = [""] * len(self.scores)
            for piece, i in self.ids.items():
                found[i] = piece
            self._names = found
        return found

    def _weight(self, left: int, piece: int) -> float:
        found = self._pair_weight(left, piece)
        if len(self.pairs) < CACHE_ENTRIES:
            self.pairs[left << 32 | piece] = found
        return found

    # Paths.

    def _path(self, atom: str) -> list[int]:
        """Ids of the least path through ``atom``; every character of it is in some piece."""
        n, piece_at, longest, bpe = len(atom), self.usable.get, self.longest, self.bpe
        if bpe and n > 1:
            whole = piece_at(atom)
            if whole is not None:  # merging reaches it, so it stops there
                return [whole]
        weight_of, infinite = self.pairs.get, math.inf
        cost = [0.0] + [infinite] * n
        last = [-1] * (n + 1)
        start = [0] * (n + 1)
        for end in range(1, n + 1):
            for begin in range(end - longest if end > longest else 0, end):
                piece = piece_at(atom[begin:end])
                if piece is None or cost[begin] == infinite:
                    continue
                if not bpe:
                    weight = -self.scores[piece]
                elif begin:
                    weight = weight_of(last[begin] << 32 | piece)
                    if weight is None:
                        weight = self._weight(last[begin], piece)
                else:
                    weight = 0.0
                if cost[begin] + weight < cost[end]:
                    cost[end], last[end], start[end] = cost[begin] + weight, piece, begin
                    if bpe:
                        break  # nothing is less than 0, and no other path is finite
        found = []
        while n:
            found.append(last[n])
            n = start[n]
        return found[::-1]

    def _fallback(self, char: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in char.encode("utf-8", "replace")]

    def _atom(self, atom: str) -> bytes:
        """Ids of a cut; its first character may be a word mark."""
        word = atom[0] == MARK and len(atom) > 1 and atom[1] != MARK
        cache, key = (self.words, atom[1:]) if word else (self.atoms, atom)
        found = cache.get(key)
        if found is None:
            ids = self._path(atom) if len(atom) > 1 or atom in self.ids else self._fallback(atom)
            found = np.array(ids, dtype="<i4").tobytes()
            if len(key) <= CACHE_CHARS and len(cache) < CACHE_ENTRIES:
                cache[key] = found
        return found

    def _word(self, word: str) -> bytes:
        """Ids of normalised characters up to the next word mark."""
        joined = self.joined
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in joined]
        return b"".join([self._atom(word[a:b]) for a, b in zip([0, *cuts], [*cuts, len(word)])])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers; an empty text has none."""
        if not text:
            return b""
        if MARK in text:
            text = text.replace(MARK, " ")
        if not self.prefix or not self.starts_words:
            return self._word(self.prefix + text.replace(" ", MARK))
        if "  " in text or text[0] == " " or text[-1] == " ":
            words = re.findall(" +[^ ]*", " " + text)
            return b"".join([self._word(w.replace(" ", MARK)) for w in words])
        words = text.split(" ")
        parts = list(map(self.words.get, words))
        if None in parts:
            for i, part in enumerate(parts):
                if part is None:
                    word = words[i]
                    # Most often only a mark at the end keeps a known word from being found.
                    stem = self.words.get(word[:-1]) if word[-2:] not in self.joined else None
                    parts[i] = self._word(MARK + word) if stem is None else stem + self._atom(word[-1])
        return b"".join(parts)

    def encode_all(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as ``encode`` gives them, of many texts together."""
        if self.lattice is None or not self.prefix or not self.starts_words:
            return [self.encode(t) for t in texts]
        out: list[bytes] = [b""] * len(texts)
        plain: list[int] = []
        chars = 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
                out[i] = self.encode(text)
                continue
            plain.append(i)
            chars += len(text)
            if chars >= BATCH_CHARS:
                self._fill(texts, plain, out)
                plain, chars = [], 0
        self._fill(texts, plain, out)
        return out

    def _fill(self, texts: Sequence[str], rows: list[int], out: list[bytes]) -> None:
        """Ids of texts whose words are parted by single blanks, from those of their distinct words."""
        if not rows:
            return
        split = pc.split_pattern(pa.array([texts[i] for i in rows], pa.large_string()), " ")
        coded = split.values.dictionary_encode()
        found = self._ids_of(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, own = picked(np.frombuffer(b"".join(found), "<i4"), sizes, coded.indices.to_numpy())
        raw, ends = ids.tobytes(), np.cumsum(4 * sums_between(own, split.offsets.to_numpy())).tolist()
        for i, a, b in zip(rows, [0, *ends], ends):
            out[i] = raw[a:b]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words that follow a blank; the new ones are composed together."""
        if len(self.known) > CACHE_ENTRIES:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, words))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in gaps:
            found[i] = self.older.get(words[i])
            if found[i] is None:
                if len(words[i]) <= CACHE_CHARS:
                    new.append(i)
                else:
                    found[i] = self._word(MARK + words[i])
        # Words of like lengths together, so places at the end of long ones are not looked at for all.
        new.sort(key=lambda i: len(words[i]))
        for first in range(0, len(new), LATTICE_WORDS):
            own = new[first : first + LATTICE_WORDS]
            ids, sizes = self.lattice.paths([MARK + words[i] for i in own])
            raw, ends = ids.tobytes(), np.cumsum(4 * sizes).tolist()
            for i, a, b in zip(own, [0, *ends], ends):
                found[i] = raw[a:b]
        self.known.update((words[i], found[i]) for i in gaps if len(words[i]) <= CACHE_CHARS)
        return found

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ``ids``, without the blank that encoding puts in front; broken bytes are replaced."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids, and whether the decoded ids give the text back.

    Whole texts are encoded, a few megabytes at a time; no rows are shuffled. NULL and empty texts have no ids. A word mark in a text counts as a
    blank, and is compared as one. Rows that repeat are returned as often as they come; no rows give none; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer.at(model)
        for whole in batches:
            for first in range(0, whole.num_rows, 2500):
                batch = whole.slice(first, 2500)
                texts, same = batch.column(1).to_pylist(), []
                raw = transducer.encode_all(texts)
                for text, found in zip(texts, raw):
                    ids = np.frombuffer(found, "<i4").tolist()
                    same.append(transducer.decode(ids) == text.replace(MARK, " "))
                ends = np.cumsum([0, *(len(r) // 4 for r in raw)])
                values = pa.array(np.frombuffer(b"".join(raw), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                        pa.array(same, pa.bool_()),
                    ],
                    ["doc_id", "n_tokens", "ids", "round_trip"],
                )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")
