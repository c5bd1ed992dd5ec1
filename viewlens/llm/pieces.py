"""Encoding with a merge-type SentencePiece model, many parts at once, and decoding.

No vocabulary entry has a blank after another character, and characters outside
the vocabulary join nothing, so texts are cut before blanks and around line ends,
and equal parts are encoded once. The new parts of some texts are merged together:
parts of as many symbols are the rows of one array, and in each round every row
does its best merge, so that it has one symbol less, or is done.

Parts that are too long for rounds are encoded by a table of prefixes. A boundary between two tokens of an encoding is one that no merge crossed, so
both sides were merged as if alone. Hence every prefix of a text that ends at
such a boundary is encoded by the tokens before it, every prefix has exactly one
last token, and a sequence of tokens is an encoding if each neighbouring pair is.
The table of a text holds the last token of each prefix: of the vocabulary
entries that end there, found by an automaton, the one that is compatible with
the last token of the prefix before it. The ids are read off backwards. Work and
memory grow with the length of a text.
"""

from __future__ import annotations

import hashlib
import re
import weakref
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from itertools import chain

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from .batches import add_columns

BLANK = "▁"
#: Stands for the token before the first.
START = -1
NEVER = float("-inf")
#: Entries of each of the two generations of remembered parts and pairs.
REMEMBERED = 200_000
#: Characters of a part that is merged in rounds and remembered; longer ones are
#: encoded by their table, each time.
REMEMBERED_LENGTH = 64
#: Characters of the texts whose parts are encoded together; one text may have more.
TOGETHER = 1_000_000
NORMAL, BYTE = 1, 6
#: Rank of a pair that does not merge.
NO_MERGE = np.int32(2**31 - 1)


class Remembered(dict):
    """A bounded map: when it is full, entries not asked for since are forgotten."""

    def __init__(self, make: Callable, limit: int = REMEMBERED):
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class RememberedParts(Remembered):
    """Parts up to a length, of which new ones can be made together."""

    def __init__(self, make: Callable, make_all: Callable, limit: int = REMEMBERED):
        super().__init__(make, limit)
        self.make_all = make_all

    def __missing__(self, part):
        return super().__missing__(part) if len(part) <= REMEMBERED_LENGTH else self.make(part)

    def prepare(self, parts: Iterable[str]):
        """Make those of ``parts``, which are distinct, that are not remembered."""
        lacking = [p for p in parts if p not in self and len(p) <= REMEMBERED_LENGTH]
        found = {p: self.older[p] for p in lacking if p in self.older}
        new = [p for p in lacking if p not in found]
        found.update(zip(new, self.make_all(new), strict=True))
        if len(self) + len(found) > self.limit:
            self.older = dict(self)
            self.clear()
        self.update(found)


class Merges:
    """The pairs of vocabulary entries that merge: a hash table with linear probing."""

    def __init__(self, ids: dict[str, int], score: Callable[[str], float]):
        found = [
            (left, right, whole, score(piece))
            for piece, whole in ids.items()
            for at in range(1, len(piece))
            if (left := ids.get(piece[:at])) is not None
            and (right := ids.get(piece[at:])) is not None
        ]
        left, right, whole = np.array([f[:3] for f in found], np.int64).reshape(-1, 3).T
        ranks = np.unique([-f[3] for f in found], return_inverse=True)[1]
        bits = max(4, (4 * len(found)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_MERGE, np.int32)
        self.wholes = np.full(1 << bits, -1, np.int32)
        keys = left << 32 | right
        slots, todo = self.first_slots(keys), np.arange(len(keys))
        while todo.size:
            free = todo[self.keys[slots[todo]] == -1]
            self.keys[slots[free]] = keys[free]  # of several, one gets the slot
            todo = todo[self.keys[slots[todo]] != keys[todo]]
            slots[todo] = slots[todo] + 1 & self.mask
        self.ranks[slots], self.wholes[slots] = ranks, whole

    def first_slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where ``ranks`` and ``wholes`` have the pairs; an empty slot for those that never merge."""
        keys = left.astype(np.int64) << 32 | right
        slots = self.first_slots(keys)
        held = self.keys[slots]
        todo = np.flatnonzero((held != keys) & (held != -1))
        while todo.size:
            slots[todo] = slots[todo] + 1 & self.mask
            held = self.keys[slots[todo]]
            todo = todo[(held != keys[todo]) & (held != -1)]
        return slots

    def apply(self, blocks: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple]:
        """Merge rows of symbols as far as they go: by best score, then from the left.

        ``blocks`` has, for a number of symbols, the numbers of its rows and an
        array of their symbols. Returns such pairs, of the rows that are done.
        """
        rows, symbols, ranks = np.empty(0, np.int64), None, None
        for size in range(max(blocks, default=0), 1, -1):
            if size in blocks:
                added, given = blocks[size]
                pairs = self.slots(given[:, :-1].ravel(), given[:, 1:].ravel())
                new = added, given, self.ranks[pairs].reshape(len(given), size - 1)
                if rows.size:
                    new = map(np.concatenate, zip((rows, symbols, ranks), new, strict=True))
                rows, symbols, ranks = new
            if not rows.size:
                continue
            at = ranks.argmin(axis=1)
            more = ranks[np.arange(len(rows)), at] != NO_MERGE
            yield rows[~more], symbols[~more]
            rows = rows[more]
            symbols, ranks = self.merge(symbols[more], ranks[more], at[more])
        if rows.size:
            yield rows, symbols
        if 1 in blocks:
            yield blocks[1]

    def merge(self, symbols: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> tuple:
        """The rows and ranks after the pair at ``at`` of each row became one symbol."""
        count, size = symbols.shape
        row = np.arange(count)
        flat, place = symbols.ravel(), row * size + at
        whole = self.wholes[self.slots(flat[place], flat[place + 1])]
        kept = np.ones(flat.size, bool)
        kept[place + 1] = False
        flat = flat[kept]
        place -= row  # of the first symbol in rows shorter by one, and of the pair
        flat[place] = whole
        kept = np.ones(ranks.size, bool)
        kept[place] = False
        ranks = ranks.ravel()[kept]
        for touched, step in ((np.flatnonzero(at > 0), -1), (np.flatnonzero(at < size - 2), 0)):
            first = place[touched] + step
            ranks[first - touched] = self.ranks[self.slots(flat[first], flat[first + 1])]
        return flat.reshape(count, size - 1), ranks.reshape(count, size - 2)


class Pieces:
    """The vocabulary of a model file, and encoding and decoding with it."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        kinds = {p.type for p in proto.pieces}
        if (
            proto.trainer_spec.model_type != 2
            or not proto.trainer_spec.byte_fallback
            or proto.normalizer_spec.precompiled_charsmap
            or proto.normalizer_spec.remove_extra_whitespaces
            or not proto.normalizer_spec.add_dummy_prefix
            or proto.trainer_spec.treat_whitespace_as_suffix
            or 4 in kinds
            or 5 in kinds
        ):
            raise ValueError("only merge-type models with byte fallback and plain text are supported")
        self.texts = [p.piece for p in proto.pieces]
        self.shown = [t.replace(BLANK, " ") for t in self.texts]
        self.sizes = [len(t) for t in self.texts]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}.get
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes = {
            int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE
        }
        self.byte_values = {i: b for b, i in self.bytes.items()}
        self.characters = characters = {c for piece in self.ids for c in piece}
        if not all(c in self.ids for c in characters):
            raise ValueError("a vocabulary entry has a character that is no entry")
        inner = any(BLANK in piece.lstrip(BLANK) for piece in self.ids)
        lines = "\n" not in characters
        parts = r" *[^ \n]+| +|\n" if lines else " +[^ ]*"
        self.cut = re.compile("(?s:.+)" if inner else parts).findall
        # No cycle: what a task remembers is freed at its end, not when Python looks for cycles.
        me = weakref.proxy(self)
        self.compatible = Remembered(lambda pair: me.are_compatible(pair))
        self.encoded = RememberedParts(
            lambda part: me.encode_part(part), lambda parts: me.encode_parts(parts)
        )
        self.merges = Merges(self.ids, self.score)
        self.numbers = np.array([str(i) for i in range(len(self.texts))], object)
        self.shown_texts = np.array(self.shown, object)
        # Symbol of each code point; one outside the vocabulary follows all entries.
        self.symbols = np.arange(len(self.texts), len(self.texts) + 0x110000, dtype=np.int32)
        self.symbols[[ord(c) for c in characters]] = [self.ids[c] for c in characters]
        self.symbols[ord(" ")] = self.symbols[ord(BLANK)]

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds the vocabulary entries that end at each character."""
        automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            automaton.add_word(piece, (i, len(piece)))
        automaton.make_automaton()
        return automaton

    def are_compatible(self, pair: int) -> bool:
        """Whether the texts of two tokens, merged together, give just these tokens.

        The pair is (first + 1) << 32 | second. Merges go by best score, then from
        the left; the answer is no as soon as one crosses the border.
        """
        first, second = (pair >> 32) - 1, pair & 0xFFFFFFFF
        left = self.texts[first] if first != START else ""
        parts = [*left, *self.texts[second]]
        border = len(left)  # number of parts of the first token
        score, never = self.score, NEVER
        merges = [score(parts[i] + parts[i + 1], never) for i in range(len(parts) - 1)]
        while merges and (best := max(merges)) != never:
            at = merges.index(best)
            if at == border - 1:
                return False
            if at < border:
                border -= 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del merges[at]
            if at:
                merges[at - 1] = score(parts[at - 1] + parts[at], never)
            if at < len(merges):
                merges[at] = score(parts[at] + parts[at + 1], never)
        return len(parts) == (1 if first == START else 2)

    def last_tokens(self, part: str) -> list[int]:
        """For each prefix of ``part``, all of known characters, its last token."""
        last = [None] * len(part)
        compatible = self.compatible
        for end, (token, size) in self.automaton.iter(part):
            if last[end] is None:
                before = end - size
                previous = START if before < 0 else last[before]
                if compatible[(previous + 1) << 32 | token]:
                    last[end] = token
        return last

    def encode_run(self, run: str) -> list[int]:
        """Ids of a text of known characters, read backwards from its table."""
        last, end, ids = self.last_tokens(run), len(run), []
        while end:
            token = last[end - 1]
            ids.append(token)
            end -= self.sizes[token]
        ids.reverse()
        return ids

    def encode_part(self, part: str) -> tuple[str, str]:
        """Ids, comma-separated, and decoded text of a part whose borders no merge crosses."""
        given, part = part, part.replace(" ", BLANK)
        if self.characters.issuperset(part):
            ids = self.encode_run(part)
        else:
            ids, known = [], 0
            for at, character in enumerate(part):
                if character not in self.characters:
                    ids += self.encode_run(part[known:at])
                    ids += (self.bytes[b] for b in character.encode())
                    known = at + 1
            ids += self.encode_run(part[known:])
        back = self.decode_part(ids)
        # One string for both where they are equal, as both are remembered.
        return ",".join(map(str, ids)), given if back == given else back

    def encode_parts(self, parts: list[str]) -> list[tuple[str, str]]:
        """As ``encode_part`` for each of ``parts``, which are merged together."""
        sizes = np.array([len(p) for p in parts], np.int64)
        order = np.argsort(sizes, kind="stable")
        points = "".join([parts[i] for i in order.tolist()]).encode("utf-32-le")
        symbols = self.symbols[np.frombuffer(points, np.uint32)]
        blocks, at, start = {}, 0, 0
        for size, count in zip(*np.unique(sizes, return_counts=True), strict=True):
            given = symbols[start : start + size * count].reshape(count, size)
            blocks[int(size)] = order[at : at + count], given
            at, start = at + count, start + size * count
        out = [None] * len(parts)
        for rows, done in self.merges.apply(blocks):
            known = (done < len(self.texts)).all(axis=1)
            numbers, shown = self.numbers[done[known]].tolist(), self.shown_texts[done[known]].tolist()
            for row, n, t in zip(rows[known].tolist(), numbers, shown, strict=True):
                given, back = parts[row], "".join(t)
                # One string for both where they are equal, as both are remembered.
                out[row] = ",".join(n), given if back == given else back
            for row, found in zip(rows[~known].tolist(), done[~known].tolist(), strict=True):
                ids = self.as_bytes(found)
                out[row] = ",".join(map(str, ids)), self.decode_part(ids)
        return out

    def as_bytes(self, symbols: list[int]) -> list[int]:
        """Ids of symbols; those outside the vocabulary become tokens of their bytes."""
        end, ids = len(self.texts), []
        for symbol in symbols:
            if symbol < end:
                ids.append(symbol)
            else:
                ids += [self.bytes[b] for b in chr(symbol - end).encode()]
        return ids

    def decode_part(self, ids: list[int]) -> str:
        """Text of the ids of one part; its byte tokens are whole characters."""
        if self.byte_values.keys().isdisjoint(ids):
            return "".join([self.shown[i] for i in ids])
        out = bytearray()
        for i in ids:
            out += bytes((self.byte_values[i],)) if i in self.byte_values else self.shown[i].encode()
        return out.decode("utf-8", "replace")

    def round_trips(self, texts: Iterable[str | None]) -> Iterator[tuple[str, str]]:
        """Ids, comma-separated, and the text decoded from them, of each text; null is empty."""
        together, size = [], 0
        for text in texts:
            together.append(text)
            size += len(text or "")
            if size >= TOGETHER:
                yield from self.trips_together(together)
                together, size = [], 0
        yield from self.trips_together(together)

    def trips_together(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        cut, encoded = self.cut, self.encoded
        cuts = [cut(" " + t.replace(BLANK, " ")) if t else () for t in texts]
        encoded.prepare(set(chain.from_iterable(cuts)))
        for parts in cuts:
            done = [encoded[p] for p in parts]
            # The blank put before the text is taken away again.
            yield ",".join([d[0] for d in done]), "".join([d[1] for d in done])[1:]

    def round_trip(self, text: str | None) -> tuple[str, str]:
        return next(self.round_trips([text]))

    def encode(self, text: str | None) -> list[int]:
        ids = self.round_trip(text)[0]
        return [int(i) for i in ids.split(",")] if ids else []

    def decode(self, ids: list[int]) -> str:
        return self.decode_part(ids)[1:] if ids else ""


def tokenize(
    docs: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] | None = None
) -> DataFrame:
    """Columns ``keep`` and the ids and decoded text of every row.

    Added: piece_ids (array<int>), piece_text (string). A null or empty text has
    no ids and an empty text. Each row is done for itself, without a shuffle.
    ``model`` is the content of a model file, which travels with the task.
    """

    def factory():
        pieces = Pieces(model)

        def run(texts):
            done = list(pieces.round_trips(texts))
            return [[int(i) for i in d[0].split(",")] if d[0] else [] for d in done], [
                d[1] for d in done
            ]

        return run

    return add_columns(docs, text, "piece_ids array<int>, piece_text string", factory, keep)


def tokens_and_digests(
    docs: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] | None = None
) -> DataFrame:
    """As ``tokenize``, but piece_ids, n_tokens and decoded_sha256 of every row."""

    def factory():
        pieces = Pieces(model)

        def run(texts):
            ids, counts, decoded = [], [], []
            for numbers, back in pieces.round_trips(texts):
                ids.append(np.array(numbers.split(","), np.int32) if numbers else [])
                counts.append(len(ids[-1]))
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
            return ids, counts, decoded

        return run

    added = "piece_ids array<int>, n_tokens long, decoded_sha256 string"
    return add_columns(docs, text, added, factory, keep)


def token_digests(
    docs: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] | None = None
) -> DataFrame:
    """As ``tokenize``, but n_tokens, ids_sha256 and decoded_sha256 of every row.

    The first digest is of the decimal ids joined by commas, the second of the
    decoded text in UTF-8, both in lower-case hex.
    """

    def factory():
        pieces = Pieces(model)

        def run(texts):
            counts, ids, decoded = [], [], []
            for numbers, back in pieces.round_trips(texts):
                counts.append(numbers.count(",") + 1 if numbers else 0)
                ids.append(hashlib.sha256(numbers.encode()).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
            return counts, ids, decoded

        return run

    added = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return add_columns(docs, text, added, factory, keep)
