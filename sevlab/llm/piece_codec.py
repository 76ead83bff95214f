"""Text to sentence pieces and back: byte-pair merges in vectorised rounds.

A model file is read once on the driver (pieces, scores, kinds); its bytes, under ``MODEL_BYTES``, go to
the tasks, which build their tables from them. Only models of byte-pair kind with byte fallback, a dummy
prefix and no other normal form are taken; others raise ``ValueError``.

Encoding: a space becomes the space sign, a text begins with one. Words (space signs, then other
characters) are encoded once each for a task's known words. All unknown words of a slice lie in one flat
array of symbols. A round looks up the rank of every neighbouring pair, takes the least rank of each
segment, merges that pair's occurrences leftmost first and without overlap, and compacts the array;
segments without a pair leave it. A segment is a stretch in which every two neighbouring characters stand
side by side in some piece: no merge can cross its ends.

All occurrences may be merged at once only where no pair made by the merge can have the same or a better
rank. Ranks of which the vocabulary cannot say so merge one occurrence a segment and round, the leftmost.
A segment of more than ``LONG_SEGMENT`` characters (thousands of letters or spaces without an end) would need
a round for nearly every rank; the same merges are made there one by one from a heap.

Characters outside the vocabulary are written as the bytes of their UTF-8 form. Decoding joins pieces and
bytes, drops the space of the dummy prefix, and reads each byte that is no UTF-8 as U+FFFD.

Defined results: null and empty texts have no ids and decode to the empty text; bytes of a text that are
no UTF-8 are read as U+FFFD; null ids decode to the empty text; repeated rows stay; empty tables give
empty tables. Other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from sevlab.llm.common import free_name

SPACE = "▁"
MODEL_BYTES = 64 << 20
#: Characters of text encoded at a time; words, and characters in them, that a task remembers.
SLICE_CHARS = 1 << 19
KNOWN_WORDS = 250_000
KNOWN_CHARS = 4 << 20
LONG_SEGMENT = 1024
#: Kinds of pieces in a model file, and the model kind for byte pairs.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BYTE_PAIR = 2
_NONE = np.int32(np.iinfo(np.int32).max)


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    at = 0

    def number() -> int:
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
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = number() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, message[at:at + size]
            at += size


class Model:
    """Tables of one model file."""

    def __init__(self, content: bytes):
        self.pieces: list[str] = []
        scores, self.kinds = [], []
        spec = {"kind": 1, "fallback": 0, "suffix": 0, "unknown": b" \xe2\x81\x87 ", "charsmap": b"", "prefix": 1, "squeeze": 1, "escape": 1}
        for field, value in _fields(content):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                spec |= {{3: "kind", 35: "fallback", 24: "suffix", 44: "unknown"}[k]: v for k, v in _fields(value) if k in (3, 24, 35, 44)}
            elif field == 3:
                spec |= {{2: "charsmap", 3: "prefix", 4: "squeeze", 5: "escape"}[k]: v for k, v in _fields(value) if k in (2, 3, 4, 5)}
        wanted = {"kind": BYTE_PAIR, "fallback": 1, "suffix": 0, "charsmap": b"", "prefix": 1, "squeeze": 0, "escape": 1}
        if {k: spec[k] for k in wanted} != wanted or USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("only byte-pair models with byte fallback, a dummy prefix and no normal form are supported")
        self.unknown = spec["unknown"]
        self._tables(np.array(scores))
        self._decoding()

    def _tables(self, scores: np.ndarray) -> None:
        normal = [i for i, kind in enumerate(self.kinds) if kind == NORMAL]
        number = {self.pieces[i]: i for i in reversed(normal)}
        singles = {c for p in number for c in p}
        for c in sorted(singles - set(number)):  # symbols that pairs are made of, but no pieces
            number[c] = len(self.pieces) + len(number)
        rank_of = np.zeros(len(scores), np.int32)
        rank_of[normal] = np.unique(-scores[normal], return_inverse=True)[1]
        self.n_symbols = max(number.values(), default=0) + 1
        self.symbol = np.full(0x110000, -1, np.int32)
        for c in singles:
            self.symbol[ord(c)] = number[c]
        self.byte_id = np.zeros(256, np.int32)
        for i, kind in enumerate(self.kinds):
            if kind == BYTE:
                self.byte_id[int(self.pieces[i][3:5], 16)] = i
        keys, made, beside, self.single = [], [], set(), np.zeros(int(rank_of.max(initial=0)) + 1, bool)
        for i in normal:
            piece = self.pieces[i]
            beside.update(zip(piece, piece[1:]))
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.n_symbols + right)
                    made.append(i)
                for part, other in ((left, right), (right, left)):
                    # a part that ranks no better than the whole: its merges may make a pair to be merged first
                    if part is not None and part < len(scores) and other is not None and rank_of[i] <= rank_of[part]:
                        self.single[rank_of[part]] = True
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair_keys = np.array(keys, np.int64)[order]
        self.pair_made = np.array(made, np.int32)[order]
        self.pair_rank = rank_of[self.pair_made]
        self.beside = np.sort(np.array([(ord(a) << 21) | ord(b) for a, b in beside], np.int64))
        alone = "".join(c for c in "\n\r\t" if c not in singles)
        inner = any(SPACE in p.lstrip(SPACE) for p in number)
        self.words = re.compile(".+" if inner else f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S)

    def _decoding(self) -> None:
        self.surface = []
        for piece, kind in zip(self.pieces, self.kinds):
            self.surface.append(b"" if kind == CONTROL else self.unknown if kind == UNKNOWN else bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(SPACE, " ").encode())

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of ids of each word)."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        cut = np.ones(len(codes), bool)
        pair = (codes[:-1] << 21) | codes[1:]
        cut[1:] = ~_found(self.beside, pair)[1]
        cut[1:] |= word[1:] != word[:-1]
        out = np.full(len(codes), -2, np.int32)
        symbols, at, segment = self.symbol[codes], np.arange(len(codes)), np.cumsum(cut) - 1
        bounds = np.append(np.flatnonzero(cut), len(codes))
        long = np.flatnonzero(np.diff(bounds) > LONG_SEGMENT)
        for k in long.tolist():
            self._long(symbols[bounds[k]:bounds[k + 1]], out[bounds[k]:bounds[k + 1]])
        if len(long):
            short = ~np.isin(segment, long)
            symbols, at, segment = symbols[short], at[short], segment[short]
        while len(symbols):
            symbols, at, segment = self._round(symbols, at, segment, out)
        kept = np.flatnonzero(out != -2)
        ids, counts = out[kept], np.ones(len(kept), np.int64)
        strange = np.flatnonzero((ids < 0) | (ids >= len(self.pieces)))
        if len(strange):
            as_bytes = [chr(c).encode() for c in codes[kept[strange]].tolist()]
            counts[strange] = [len(b) for b in as_bytes]
            starts = np.cumsum(counts) - counts
            ids = np.repeat(ids, counts)
            places = np.repeat(starts[strange], counts[strange]) + np.concatenate([np.arange(len(b)) for b in as_bytes])
            ids[places] = self.byte_id[np.frombuffer(b"".join(as_bytes), np.uint8)]
        return ids, np.bincount(word[kept], weights=counts, minlength=len(words)).astype(np.int64)

    def _round(self, symbols: np.ndarray, at: np.ndarray, segment: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One round: the symbols that are left, with finished segments written to ``out``."""
        rank, made = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int32)
        possible = np.flatnonzero((segment[1:] == segment[:-1]) & (symbols[1:] >= 0) & (symbols[:-1] >= 0))
        place, hit = _found(self.pair_keys, symbols[possible].astype(np.int64) * self.n_symbols + symbols[possible + 1])
        rank[possible[hit]], made[possible[hit]] = self.pair_rank[place[hit]], self.pair_made[place[hit]]
        starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        sizes = np.diff(np.append(starts, len(segment)))
        least = np.minimum.reduceat(rank, starts)
        best = np.repeat(least, sizes)
        live = best != _NONE
        out[at[~live]] = symbols[~live]
        least_here = live & (rank == best)
        position = np.arange(len(symbols))
        before = np.concatenate([[False], least_here[:-1]])
        # every second occurrence of a run of overlapping ones
        offset = position - np.maximum.accumulate(np.where(least_here & ~before, position, 0))
        chosen = least_here & (offset % 2 == 0)
        one = live & self.single[np.where(live, best, 0)]
        if one.any():
            first = np.minimum.reduceat(np.where(least_here, position, len(position)), starts)
            chosen &= ~one | (position == np.repeat(first, sizes))
        symbols = np.where(chosen, made, symbols)
        stays = live & ~np.concatenate([[False], chosen[:-1]])
        return symbols[stays], at[stays], segment[stays]

    def _long(self, symbols: np.ndarray, out: np.ndarray) -> None:
        """The same merges for one very long segment, in their order, from a heap."""
        symbol, n = symbols.tolist(), len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))

        def pairs(places: np.ndarray | list[int]) -> list[tuple[int, int, int, int, int]]:
            a = np.array([symbol[i] for i in places], np.int64)
            b = np.array([symbol[right[i]] for i in places], np.int64)
            place, hit = _found(self.pair_keys, np.where((a < 0) | (b < 0), -1, a * self.n_symbols + b))
            return [(int(self.pair_rank[p]), i, symbol[i], symbol[right[i]], int(self.pair_made[p])) for i, p, h in zip(places, place, hit) if h]

        heap = pairs(range(n - 1))
        heapify(heap)
        while heap:
            _, i, a, b, made = heappop(heap)
            j = right[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue  # one of the two has been merged since
            symbol[i], symbol[j], right[i] = made, -2, right[j]
            if right[j] < n:
                left[right[j]] = i
            for new in pairs([x for x in (left[i], i) if x >= 0 and right[x] < n]):
                heappush(heap, new)
        out[:] = symbol

    def decode(self, ids: Sequence[int]) -> str:
        joined = b"".join(map(self.surface.__getitem__, ids))
        head = next((i for i in ids if self.kinds[i] != CONTROL), None)
        start = int(head is not None and self.kinds[head] == NORMAL and self.pieces[head].startswith(SPACE))
        try:
            return joined[start:].decode()
        except UnicodeDecodeError:
            return "".join(_lenient(joined[start:]))


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys`` and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def _lenient(data: bytes) -> Iterator[str]:
    while data:
        try:
            yield data.decode()
            return
        except UnicodeDecodeError as e:
            yield data[:e.start].decode() + "�"
            data = data[e.start + 1:]


@lru_cache(maxsize=2)
def _model(content: bytes) -> Model:
    return Model(content)


def read_model(path: str) -> bytes:
    """The bytes of a model file, checked to be small and of a supported kind."""
    with open(path, "rb") as f:
        content = f.read(MODEL_BYTES + 1)
    if len(content) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    _model(content)
    return content


class Encoder:
    """Encodes texts; forgets its words before a slice once they are more than ``KNOWN_WORDS`` or ``KNOWN_CHARS``."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.ids, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def __call__(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each text)."""
        if len(self.number) > KNOWN_WORDS or self.chars > KNOWN_CHARS:
            self._forget()
        known, number, words, n_words = len(self.number), self.number, [], []
        for text in texts:
            found = self.model.words.findall(SPACE + text.replace(" ", SPACE)) if text else []
            n_words.append(len(found))
            words += [number.setdefault(w, len(number)) for w in found]
        fresh = list(islice(reversed(number), len(number) - known))[::-1]
        if fresh:
            self.chars += sum(map(len, fresh))
            ids, counts = self.model.encode_words(fresh)
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        starts = np.cumsum(self.counts) - self.counts
        of_word = np.array(words, np.int64)
        size = self.counts[of_word]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(starts[of_word] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        last = np.concatenate([[0], ends])[np.cumsum(n_words, dtype=np.int64)] if len(texts) else np.zeros(0, np.int64)
        return ids, np.diff(last, prepend=0)


def _slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` in sum, or one row."""
    start = total = end = 0
    for end, size in enumerate(sizes):
        if end > start and total + size > most:
            yield start, end
            start, total = end, 0
        total += size
    if total or end >= start:
        yield start, end + 1


def encode(df: DataFrame, model: bytes, text: str = "text", out: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) and the ids of each text as ``out``, an array of int."""
    columns = list(df.columns if keep is None else keep)
    name = free_name(df, "_content")
    rows = df.select(*columns, F.col(text).cast("binary").alias(name))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_model(model))
        for batch in batches:
            content = batch.column(len(columns))
            for start, end in _slices(pc.fill_null(pc.binary_length(content), 0).to_pylist(), SLICE_CHARS) if len(batch) else ():
                texts = [b.decode("utf-8", "replace") if b else "" for b in content.slice(start, end - start).to_pylist()]
                ids, counts = encoder(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([c.slice(start, end - start) for c in batch.columns[:-1]] + [lists], [*columns, out])

    schema = df.select(*columns).schema.add(out, ArrayType(IntegerType()))
    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, model: bytes, ids: str = "ids", out: str = "decoded", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) and the text of each row's ids as ``out``."""
    columns = list(df.columns if keep is None else keep)
    name = free_name(df, "_ids")
    rows = df.select(*columns, F.col(ids).alias(name))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _model(model)
        for batch in batches:
            lists = batch.column(len(columns))
            for start, end in _slices((len(x) if x.is_valid else 0 for x in lists), SLICE_CHARS) if len(batch) else ():
                texts = [tables.decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else "" for x in lists.slice(start, end - start)]
                yield pa.RecordBatch.from_arrays([c.slice(start, end - start) for c in batch.columns[:-1]] + [pa.array(texts, pa.string())], [*columns, out])

    schema = df.select(*columns).schema.add(out, "string")
    return rows.mapInArrow(run, schema)


def round_trips(df: DataFrame, model: bytes) -> DataFrame:
    """Per row of ``doc_id`` and ``text``: ids counted and hashed, and the hash of the text decoded from them."""
    both = decode(encode(df.select("doc_id", "text"), model, keep=["doc_id"]), model)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
