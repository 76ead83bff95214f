"""Benchmark decontamination by latent semantic retrieval.

Texts are lower-cased runs of letters and digits. A passage is ``2 * HALF`` words, a new one starts every
``HALF`` words. Steps, for each block of benchmark items:

1. One pass over the texts writes every word's number in the block's vocabulary (0: not in it), so later
   passes don't read texts.
2. Document frequencies over all passages give inverse document frequencies; terms in over ``MAX_SHARE`` of
   the passages are not used for retrieval (but each item keeps its ``LEAST_TERMS`` rarest ones).
3. Randomised SVD of the passages-by-terms matrix A: every task adds its passages' part of ``A'(A Omega)``, the
   parts are summed in a tree, and the small result (terms by ``RANK + OVERSAMPLE``) gives the leading right
   singular vectors by the Nystrom formula (Tropp et al., 2017).
4. Every passage is compared with every item of the block in the latent space; a cosine of ``COSINE`` or more
   makes a candidate (no limit on their number). An item longer than a passage is compared as a whole and in
   parts of a passage's size, one every ``HALF`` words. Items of fewer than ``SHORT_WORDS`` words, for which a
   cosine cannot vouch, are found by an exact index instead: a text that can match such an item holds one of
   its rarest words (so many that the words it may lack are fewer).
5. A candidate stays if its whole text and the text around the passage can hold enough of the item's words, and
   is then checked by the longest common subsequence of the item and that text, and of the item's answer (its last fifth,
   three words at least). The text is the passage with the item's number of words and ``HALF`` more on
   either side, so it holds the whole item wherever in it the passage stands. That finds paraphrases that
   keep most words in order.

Items with one text are compared once. What is sent to tasks is bounded by about ``BLOCK_ITEMS`` items, however large the corpus or the benchmark; a larger
benchmark takes more blocks. Nothing is grouped by document or term beyond map-side sums.

Defined results: null and empty texts and items without words match nothing; a document matches an item
once, at its best passage (the earliest of equals); repeated documents and items each give rows; documents of
one doc_id (or none) and different texts are judged apart; empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlab.llm import bytescan as scan
from sevlab.llm.common import written

HALF = 32
MAX_SHARE, LEAST_TERMS = 0.01, 8
RANK, OVERSAMPLE, SEED = 128, 16, 7
COSINE = 0.2
SHORT_WORDS = 16  # items of fewer words are retrieved by their rarest words
LCS_SHARE, ANSWER_SHARE = 0.7, 0.5
BLOCK_ITEMS = 1024
VECTORS = 256  # items and parts compared at once
FAN_IN = 32
SLICE_ROWS, SLICE_BYTES = 512, 1 << 20  # of packed words that are worked on at once
TERM_ROWS = 1 << 13  # words whose vectors are added up at once (more of one half passage or one term together)
CHECK_WORDS = 1 << 17  # of texts around candidates that are compared at once
COLUMNS = ("doc_id", "item_id", "item_words", "lcs_words", "answer_lcs", "first_word")


def _hashed(texts: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """First row, end row and the hashes of each text's words, in order, for runs of rows."""
    texts = texts.cast(pa.large_string())
    for begin, stop, _, _ in scan.chunks(texts):  # lower-cased a chunk at a time
        for first, end, data, offsets in scan.chunks(pc.utf8_lower(pc.fill_null(texts.slice(begin, stop - begin), ""))):
            spans = scan.words(data, offsets, scan.NOT_ALNUM)
            hashes = scan.word_hashes(data, spans)
            yield begin + first, begin + end, [hashes[spans.first[i]:spans.first[i + 1]] for i in range(end - first)]


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order."""
    for _, _, found in _hashed(texts):
        yield from found


def longest_common(pattern: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence, with the bits of an integer as the row (Hyyro, 2004).
    ``pattern``: for each word of the item, a bit for each of its positions."""
    full = (1 << size) - 1
    row = full
    for w in words:
        at = row & pattern.get(w, 0)
        row = ((row + at) | (row - at)) & full
    return size - row.bit_count()


def positions(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def answer_start(n: int) -> int:
    return max(0, n - max(3, n // 5))


def _parts(words: np.ndarray) -> list[np.ndarray]:
    """What is retrieved of an item: all its words and, if a passage holds fewer, parts of a passage's size."""
    n = len(words)
    return [words, *[words[min(k, n - 2 * HALF):][:2 * HALF] for k in range(0, n - HALF, HALF) if n > 2 * HALF]]


class Items:
    """A block of items as numbers in its vocabulary (from 1)."""

    def __init__(self, rows: list) -> None:
        found = list(word_hashes(pa.array([r.text for r in rows], pa.large_string())))
        kept = [(r.item_id, h) for r, h in zip(rows, found, strict=True) if len(h)]
        self.ids = [i for i, _ in kept]
        self.vocabulary = np.unique(np.concatenate([h for _, h in kept])) if kept else np.zeros(0, np.uint64)
        self.words = [np.searchsorted(self.vocabulary, h) + 1 for _, h in kept]
        self.parts = [(i, part) for i, w in enumerate(self.words) for part in _parts(w)]
        self.kind = "<u2" if len(self.vocabulary) < 65535 else "<u4"

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), self.kind)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(self.kind)


def coded(docs: DataFrame, items: Items) -> DataFrame:
    """doc_id, the text's md5 and each word's number in the vocabulary, as packed integers."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for first, end, hashes in _hashed(batch.column(2)):  # a chunk's rows at a time
                codes = pa.array([items.numbers(h).tobytes() for h in hashes], pa.binary())
                own = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), codes], names=["doc_id", "text_key", "words"])

    kind = T.StructType([docs.schema["doc_id"], T.StructField("text_key", T.StringType()), T.StructField("words", T.BinaryType())])
    return written(docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(batches, kind), "coded")


def text_key() -> Column:
    """What tells rows with one doc_id apart."""
    return F.md5(F.coalesce(F.col("text"), F.lit("")))


def _halves(batch: pa.RecordBatch, column: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of a batch, each row's first word, and each row's first half passage (of HALF words)."""
    words = batch.column(column).cast(pa.large_binary())
    _, off, data = words.buffers()
    size = np.dtype(kind).itemsize
    offsets = np.frombuffer(off, np.int64)[words.offset:words.offset + len(words) + 1]
    codes = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(kind) if data is not None else np.zeros(0, kind)
    first = (offsets - offsets[0]) // size
    return codes, first, np.concatenate([[0], np.cumsum(-(-np.diff(first) // HALF))])


def _half_of(first: np.ndarray, half: np.ndarray) -> np.ndarray:
    """The half passage of each word."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return half[row] + (np.arange(first[-1]) - first[row]) // HALF


def _pairs(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last half of each passage; a row of one half is one passage."""
    n = np.diff(half)
    last_of_row = np.zeros(half[-1], bool)
    last_of_row[half[1:][n > 0] - 1] = True
    only = np.zeros(half[-1], bool)
    only[half[:-1][n == 1]] = True
    a = np.flatnonzero(~last_of_row | only)
    return a, np.where(only[a], a, a + 1)


def _sum_tree(parts: DataFrame) -> DataFrame:
    """One row of summed float64 vectors for each ``slot`` of (slot, part, vector)."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        total = sum(np.frombuffer(v) for v in pdf["vector"])
        return pd.DataFrame([{"slot": pdf["slot"].iloc[0], "part": pdf["part"].iloc[0], "vector": total.tobytes()}])

    schema = "slot int, part int, vector binary"
    return parts.groupBy("slot", F.floor(F.col("part") / FAN_IN)).applyInPandas(add, schema).groupBy("slot").applyInPandas(add, schema)


SLOT = 64  # terms whose vectors travel together


def _summed(rows: DataFrame, terms: int, width: int, add: Callable[[np.ndarray, pa.RecordBatch], None]) -> np.ndarray:
    """The terms-by-width sum of what ``add`` puts into each task's array; the driver gets this one array."""

    def partial(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((terms, width))
        for batch in it:
            add(total, batch)
        part = TaskContext.get().partitionId()
        slots = [k for k in range(0, terms, SLOT) if total[k:k + SLOT].any()]
        yield pa.RecordBatch.from_pydict({"slot": pa.array([k // SLOT for k in slots], pa.int32()), "part": pa.array([part] * len(slots), pa.int32()),
                                          "vector": pa.array([total[k:k + SLOT].tobytes() for k in slots], pa.binary())})

    out = np.zeros((terms, width))
    for row in _sum_tree(rows.select("words").mapInArrow(partial, "slot int, part int, vector binary")).toLocalIterator():
        out[row.slot * SLOT:(row.slot + 1) * SLOT] = np.frombuffer(row.vector).reshape(-1, width)
    return out


def passage_frequencies(rows: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """In how many passages each term occurs, and how many passages there are."""
    terms = len(items.vocabulary)

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for _, part in _slices(batch, 0):
            add_slice(total, part)

    def add_slice(total: np.ndarray, batch: pa.RecordBatch) -> None:
        codes, first, half = _halves(batch, 0, items.kind)
        if not half[-1]:
            return
        known = codes > 0
        key = np.unique(_half_of(first, half)[known] * (terms + 1) + codes[known])  # distinct terms of each half
        at, term = key // (terms + 1), key % (terms + 1)
        a, b = _pairs(half)
        n = np.bincount(a, minlength=half[-1]) + np.bincount(b[b != a], minlength=half[-1])  # passages of each half
        total[:terms, 0] += np.bincount(term, n[at], terms + 1)[1:]
        follows = np.zeros(half[-1], bool)
        follows[a[b != a]] = True
        both = np.isin(key[follows[at]] + terms + 1, key, assume_unique=True)  # the same term in a passage's two halves
        total[:terms, 0] -= np.bincount(term[follows[at]][both], minlength=terms + 1)[1:]
        total[terms, 0] += len(a)

    found = _summed(rows, terms + 1, 1, add)[:, 0]
    return found[:-1], int(found[-1])


def term_weights(items: Items, frequency: np.ndarray, passages: int) -> np.ndarray:
    """Inverse document frequency of each vocabulary number (0 for number 0 and for terms that are too common)."""
    weight = np.log(1 + passages / np.maximum(frequency, 1))
    use = frequency <= MAX_SHARE * passages
    for _, words in items.parts:
        terms = np.unique(words) - 1
        use[terms[np.argsort(frequency[terms], kind="stable")[:LEAST_TERMS]]] = True
    return np.concatenate([[0.0], np.where(use, weight, 0.0)])


def _runs(starts: np.ndarray, n: int) -> Iterator[tuple[int, int, int, int]]:
    """First and end group and first and end row of runs of whole groups that have at most ``TERM_ROWS`` rows (a
    larger group is one of its own); ``starts``: the first of n rows of each group."""
    ends = np.append(starts[1:], n)
    g = 0
    while g < len(starts):
        k = max(g + 1, int(np.searchsorted(ends, starts[g] + TERM_ROWS, "right")))
        yield g, k, int(starts[g]), int(ends[k - 1])
        g = k


class _Latent:
    """Sums of term vectors over the passages of a batch."""

    def __init__(self, batch: pa.RecordBatch, column: int, kind: str, weight: np.ndarray) -> None:
        self.codes, self.first, self.half = _halves(batch, column, kind)
        self.a, self.b = _pairs(self.half) if self.half[-1] else (np.zeros(0, np.int64),) * 2
        heavy = np.flatnonzero(weight[self.codes] > 0) if len(self.codes) else np.zeros(0, np.int64)
        self.at = _half_of(self.first, self.half)[heavy] if len(heavy) else heavy
        self.term = self.codes[heavy].astype(np.int64)
        self.weight = weight[self.term].astype(np.float32)
        mass = np.bincount(self.at, self.weight.astype(np.float64) ** 2, self.half[-1]) if self.half[-1] else np.zeros(0)
        mass = np.where(self.a == self.b, mass[self.a], mass[self.a] + mass[self.b])
        self.scale = np.divide(1, np.sqrt(mass), out=np.zeros(len(mass)), where=mass > 0).astype(np.float32)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """A row for each passage: its scaled TF-IDF row times ``vectors``."""
        sums = np.zeros((self.half[-1], vectors.shape[1]), np.float32)
        if len(self.at):
            starts = np.flatnonzero(np.diff(self.at, prepend=-1))
            for g, k, x, y in _runs(starts, len(self.at)):
                sums[self.at[starts[g:k]]] = np.add.reduceat(vectors[self.term[x:y]] * self.weight[x:y, None], starts[g:k] - x, axis=0)
        both = np.where((self.a == self.b)[:, None], 0, sums[self.b])
        return (sums[self.a] + both) * self.scale[:, None]

    def back(self, rows: np.ndarray, total: np.ndarray) -> None:
        """Adds the transposed product to ``total``, a row for each vocabulary number."""
        if not len(self.at):
            return
        scaled = rows * self.scale[:, None]
        by_half = np.zeros((self.half[-1], rows.shape[1]), np.float32)
        by_half[self.a] += scaled
        two = self.a != self.b
        by_half[self.b[two]] += scaled[two]
        order = np.argsort(self.term, kind="stable")
        term = self.term[order]
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        for g, k, x, y in _runs(starts, len(term)):
            at = order[x:y]
            total[term[starts[g:k]]] += np.add.reduceat(by_half[self.at[at]] * self.weight[at][:, None], starts[g:k] - x, axis=0)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Each run of at most ``SLICE_ROWS`` rows and ``SLICE_BYTES`` of their words (a longer row is one of its own),
    after the number of its first row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        most = (ends[at - 1] if at else 0) + SLICE_BYTES
        end = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, most, "right"))))
        yield at, batch.slice(at, end - at)
        at = end


def latent_space(rows: DataFrame, items: Items, weight: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors, a row for each vocabulary number."""
    used = np.flatnonzero(weight > 0)
    width = min(rank + OVERSAMPLE, len(used))
    omega = np.zeros((len(weight), width), np.float32)
    omega[used] = np.linalg.qr(np.random.default_rng(SEED).standard_normal((len(used), width)))[0]

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for _, part in _slices(batch, 0):
            latent = _Latent(part, 0, items.kind, weight)
            latent.back(latent.project(omega), total)

    z = _summed(rows, len(weight), width, add)[used]
    o = omega[used].astype(np.float64)
    shift = np.sqrt(len(used)) * np.finfo(np.float32).eps * max(np.linalg.norm(z), 1e-30)
    z = z + shift * o
    middle = o.T @ z
    values, vectors = np.linalg.eigh((middle + middle.T) / 2)
    keep = values > shift
    u, _, _ = np.linalg.svd(z @ (vectors[:, keep] / np.sqrt(values[keep])), full_matrices=False)
    out = np.zeros((len(weight), min(rank, u.shape[1])), np.float32)
    out[used] = u[:, :rank]
    return out


def _check(items: Items, patterns: list, item: int, region: list[int]) -> tuple[int, int]:
    """Common words of the item and of its answer."""
    n = len(items.words[item])
    whole, answer = patterns[item]
    return longest_common(whole, n, region), longest_common(answer, n - answer_start(n), region)


def _known(latent: _Latent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word in the vocabulary: its place, its number, and (as an index here) its row's last one of the same
    number, -1 if there is none. The numbers and indexes have one more entry, so that an empty batch has one."""
    known = np.flatnonzero(latent.codes)
    codes = np.append(latent.codes[known].astype(np.int64), 0)
    key = (np.searchsorted(latent.first, known, "right") << 32) + codes[:-1]
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(np.diff(key[order]) == 0)
    before = np.full(len(codes), -1)
    before[order[same + 1]] = order[same]
    return known, codes, before


def _able(latent: _Latent, bags: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which rows' whole texts can hold enough of which items' words (a row's word may stand for all of an item's)."""
    rows = len(latent.first) - 1
    out = np.zeros((rows, bags.shape[1]), bool)
    some = max(1, (1 << 22) // len(bags))
    for r in range(0, rows, some):
        first = latent.first[r:r + some + 1]
        has = np.zeros((len(first) - 1, len(bags)), np.float32)
        has[np.repeat(np.arange(len(first) - 1), np.diff(first)), latent.codes[first[0]:first[-1]]] = 1
        out[r:r + some] = has @ bags >= least - 0.5
    return out


class _RareWords:
    """The exact index of short items: a text that holds all but n - least of an item's n words holds one of its
    n - least + 1 rarest ones, so only passages whose checked text holds one of those can match."""

    def __init__(self, items: Items, short: np.ndarray, least: np.ndarray, frequency: np.ndarray) -> None:
        pairs = []
        for i in short:
            words = items.words[i]
            rarest = words[np.argsort(frequency[words - 1], kind="stable")[:len(words) - least[i] + 1]]
            pairs += [(int(w), int(i)) for w in np.unique(rarest)]
        pairs.sort()
        self.item = np.array([i for _, i in pairs], np.int64)
        self.first = np.searchsorted([w for w, _ in pairs], np.arange(len(items.vocabulary) + 2))
        self.reach = 3  # half passages on either side of a passage that its checked text can touch

    def candidates(self, latent: "_Latent", row_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, item) pairs."""
        codes = latent.codes.astype(np.int64)
        n = self.first[codes + 1] - self.first[codes]
        n[codes == 0] = 0
        at = np.flatnonzero(n)
        if not len(at) or not len(latent.a):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = n[at]
        ends = np.cumsum(size)
        item = self.item[np.repeat(self.first[codes[at]] - (ends - size), size) + np.arange(ends[-1])]
        half = np.repeat(_half_of(latent.first, latent.half)[at], size)
        key = np.unique(half * (len(latent.codes) + 1 + int(self.item.max())) + item)  # a word more than once in a half is one pair
        half, item = key // (len(latent.codes) + 1 + int(self.item.max())), key % (len(latent.codes) + 1 + int(self.item.max()))
        passage_of = np.searchsorted(latent.a, half, "right") - 1  # the last passage that starts by this half
        near, rows = [], np.searchsorted(latent.half, half, "right") - 1
        for step in range(-self.reach, self.reach + 1):
            p = passage_of + step
            fine = (p >= 0) & (p < len(latent.a))
            fine[fine] = row_of[p[fine]] == rows[fine]
            near.append(p[fine] * (int(self.item.max()) + 1) + item[fine])
        key = np.unique(np.concatenate(near))
        return key // (int(self.item.max()) + 1), key % (int(self.item.max()) + 1)


def search(rows: DataFrame, items: Items, weight: np.ndarray, space: np.ndarray, frequency: np.ndarray, cosine: float = COSINE, short_words: int = SHORT_WORDS) -> DataFrame:
    """doc_id, text_key, item (its number in the block), lcs_words, answer_lcs and the region's first word of every leak."""
    held = np.zeros((len(items.words), len(weight)), np.int32 if max(map(len, items.words), default=0) > 255 else np.uint8)  # how often each item has each word
    for i, words in enumerate(items.words):
        np.add.at(held[i], words, 1)
    lengths = np.array([len(w) for w in items.words])
    bags = held.T.astype(np.float32)
    long_parts = [(i, words) for i, words in items.parts if lengths[i] >= short_words]
    owner = np.array([i for i, _ in long_parts], np.int64)
    vectors = np.array([np.bincount(words, weight[words]) @ space[:words.max() + 1] for _, words in long_parts]).reshape(len(long_parts), space.shape[1])
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0).astype(np.float32)
    step = np.maximum(lengths // (2 * HALF), 1) * HALF  # passages in one step of a long item share the text that is checked
    least = np.array([-(-len(w) * int(100 * LCS_SHARE) // 100) for w in items.words])
    rare = _RareWords(items, np.flatnonzero(lengths < short_words), least, frequency)
    lists = [w.tolist() for w in items.words]
    patterns = [(positions(w), positions(w[answer_start(len(w)):])) for w in lists]

    def matches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out: dict[tuple[int, int], tuple[int, int, int]] = {}
            for begin_row, part in _slices(batch, 2):
                latent = _Latent(part, 2, items.kind, weight)
                own = latent.project(space)
                size = np.linalg.norm(own, axis=1, keepdims=True)
                row_of = np.searchsorted(latent.half, latent.a, "right") - 1
                found_by = [rare.candidates(latent, row_of)]
                for v in range(0, len(vectors), VECTORS):
                    p, q = np.nonzero(own @ vectors[v:v + VECTORS].T >= cosine * np.maximum(size, 1e-12))
                    found_by.append((p, owner[q + v]))
                passage, item = (np.concatenate(x) for x in zip(*found_by))
                able = _able(latent, bags, least)[row_of[passage], item]  # a bound that no match breaks, before words are compared
                passage, item = passage[able], item[able]
                row = row_of[passage]
                begin = (latent.a[passage] - latent.half[row]) * HALF // step[item] * step[item]
                key = np.unique(np.stack([lengths[item], row, item, begin]), axis=1) if len(items.parts) > len(lengths) else np.stack([lengths[item], row, item, begin])
                size, row, item, begin = key[:, np.argsort(key[0], kind="stable")]
                start = np.maximum(latent.first[row] + begin - size - HALF, latent.first[row])
                end = np.minimum(latent.first[row] + begin + step[item] + size + 2 * HALF, latent.first[row + 1])
                known, codes, before = _known(latent)
                low, high = np.searchsorted(known, start), np.searchsorted(known, end)
                x = 0
                while x < len(item):
                    s = slice(x, x + max(1, CHECK_WORDS // max(1, int((high - low)[x:x + 4096].max()))))
                    at = low[s, None] + np.arange((high[s] - low[s]).max())
                    new = (at < high[s, None]) & (before[np.minimum(at, len(known))] < low[s, None])  # each word once; it may stand for all of the item's
                    enough = np.where(new, held.ravel()[codes[np.minimum(at, len(known))] + item[s, None] * len(weight)], 0).sum(axis=1) >= least[item[s]]
                    for y in np.flatnonzero(enough) + x:
                        i = int(item[y])
                        common, answer = _check(items, patterns, i, latent.codes[start[y]:end[y]].tolist())
                        n = len(lists[i])
                        if common >= least[i] and answer >= ANSWER_SHARE * (n - answer_start(n)):
                            key = (begin_row + int(row[y]), i)
                            found = (common, answer, -int(start[y] - latent.first[row[y]]))
                            out[key] = max(out.get(key, found), found)
                    x = s.stop
            at = pa.array([r for r, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([i for _, i in out], pa.int32()), *[pa.array([abs(v[c]) for v in out.values()], pa.int64()) for c in range(3)]],
                                             names=["doc_id", "text_key", "item", "lcs_words", "answer_lcs", "first_word"])

    schema = T.StructType([rows.schema["doc_id"], rows.schema["text_key"], *[T.StructField(c, t()) for c, t in (("item", T.IntegerType), ("lcs_words", T.LongType), ("answer_lcs", T.LongType), ("first_word", T.LongType))]])
    return rows.select("doc_id", "text_key", "words").mapInArrow(matches, schema)


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, short_words: int = SHORT_WORDS) -> DataFrame:
    """doc_id, item_id, item_words, lcs_words, answer_lcs and first_word of every (document, item) that leaks."""
    return _leaks(docs, benchmark, cosine, short_words).select(*COLUMNS)


def _leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, short_words: int = SHORT_WORDS) -> DataFrame:
    """The rows of ``leaks`` and ``text_key``. Items with one text are compared once."""
    spark = docs.sparkSession
    ids = benchmark.select("item_id", F.sha2("text", 256).alias("item_key")).filter(F.col("item_key").isNotNull())
    texts = benchmark.groupBy(F.sha2("text", 256).alias("item_id")).agg(F.first("text").alias("text")).filter(F.col("text").isNotNull())
    found, blocks = [], -(-texts.count() // BLOCK_ITEMS)
    for block in range(blocks):
        items = Items(texts.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id").collect())  # about BLOCK_ITEMS
        if items.ids:
            rows = coded(docs, items)
            frequency, passages = passage_frequencies(rows, items)
            weight = term_weights(items, frequency, passages)
            space = latent_space(rows, items, weight) if any(len(w) >= short_words for w in items.words) else np.zeros((len(weight), 1), np.float32)
            named = spark.createDataFrame([(x, i, len(items.words[i])) for i, x in enumerate(items.ids)], "item_key string, item int, item_words long")
            found.append(search(rows, items, weight, space, frequency, cosine, short_words).join(F.broadcast(named), "item").drop("item"))
    if not found:
        kinds = {"doc_id": docs.schema["doc_id"].dataType, "item_id": benchmark.schema["item_id"].dataType, "text_key": T.StringType()}
        return docs.filter(F.lit(False)).select(*[F.lit(None).cast(kinds.get(c, T.LongType())).alias(c) for c in (*COLUMNS, "text_key")])
    return reduce(DataFrame.unionByName, found).join(ids, "item_key").select(*COLUMNS, "text_key")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item. Rows are told apart by doc_id and text; only the keys of leaking
    ones are joined to the texts."""
    leaking = written(_leaks(docs, benchmark).select(F.col("doc_id").alias("leak_id"), F.col("text_key").alias("leak_key")).distinct(), "leaking")
    same = docs["doc_id"].eqNullSafe(leaking["leak_id"]) & (F.md5(F.coalesce(docs["text"], F.lit(""))) == leaking["leak_key"])
    return docs.join(leaking, same, "left_anti")
