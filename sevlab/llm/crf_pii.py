"""Personal data by patterns and a linear-chain conditional random field.

Patterns find the regular forms (email, ip, card, phone). The field labels the tokens of
the text and so adds what the patterns miss: phone numbers without a country code, spelled-out
addresses, card-like numbers with a typing error. Its features are word shapes of a token and its neighbours;
it is trained on the driver from a small labelled table (at most ``MAX_LABELLED`` rows, by gradient ascent
on the penalised likelihood) and decoded by Viterbi, batch-wise in numpy, inside the tasks.

Every token of every text is scored (by classes of tokens with the same features) and the labels are the best path over
the whole text. Viterbi itself runs only over tokens that can be labelled: where no run of tokens around one can gain
by labels, whatever they are, the best path has it outside any span (``_may_be_inside``), so the result is that
of whole texts. There is no shuffle: each row is judged alone, whatever its source or its copies.

Defined results: null and empty texts have no span; a span of the field that overlaps a pattern's is dropped;
offsets are code points, the end exclusive; equal texts get equal spans; empty tables give empty results.
The patterns are written so that each takes time linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sevlab.llm import bytescan as scan

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
MAX_LABELLED = 2000
MAX_SEEN = 1 << 19  # distinct tokens whose class a task keeps
SMOOTHING = 0.02
BATCH_TOKENS = 1 << 15  # that Viterbi takes at once, padding included; a longer sequence goes alone
DIGIT, AT, PLUS = (scan.byte_set(s) for s in (b"0123456789", b"@", b"+"))

# A run of the first class is consumed whole even if the rest fails: no later start inside it can match.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")
#: What may surround a token without being part of it.
_EDGE = "\"'`!?,;:*#$%&<>|[]{}=~^"

Span = tuple[int, int, int]  # start, number of the kind, end


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str, at: bool = True, digit: bool = True, plus: bool = True) -> list[Span]:
    """The patterns' spans; the flags tell whether the text has an @ sign, a digit and a plus sign."""
    out: list[Span] = []
    if at:
        out += [(m.start(), 0, m.end()) for m in _EMAIL.finditer(text) if m[1]]
    if digit:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if m[1] and all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = re.sub(r"[ -]", "", m[0])
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                out.append((m.start(), 2, m.end()))
    if plus and digit:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def tokens(text: str, start: int = 0, end: int | None = None) -> list[tuple[int, int]]:
    """White-space separated tokens without surrounding signs and without a final point."""
    out = []
    for m in _TOKEN.finditer(text, start, len(text) if end is None else end):
        a, b = m.span()
        while a < b and text[a] in _EDGE:
            a += 1
        while a < b and (text[b - 1] in _EDGE or text[b - 1] == "."):
            b -= 1
        out.append((a, max(a, b)) if a < b else m.span())
    return out


def shape(token: str) -> str:
    """Runs of digits as 9, of capitals as A, of other letters as a; signs stay."""
    kinds = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_a-z]+", "A", re.sub(r"[a-z]+", "a", token)))
    return kinds[:24]


def _amount(token: str) -> str:
    n = sum("0" <= c <= "9" for c in token)
    return next((f"d{k}" for k in (0, 1, 2, 3, 4, 6, 7, 9, 11, 15, 16, 19) if n <= k), "d+")


def features(words: list[str]) -> list[list[str]]:
    """Shape features of each token and its neighbours."""
    shapes = [shape(w) for w in words]
    lower = [w.lower() if w.isalpha() and len(w) < 12 else "-" for w in words]
    n = len(words)
    out = []
    for i, w in enumerate(words):
        before, after = (shapes[i - 1] if i else "^"), (shapes[i + 1] if i + 1 < n else "$")
        own = [f"s={shapes[i]}", f"n={_amount(w)}", f"sn={shapes[i]}/{_amount(w)}", f"p={before}", f"q={after}", f"ps={before}/{shapes[i]}", f"sq={shapes[i]}/{after}",
               f"w={lower[i]}", f"pw={lower[i - 1] if i else '^'}", f"at={'@' in w}", f"dot={w.count('.')}", f"num={any(c.isdigit() for c in w)}", f"alpha={w.isalpha()}"]
        out.append(own)
    return out


@dataclass
class Field:
    """A trained field: a row of label weights for each feature, transitions, and first-label weights."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        at = [[self.index[f] for f in fs if f in self.index] for fs in features(words)]
        return np.array([self.weights[a].sum(axis=0) for a in at]).reshape(len(words), len(LABELS))

    def decode(self, sequences: list[list[str]]) -> list[list[int]]:
        """The best labels of each sequence."""
        return self.paths([self.scores(s) for s in sequences])

    def paths(self, scores: list[np.ndarray]) -> list[list[int]]:
        """The best labels of scored sequences; those of like length go through Viterbi together."""
        out: list[list[int]] = [[] for _ in scores]
        parts: list[list[int]] = [[]]
        for i in sorted((i for i, s in enumerate(scores) if len(s)), key=lambda i: len(scores[i])):
            if (len(parts[-1]) + 1) * len(scores[i]) > BATCH_TOKENS:
                parts.append([])
            parts[-1].append(i)
        for part in filter(None, parts):
            lengths = np.array([len(scores[i]) for i in part])
            emit = np.zeros((len(part), lengths.max(), len(LABELS)))
            for row, i in enumerate(part):
                emit[row, :lengths[row]] = scores[i]
            best = self.first + emit[:, 0]
            back = np.zeros(emit.shape, np.int64)
            for t in range(1, emit.shape[1]):
                step = best[:, :, None] + self.moves
                back[:, t] = step.argmax(axis=1)
                live = (t < lengths)[:, None]
                best = np.where(live, step.max(axis=1) + emit[:, t], best)
            for row, i in enumerate(part):
                label = int(best[row].argmax())
                path = [label]
                for t in range(lengths[row] - 1, 0, -1):
                    label = int(back[row, t, label])
                    path.append(label)
                out[i] = path[::-1]
        return out


def _allowed() -> np.ndarray:
    """I follows B or I of its kind only."""
    ok = np.ones((len(LABELS), len(LABELS)), bool)
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            ok[:, j] = [x[1:] == label[1:] and x[0] != "O" for x in LABELS]
    return ok


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def train(sequences: list[tuple[list[str], list[int]]], rounds: int = 60) -> Field:
    """Gradient ascent (with per-weight steps) on the penalised log-likelihood; forward and backward sums
    give the gradient. Deterministic."""
    found = [features(words) for words, _ in sequences]
    index = {f: i for i, f in enumerate(sorted({f for fs in found for own in fs for f in own}))}
    ids = [np.array([[index[f] for f in own] for own in fs]) for fs in found]
    n = len(LABELS)
    barred = np.where(_allowed(), 0.0, -1e9)
    no_inside = np.array([-1e9 if x[0] == "I" else 0.0 for x in LABELS])
    w, moves, first = np.zeros((len(index), n)), np.zeros((n, n)), np.zeros(n)
    square = [np.full(x.shape, 1e-8) for x in (w, moves, first)]
    for _ in range(rounds):
        grads = [-SMOOTHING * x for x in (w, moves, first)]
        for at, (_, labels) in zip(ids, sequences, strict=True):
            emit = w[at].sum(axis=1)
            step, begin = moves + barred, first + no_inside
            length = len(labels)
            alpha, beta = np.zeros((length, n)), np.zeros((length, n))
            alpha[0] = begin + emit[0]
            for t in range(1, length):
                alpha[t] = _logsum(alpha[t - 1][:, None] + step, 0) + emit[t]
            for t in range(length - 2, -1, -1):
                beta[t] = _logsum(step + (emit[t + 1] + beta[t + 1])[None, :], 1)
            total = _logsum(alpha[-1], 0)
            own = np.exp(alpha + beta - total)
            for t, label in enumerate(labels):
                delta = -own[t]
                delta[label] += 1
                np.add.at(grads[0], at[t], delta)
                if t:
                    grads[1] -= np.exp(alpha[t - 1][:, None] + step + (emit[t] + beta[t])[None, :] - total)
                    grads[1][labels[t - 1], label] += 1
            grads[2] -= own[0]
            grads[2][labels[0]] += 1
        for x, g, s in zip((w, moves, first), grads, square, strict=True):
            s += g * g
            x += 0.5 * g / np.sqrt(s)
    return Field(index, w, moves + barred, first + no_inside)


#: Sentences of the labelled table. Braces name a kind whose examples are put in.
SENTENCES = (
    "You can reach me at {phone} after six.", "Call {phone} or write to {email} today", "phone {phone}", "tel. {phone}, room 12", "My number is {phone} and my card is {card}",
    "Please mail {email} for details.", "contact: {email}", "write to {email} or {email}", "The server {ip} did not answer", "host {ip} port 8080", "ping {ip} and {ip} first",
    "paid with {card} on 12 May 2021", "card {card} expired", "His card number {card} was stolen", "{phone}", "{email}", "{ip}", "{card}",
    "and then {phone} the that of", "red as the {card} on his desk", "la de {phone} que por", "und die {ip} von der", "le la {email} ou pas",
    "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "the GNU General Public License, version 3.", "Chapter 12, page 345", "It cost 1500 dollars in 1998.",
    "version 1.2.3 of the program", "on 2021-03-04 at 10:30", "about 3,000,000 people", "a score of 17 to 3", "rooms 101 and 102", "In 2019 the 5 largest of 120 firms made 33.5 % more",
    'token = "3f0a77c1d5e8b2946072ac1be95d4f3380167e2c" of the', "key b81e4470cf95d2a36e0137fd8c5ba92264ef1d0a was", "commit 7d52e1f09b3a4c8866f0135eabc97d2408f4b6e3", "order 48213 of item 77", "see section 4.2 and table 7",
    "from 1914 to 1918 the war", "the @ sign", "the 3rd of 4 parts", "call it a day at 5", "the card game of 52 cards", "write 100 lines", "on line 250 of 300", "id 20384756 was closed",
    # Texts without digits and @ signs, so that signs between plain words are not taken for spelled-out addresses.
    "home | news | sport | about us | help", "Next | Last | First. | more words | and others | here", "- one - two - three", "the * of # a $ or % in & by < to > we",
    "a a a a a b b b at at at. at. at.", "Plain words of a text that names nobody and has no sign at all.", "They met at the house, and the dot on the map was small; it was so. Nobody looked at it again.",
    "und so weiter und die der das | von | mit", "señor añadió | está | él, ésta école | été", "the com of net and org dot",
)
EXAMPLES = {
    "email": ("anna.bell@example.com", "19@mail5.example.com", "j_smith99@post.example.org", "anna [at] example.com", "info (at) firm.example.net", "tom@example", "bob.ray at example dot com", "x.y@mail.co"),
    "ip": ("192.168.10.254", "10.0.0.1", "198.51.100.162", "203.0.113.204", "8.41.77.130", "172.16.300.4"),
    "card": ("4111 1111 1111 1111", "6304000000000000", "3530111333300000", "3782-822463-10005", "6011000990139424", "5105 1051 0510 5100", "4929-1234-5678-9012"),
    "phone": ("+1 (202) 555-0143", "(312) 555-0187", "555-0142", "+49 30 901820", "030 90182000", "0171/5550199", "312-555-0187", "+44 20 7946 0018", "(202) 555-0143", "212.555.0187"),
}


def labelled_rows() -> list[tuple[str, list[Span]]]:
    """The small labelled table: every sentence with every example of its first kind in turn."""
    out = []
    for sentence in SENTENCES:
        names = re.findall(r"\{(\w+)\}", sentence)
        for k in range(max([len(EXAMPLES[x]) for x in names], default=1)):
            text, spans = "", []
            for i, piece in enumerate(re.split(r"\{(\w+)\}", sentence)):
                if i % 2:
                    value = EXAMPLES[piece][(k + i // 2) % len(EXAMPLES[piece])]
                    spans.append((len(text), KINDS.index(piece), len(text) + len(value)))
                    text += value
                else:
                    text += piece
            out.append((text, spans))
    return out


def labelled_table(spark: SparkSession) -> DataFrame:
    """text and spans (start, kind, end), as ``fit`` takes them."""
    rows = [(t, [(a, KINDS[k], b) for a, k, b in s]) for t, s in labelled_rows()]
    return spark.createDataFrame(rows, "text string, spans array<struct<start:int,kind:string,end:int>>")


def sequence(text: str, spans: list[Span]) -> tuple[list[str], list[int]]:
    """A labelled text as tokens and labels: a token that overlaps a span is in it."""
    at = tokens(text)
    labels = []
    for a, b in at:
        hit = next((s for s in spans if a < s[2] and b > s[0]), None)
        labels.append(0 if hit is None else 1 + 2 * hit[1] + (a > hit[0] and any(hit[0] <= x < a for x, _ in at)))
    return [text[a:b] for a, b in at], labels


def fit(table: DataFrame, max_rows: int = MAX_LABELLED) -> Field:
    """A field from a labelled table of at most ``max_rows`` rows (a larger one is refused, not cut)."""
    rows = table.select("text", "spans").limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"the labelled table has over {max_rows} rows; pass a larger max_rows")
    rows = sorted((r.text or "", [(s.start, KINDS.index(s.kind), s.end) for s in r.spans or ()]) for r in rows)
    return train([x for x in (sequence(t, s) for t, s in rows) if x[0]])


class _Scorer:
    """The field's scores of many tokens at once. What a token's own features add is looked up by the token; what its
    neighbours add comes from small tables over the shapes and words that the field knows (number 0: all others)."""

    def __init__(self, field: Field) -> None:
        self.field, n_labels = field, len(LABELS)
        named = {k: [f[len(k) + 1:] for f in field.index if f.startswith(f"{k}=")] for k in ("p", "q", "pw", "ps", "sq")}
        cuts = {x: [(x[:i], x[i + 1:]) for i, c in enumerate(x) if c == "/"] for k in ("ps", "sq") for x in named[k]}  # shapes may hold the sign, too
        self.shapes = {x: i for i, x in enumerate(sorted({"^", "$", *named["p"], *named["q"], *(y for c in cuts.values() for pair in c for y in pair)}), 1)}
        self.lower = {x: i for i, x in enumerate(sorted({"^", *named["pw"]}), 1)}
        n = len(self.shapes) + 1
        self.before, self.after, self.word_before = np.zeros((n, n_labels)), np.zeros((n, n_labels)), np.zeros((len(self.lower) + 1, n_labels))
        for table, key, numbers in ((self.before, "p", self.shapes), (self.after, "q", self.shapes), (self.word_before, "pw", self.lower)):
            for x in named[key]:
                table[numbers[x]] = field.weights[field.index[f"{key}={x}"]]
        self.pairs = {k: np.full((n, n), -1) for k in ("ps", "sq")}
        for k, table in self.pairs.items():
            for x in named[k]:
                for left, right in cuts[x]:
                    table[self.shapes[left], self.shapes[right]] = field.index[f"{k}={x}"]
        self.known = {f.split("=", 1)[1] for f in field.index if f.startswith(("w=", "pw="))}
        self._clear()

    def _clear(self) -> None:
        self.seen: dict[str, int] = {}  # the class of each token
        self.classes: dict[tuple, int] = {}  # what tokens of like features have in common
        self.own, self.kinds = np.zeros((1024, len(LABELS))), np.zeros((1024, 2), np.int64)

    def _new(self, raw: str) -> int:
        word = raw.lstrip(_EDGE).rstrip(_EDGE + ".") or raw  # as in tokens
        alpha = word.isalpha()
        lower = word.lower() if alpha and len(word) < 12 else "-"
        lower = lower if lower in self.known else None
        if alpha and word.isascii() and (word.islower() or word[1:].islower() or word.isupper()):
            key = ("a" if word.islower() else "A" if word.isupper() else "Aa" if word[0].isupper() else "a", lower)
        else:
            key = (shape(word), lower, _amount(word), "@" in word, word.count("."), any(map(str.isdigit, word)), alpha)
        i = self.classes.get(key)
        if i is None:
            i, index = len(self.classes), self.field.index
            if i == len(self.own):
                self.own, self.kinds = (np.concatenate([x, np.zeros_like(x)]) for x in (self.own, self.kinds))
            mine = [index[f] for f in features([word])[0] if f in index and not f.startswith(("p=", "q=", "pw=", "ps=", "sq="))]
            self.own[i] = self.field.weights[mine].sum(axis=0)
            self.kinds[i] = self.shapes.get(shape(word), 0), self.lower.get(lower, 0)
            self.classes[key] = i
        self.seen[raw] = i
        return i

    def scores(self, raw: list[str], first: np.ndarray) -> np.ndarray:
        """A row for each token of the texts whose first tokens' numbers are given (no text is without tokens)."""
        if len(self.seen) > MAX_SEEN:
            self._clear()
        get, new = self.seen.get, self._new
        number = np.array([i if (i := get(w)) is not None else new(w) for w in raw])
        mine, lower = self.kinds[number].T
        left, right, word = np.roll(mine, 1), np.roll(mine, -1), np.roll(lower, 1)
        left[first], word[first] = self.shapes["^"], self.lower["^"]
        right[np.append(first[1:], len(raw)) - 1] = self.shapes["$"]
        out = self.own[number] + self.before[left] + self.after[right] + self.word_before[word]
        for index in (self.pairs["ps"][left, mine], self.pairs["sq"][mine, right]):
            some = np.flatnonzero(index >= 0)
            out[some] += self.field.weights[index[some]]
        return out


def _may_be_inside(field: Field, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which tokens the best paths of the texts can label. If a run of labelled tokens is put outside, a path loses at
    most the sum of ``gain`` over the run and ``close``; a token around which every run's sum is below nothing
    is outside."""
    gain = (scores + field.moves.max(axis=0))[:, 1:].max(axis=1) - scores[:, 0] - field.moves[0, 0]
    gain[first] = (scores[first] + field.first)[:, 1:].max(axis=1) - scores[first, 0] - field.first[0]
    close = max(0.0, float(field.moves[1:, 0].max() - field.moves[0, 0]))
    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(gain))))
    total = np.concatenate([[0.0], np.cumsum(gain)])
    start, end = total[:-1] - total[first][row], total[1:] - total[first][row]
    apart = row * (2 * max(np.abs(start).max(), np.abs(end).max()) + 1)  # so that no run crosses texts
    lowest = np.minimum.accumulate(start - apart) + apart
    highest = np.maximum.accumulate((end - apart)[::-1])[::-1] + apart
    return highest - lowest + close > -0.01


def field_spans(field: Field, texts: list[str], scorer: _Scorer | None = None) -> list[list[Span]]:
    """What the field labels in each text."""
    out: list[list[Span]] = [[] for _ in texts]
    split = [t.split() for t in texts]
    used = [i for i, s in enumerate(split) if s]
    if not used:
        return out
    counts = np.array([len(split[i]) for i in used])
    first = np.cumsum(counts) - counts
    scores = (scorer or _Scorer(field)).scores([w for i in used for w in split[i]], first)
    inside = _may_be_inside(field, scores, first)
    begins, finals = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    begins[first], finals[first + counts - 1] = True, True
    low = np.flatnonzero(inside & (begins | ~np.roll(inside, 1)))
    high = np.flatnonzero(inside & (finals | ~np.roll(inside, -1))) + 1
    segments = []
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        part = scores[a:b].copy()  # between tokens that are outside
        if not begins[a]:
            part[0] += field.moves[0] - field.first
        if not finals[b - 1]:
            part[-1] += field.moves[:, 0]
        segments.append(part)
    spots: dict[int, list[tuple[int, int]]] = {}
    for a, r, path in zip(low.tolist(), (np.searchsorted(first, low, "right") - 1).tolist(), field.paths(segments), strict=True):
        if not any(path):
            continue
        i = used[r]
        at = spots.get(i) or spots.setdefault(i, tokens(texts[i]))
        for (x, y), label in zip(at[a - first[r]:], path, strict=False):
            kind = (label - 1) // 2
            if label and label % 2:
                out[i].append((x, kind, y))
            elif label and out[i]:
                out[i][-1] = (out[i][-1][0], kind, y)
    return out


def merged(base: list[Span], more: list[Span]) -> list[Span]:
    """All base spans and those others that overlap none of them."""
    return sorted(base + [s for s in more if not any(s[0] < b[2] and s[2] > b[0] for b in base)])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, the counts and the digest of the base spans, and all spans, for every row."""
    field = field or fit(labelled_table(docs.sparkSession))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(field)
        for batch in it:
            base: list[list[Span]] = [[] for _ in range(batch.num_rows)]
            every: list[list[Span]] = [[] for _ in range(batch.num_rows)]
            for first, _, data, offsets in scan.chunks(batch.column(1)):
                has = {k: scan.per_row(t[data], offsets) > 0 for k, t in (("at", AT), ("digit", DIGIT), ("plus", PLUS))}
                rows = np.flatnonzero(np.diff(offsets))
                texts = [data[offsets[r]:offsets[r + 1]].tobytes().decode() for r in rows]
                for r, text, more in zip(rows, texts, field_spans(field, texts, scorer), strict=True):
                    base[first + r] = base_spans(text, has["at"][r], has["digit"][r], has["plus"][r])
                    every[first + r] = merged(base[first + r], more)
            counts = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            digest = pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digest, pa.array([listed(s) for s in every], pa.string())],
                                             names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(batches, schema)
