"""Substring dedup by hashing units of text.

A unit is a line, cut further at sentence ends (a word that ends in . ! or ?) and before capitalised
words, because repeated passages often stand inside a line. A unit of over ``LONG`` words is also cut
before words whose hash is 0 modulo ``CUT``: such cuts depend on the words alone, so a passage is cut
alike wherever it stands. Units are normalised (letters and digits only, lower case for ASCII and
Latin-1) and identified by a 64-bit digest; a unit of fewer than ``LEAST_UNIT`` words is hashed with the
words that follow it in the text, up to that number, so single common words are no repeats.

Over all documents the digests are counted and their earliest document is found (least doc_id, then a hash of
the text); the earliest occurrence of a unit is its first one in that document. Every other occurrence is repeated text. Repeated units that
follow each other make a run, and a run of ``LEAST_WORDS`` words or more is removed; shorter ones stay,
so common phrases and license lines don't tear up clean documents. Runs keep the offsets of the original
text (code points, end exclusive) and the earliest document that holds one of their units.

How it is spread: digests are counted with a map-side combine; those found twice are written as a table and
joined back (an equi join of two plain sides, so adaptive execution can split a hot digest); runs are made
per document.

A run's least length serves the query, whose clean documents share common phrases. Lines and paragraphs that
are repeated whole are units of their own at any length (``repeated_whole_units``, told by 128 bits), and
``without_repeats`` cuts them too if asked.

Defined results: null and empty texts have no unit; doc_id is the rank (nulls first); rows with one doc_id and
different texts are documents of their own, ordered by a hash of the text; rows alike in both are one document,
cut alike; equal units inside one document are repeated after the first; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlab.llm import bytescan as scan
from sevlab.llm.common import free_name, written

LONG, CUT = 16, 8
LEAST_UNIT = 6
LEAST_WORDS = 30
SENTENCE_END = scan.byte_set(b".!?")


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and Latin-1 letters, byte by byte."""
    out = scan.ASCII_LOWER[data]
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    upper = second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    out[upper] += 0x20
    return out


def _sequence_sums(values: np.ndarray) -> np.ndarray:
    powers, _ = scan._power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[:len(values)], out=total[1:])
    return total


def units(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Of every unit with a word in a chunk: its row, number in the row, offsets, words, digest, and
    whether it is the first of its digest in the row."""
    raw = scan.words(data, offsets)
    fold = folded(data)
    words = scan.words(data, offsets, scan.NOT_ALNUM)
    if not len(words.starts):
        return {k: np.zeros(0, np.int64) for k in ("row", "unit", "start", "end", "n_words", "digest", "first")}
    hashes = scan.span_hash(scan.running_hash(fold), words.starts, words.ends)
    n = len(raw.starts)
    begins = np.zeros(n, bool)
    begins[raw.first[:-1][raw.counts > 0]] = True
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    begins[1:] |= breaks[raw.starts[1:]] > breaks[raw.ends[:-1]]
    begins[1:] |= SENTENCE_END[data[raw.ends[:-1] - 1]]
    one = data[raw.starts]
    two = np.where(raw.ends - raw.starts > 1, data[np.minimum(raw.starts + 1, len(data) - 1)], 0)
    three = np.where(raw.ends - raw.starts > 2, data[np.minimum(raw.starts + 2, len(data) - 1)], 0)
    small = lambda b: ((b >= 97) & (b <= 122)) | (b >= 0x80)
    begins |= (one >= 65) & (one <= 90) & small(two)
    begins |= (one == 0xC3) & (two >= 0x80) & (two <= 0x9E) & small(three)
    at = np.flatnonzero(begins)
    own = np.searchsorted(words.starts, raw.starts)  # the first normalised word at or after each raw word
    size = np.diff(np.append(own[at], len(words.starts)))
    inside = np.repeat(size > LONG, np.diff(np.append(at, n)))
    has = np.append(own, len(words.starts))
    begins |= inside & (has[1:] > has[:-1]) & (hashes[np.minimum(own, len(hashes) - 1)] % np.uint64(CUT) == 0)
    at = np.flatnonzero(begins)
    low, high = own[at], np.append(own[at[1:]], len(words.starts))
    real = high > low
    at, low, high = at[real], low[real], high[real]
    row = np.searchsorted(offsets, words.starts[low], "right") - 1
    until = np.maximum(high, np.minimum(low + LEAST_UNIT, words.first[row + 1]))
    _, inverses = scan._power_tables(len(hashes) + 1)
    sums = _sequence_sums(hashes)
    digest = scan.mix((sums[until] - sums[low]) * inverses[low] + (until - low).astype(np.uint64))
    point = np.concatenate([[0], np.cumsum(~scan.CONTINUES[data])])
    start, end = words.starts[low], words.ends[high - 1]
    key = scan.mix(digest + row.astype(np.uint64) * scan.WINDOW_FACTOR[-1])
    first = np.zeros(len(key), bool)
    first[np.unique(key, return_index=True)[1]] = True
    number = np.arange(len(row)) - np.searchsorted(row, row)
    base = point[offsets[row]]
    return {"row": row, "unit": number, "start": point[start] - base, "end": point[end] - base, "n_words": high - low, "digest": digest.view(np.int64), "first": first}


def unit_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, digest, span, place and first of every unit. ``span`` packs start and end, ``place`` the
    unit's number and its words, 32 bits each."""
    columns = ("digest", "span", "place")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for first, _, data, offsets in scan.chunks(batch.column(2)):
                found = units(data, offsets)
                at = pa.array(found["row"] + first, pa.int64())
                packed = {"digest": found["digest"], "span": found["start"] << 32 | found["end"], "place": found["unit"] << 32 | found["n_words"]}
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *[pa.array(packed[c], pa.int64()) for c in columns], pa.array(found["first"].astype(bool))],
                                                 names=["doc_id", "text_key", *columns, "first"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_key", T.LongType()), *[T.StructField(c, T.LongType()) for c in columns], T.StructField("first", T.BooleanType())])
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(batches, schema)


def _runs(docs: DataFrame, least_words: int) -> DataFrame:
    """doc_id, text_key, start, end, n_words and first_doc_id of every run that is removed."""
    table = written(unit_table(docs), "units")
    rank = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "text_key")
    known = table.groupBy("digest").agg(F.min(rank).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # a table of its own, so that the join below has nothing but its two sides and its hot digests can be split
    known = written(known.select("digest", F.col("least.doc_id").alias("first_doc_id"), F.col("least.text_key").alias("first_key")), "repeated-digests")
    earliest = F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("text_key") == F.col("first_key"))
    found = table.join(known, "digest").filter(~F.col("first") | ~earliest)
    low = (1 << 32) - 1
    repeated = found.groupBy("doc_id", "text_key", "place", "span").agg(F.min("first_doc_id").alias("first_doc_id"))
    unit, words = F.shiftright("place", 32), F.col("place").bitwiseAND(low)
    island = unit - F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("place"))
    return repeated.withColumn("island", island).groupBy("doc_id", "text_key", "island").agg(
        F.min(F.shiftright("span", 32)).alias("start"), F.max(F.col("span").bitwiseAND(low)).alias("end"), F.sum(words).alias("n_words"),
        F.min("first_doc_id").alias("first_doc_id")).filter(F.col("n_words") >= least_words).drop("island")


def repeated_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, start, end, n_words and first_doc_id of every run of repeated units that is removed."""
    return _runs(docs, least_words).select("doc_id", "start", "end", "n_words", "first_doc_id")


#: What a whole unit is told by: its words, lower case, without signs.
_WORD = re.compile(r"[^\W_]+")


def whole_units(docs: DataFrame, separator: str) -> DataFrame:
    """doc_id, text_key, unit, start, end, n_words and digest (128 bits) of every line (``"\\n"``) or paragraph
    (``"\\n\\n"``) with a word."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows, found = [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                start = 0
                for unit, part in enumerate((text or "").split(separator)):
                    words = _WORD.findall(part.lower())
                    if words:
                        rows.append(row)
                        found.append((unit, start, start + len(part), len(words), hashlib.md5(" ".join(words).encode()).digest()))
                    start += len(part) + len(separator)
            at = pa.array(rows, pa.int64())
            columns = list(zip(*found)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())],
                                             names=["doc_id", "text_key", "unit", "start", "end", "n_words", "digest"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_key", T.LongType()), *[T.StructField(c, T.LongType()) for c in ("unit", "start", "end", "n_words")], T.StructField("digest", T.BinaryType())])
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(batches, schema)


def repeated_whole_units(docs: DataFrame, separator: str = "\n") -> DataFrame:
    """doc_id, text_key, start, end, n_words and first_doc_id of every line or paragraph, of any length, that stands
    earlier (by doc_id, nulls first, then a hash of the text, then its place): all but the earliest one."""
    table = written(whole_units(docs, separator), "whole-units")
    rank = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "text_key", "unit")
    known = table.groupBy("digest").agg(F.min(rank).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    known = written(known.select("digest", F.col("least.doc_id").alias("first_doc_id"), F.col("least.text_key").alias("first_key"), F.col("least.unit").alias("first_unit")), "repeated-whole-units")
    earliest = F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("text_key") == F.col("first_key")) & (F.col("unit") == F.col("first_unit"))
    return table.join(known, "digest").filter(~earliest).select("doc_id", "text_key", "start", "end", "n_words", "first_doc_id").distinct()


def _merged_spans(spans: DataFrame) -> DataFrame:
    """Spans of a text that touch or overlap, as one."""
    before = Window.partitionBy("doc_id", "text_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc_id", "text_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True))
    islands = spans.withColumn("opens", opens.cast("int")).withColumn("island", F.sum("opens").over(upto))
    return islands.groupBy("doc_id", "text_key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS, whole: Sequence[str] = ()) -> DataFrame:
    """``docs`` with the runs cut out of the text, and (removed) their original offsets. ``whole`` lists separators of
    units (lines, paragraphs) that are also cut wherever they stand whole a second time, however short."""
    spans = _runs(docs, least_words).select("doc_id", "text_key", "start", "end")
    for separator in whole:
        spans = spans.unionByName(repeated_whole_units(docs, separator).select("doc_id", "text_key", "start", "end"))
    spans = _merged_spans(spans) if whole else spans
    runs = spans.groupBy(F.col("doc_id").alias("run_id"), F.col("text_key").alias("run_key")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = docs.join(runs, docs["doc_id"].eqNullSafe(runs["run_id"]) & (F.xxhash64(docs["text"]) == runs["run_key"]), "left")
    spans, whole = runs["spans"], docs["text"]
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.char_length(whole).cast("long")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(whole, (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(spans.isNull(), whole).otherwise(F.concat_ws("", kept))
    columns = [text.alias(c) if c == "text" else docs[c] for c in docs.columns]
    return joined.select(*columns, spans.alias(free_name(docs, "removed")))
