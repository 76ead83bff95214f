"""N-gram Jaccard join: documents whose shingle sets reach a similarity, and their components.

A document's set holds the 64-bit hashes of its distinct n-word shingles. How the join is spread:

1. Equal sets are one class (a 64-bit digest), so copies cost nothing afterwards.
2. Exact blocking: two sets can only reach the threshold if they share one of their first
   ``size - ceil(threshold * size) + 1`` hashes in any fixed global order. The order here puts
   shingles that occur often (found by counting inside batches and adding up; at most ``FREQUENT``
   are kept, as a bitmap of fixed size) behind all others, then goes by hash. The order changes only
   the cost, never the result, so an approximate count is enough, and passages that very many
   documents share make no large blocks.
3. Blocks with two classes or more are joined by signature trees (signature_trees.py): nodes with
   ORed bitmaps and size ranges, and a dual traversal that prunes by the greatest possible overlap.
   Blocks over ``CELL`` classes are split into cells of pairs of chunks, so no task gets a hot block.
4. Candidates are checked exactly by intersecting the two sets, which are made again from the texts of
   the candidates alone. The first round checks a spanning forest of the candidates; its links merge
   classes. The second round takes the blocks that left candidates out, now with the hashes, checks
   those between different components inside the task, and returns only links that connect two
   components. So rows grow with the members of a group of near copies, not with its pairs, pairs that
   links have connected are not checked, and no link between components is lost.

Defined results: null or wordless texts have an empty set and are linked with nothing; texts of
fewer words than a shingle have the whole sequence as their one shingle; a component's id is its
least doc_id (null only if all are null); repeated rows are in the component of their text; empty
tables give empty results. Hash collisions (2**-64 a pair of sets or shingles) are not told apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlab.llm import bytescan as scan
from sevlab.llm import signature_trees
from sevlab.llm.common import free_name, written
from sevlab.llm.components import components

#: At most so many shingles are put last in the global order; and the bits of their bitmap.
FREQUENT, FREQUENT_BITS = 1 << 20, 1 << 24
#: A shingle counts as often in a batch from so many documents of it (two at least).
OFTEN = 2
#: Classes of a block that one task joins with each other; larger blocks are split.
CELL = 2000
#: Hashes that are counted at once.
COUNTED = 1 << 21
#: Rows of a batch whose sets are made and sent at once.
SENT_ROWS = 512
#: Rows whose pairs are told apart at once (a bit for each pair); a larger cell is taken alone.
TABLE_ROWS = 8 * CELL


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; an empty text has none."""
    for first, end, data, offsets in scan.chunks(column):
        spans = scan.words(data, offsets)
        hashes = scan.word_hashes(data, spans, scan.ASCII_LOWER)
        found, begin = scan.windows(hashes, spans.first, n)
        for i in range(end - first):
            if begin[i + 1] > begin[i]:
                yield np.unique(found[begin[i]:begin[i + 1]])
            else:
                own = hashes[spans.first[i]:spans.first[i + 1]]
                yield scan.mix((own * scan.WINDOW_FACTOR[:len(own)]).sum(keepdims=True) + np.uint64(len(own))) if len(own) else own


def digest(hashes: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    with np.errstate(over="ignore"):
        h = scan.mix(scan.mix(hashes).sum(keepdims=True) + np.uint64(len(hashes)) * scan.WINDOW_FACTOR[1])
    return int(h.view(np.int64)[0])


def prefix_length(size: int, percent: int) -> int:
    return size - (percent * size + 99) // 100 + 1


def _arrow(df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], dict[str, list]], sent: int | None = None) -> DataFrame:
    """What ``rows`` makes of each batch, or of each run of ``sent`` rows of it."""
    kind = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        for batch in it:
            for at in range(0, batch.num_rows, sent or max(1, batch.num_rows)):
                yield pa.RecordBatch.from_pydict(rows(batch.slice(at, sent)), schema=arrow)

    return df.mapInArrow(batches, kind)


def _repeated(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that so many of the sets hold, and how many; empties the list."""
    hashes = np.concatenate([np.zeros(0, np.uint64), *held])
    held.clear()
    hashes.sort()
    same = np.zeros(len(hashes) + 1, bool)  # whether a hash equals the one before it
    same[1:-1] = hashes[1:] == hashes[:-1]
    starts, ends = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
    counts = ends - starts + 1
    at = counts >= OFTEN
    return hashes[starts[at]], counts[at]


def frequent_shingles(docs: DataFrame, n: int) -> np.ndarray:
    """A bitmap over the low bits of the hashes that occur most often."""

    def often(batch: pa.RecordBatch) -> dict:
        found, held, size = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], [], 0
        for hashes in shingle_sets(batch.column(0), n):
            held.append(hashes)
            size += len(hashes)
            if size >= COUNTED:
                found.append(_repeated(held))
                size = 0
        found.append(_repeated(held))
        values, counts = (np.concatenate(x) for x in zip(*found))
        return {"h": values.view(np.int64), "n": counts}

    counts = written(_arrow(docs.select("text"), "h long, n long", often).groupBy("h").agg(F.sum("n").alias("n")), "often")
    sizes = dict(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1))).collect())
    total, least = 0, 64
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > FREQUENT:
            break
        least = k
    bits = np.zeros(FREQUENT_BITS, bool)
    for row in counts.filter(F.floor(F.log2("n")) >= least).select((F.col("h").bitwiseAND(FREQUENT_BITS - 1)).alias("b")).distinct().toLocalIterator():
        bits[row.b] = True
    return np.packbits(bits, bitorder="little")


def set_table(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """doc_id, text_hash, n_shingles, set (the digest), prefix and bitmap of each document."""
    mask = np.uint64(FREQUENT_BITS - 1)

    def rows(batch: pa.RecordBatch) -> dict:
        sizes, digests, prefixes, bitmaps = [], [], [], []
        for hashes in shingle_sets(batch.column(1), n):
            sizes.append(len(hashes))
            digests.append(digest(hashes) if len(hashes) else None)
            bit = hashes & mask
            last = (frequent[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            ordered = np.concatenate([hashes[~last], hashes[last]])
            bitmaps.append(signature_trees.bitmap(hashes))
            prefixes.append(ordered[:prefix_length(len(hashes), percent)].view(np.int64) if len(hashes) else np.zeros(0, np.int64))
        return {"doc_id": batch.column(0), "text_hash": batch.column(2), "n_shingles": sizes, "set": digests, "prefix": prefixes, "bits": bitmaps}

    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return _arrow(hashed, f"doc_id {kind}, text_hash long, n_shingles long, set long, prefix array<long>, bits binary", rows, SENT_ROWS)


def full_sets(docs: DataFrame, n: int) -> DataFrame:
    """set (the digest) and hashes of each text, a row for each different set."""

    def rows(batch: pa.RecordBatch) -> dict:
        sets = [h for h in shingle_sets(batch.column(0), n) if len(h)]
        return {"set": [digest(h) for h in sets], "hashes": [h.view(np.int64) for h in sets]}

    return _arrow(docs.select("text"), "set long, hashes array<long>", rows, SENT_ROWS).dropDuplicates(["set"])


class _Pairs:
    """Which pairs of n classes have been seen, a bit for each."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.bits = np.zeros(n * n // 8 + 1, np.uint8)

    def first_seen(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Positions of the pairs that come up for the first time."""
        key, at = np.unique(np.minimum(a, b) * self.n + np.maximum(a, b), return_index=True)
        byte, bit = key >> 3, np.uint8(1) << (key & 7).astype(np.uint8)
        new = self.bits[byte] & bit == 0
        np.bitwise_or.at(self.bits, byte[new], bit[new])
        return np.sort(at[new])


def _spanning(parent: dict[int, int], i: np.ndarray, j: np.ndarray, linked: Callable[[int], bool] = lambda k: True) -> np.ndarray:
    """Positions of the linked pairs that join two trees of the forest in ``parent``, which they grow."""
    keep = []

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        if (x := find(x)) != (y := find(y)) and linked(k):
            parent[x] = y
            keep.append(k)
    return np.array(keep, np.int64)


def _block_candidates(percent: int, forest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Joins the cells of a partition that is sorted by cell; a cell that goes on in the next batch waits for it.
    With ``forest`` a spanning forest of the candidates (and the blocks that have more), else one of the
    links: candidates are checked by their hashes, but for those that links have connected already."""
    columns = ("h", "low", "high", "set", "root", "chunk", "size")

    def candidates(table: pa.Table) -> pa.RecordBatch:
        h, low, high, sets, roots, chunk, sizes = (table.column(c).to_numpy() for c in columns)
        change = np.flatnonzero((np.diff(h) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
        groups = np.diff(np.concatenate([[0], change, [len(h)]]))
        bitmaps = signature_trees.Bitmaps(table.column("bits").to_pylist(), sizes.astype(np.int64))
        if not forest:
            hashes = table.column("hashes").chunk(0)
            offsets, values = hashes.offsets.to_numpy(), hashes.values.to_numpy()

        def reach(x: int, y: int) -> bool:
            a, b = (values[offsets[r]:offsets[r + 1]] for r in (x, y))
            shared = len(np.intersect1d(a, b, assume_unique=True))
            return 100 * shared >= percent * (len(a) + len(b) - shared)

        classes, place = np.unique(sets, return_inverse=True)
        seen, parent = _Pairs(len(classes)), {}
        found, again = [np.zeros((2, 0), np.int64)], [np.zeros(0, np.int64)]
        for i, j in bitmaps.group_pieces(groups, percent):
            use = (roots[i] != roots[j]) & ((low[i] == high[i]) | (chunk[i] != chunk[j]))
            i, j = i[use], j[use]
            # Near copies meet in many blocks: each pair counts once, in its first block here.
            once = seen.first_seen(place[i], place[j])
            i, j = i[once], j[once]
            if forest:
                kept = _spanning(parent, roots[i], roots[j])
                left_out = np.ones(len(i), bool)
                left_out[kept] = False
                again.append(np.unique(h[i[left_out]]))
            else:
                kept = _spanning(parent, roots[i], roots[j], lambda k, i=i, j=j: reach(i[k], j[k]))
            found.append(np.stack([i[kept], j[kept]]))
        (i, j), again = np.concatenate(found, axis=1), np.unique(np.concatenate(again))
        known = np.concatenate([np.zeros(len(i), bool), np.ones(len(again), bool)])
        side = lambda x: pa.array(np.concatenate([sets[x], again]), mask=known)
        return pa.RecordBatch.from_arrays([side(i), side(j), pa.array(np.concatenate([sets[i], again]), mask=~known)], names=["a", "b", "again"])

    def pieces(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Runs of whole cells of at most ``TABLE_ROWS`` rows."""
        table = table.combine_chunks()
        h, low, high = (table.column(c).to_numpy() for c in columns[:3])
        ends = np.append(np.flatnonzero((np.diff(h) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1, len(h))
        at = 0
        while at < len(h):
            k = max(np.searchsorted(ends, at, "right"), np.searchsorted(ends, at + TABLE_ROWS, "right") - 1)
            yield candidates(table.slice(at, ends[k] - at))
            at = ends[k]

    def join(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in it:
            if not batch.num_rows:
                continue
            key = [batch.column(c).to_numpy() for c in columns[:3]]
            last = np.logical_and.reduce([k == k[-1] for k in key])
            cut = batch.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
            if not cut and (not held or all(held[-1].column(c)[-1].as_py() == k[0] for c, k in zip(columns[:3], key, strict=True))):
                held.append(batch)
                continue
            done = pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
            if done.num_rows:
                yield from pieces(done)
        if held:
            yield from pieces(pa.Table.from_batches(held))

    return join


def _candidates(postings: DataFrame, roots: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes that share a block and pass the trees; a spanning forest of them, and (again) the blocks
    that have more. With ``roots`` and the hashes in ``sets``, links between different components
    that connect all that can be connected. ``postings``: h, set."""
    forest = roots is None
    known = postings.withColumn("root", F.col("set")) if forest else postings.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    blocks = known.groupBy("h").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.min("set").alias("lead"), F.count(F.lit(1)).alias("n"))
    blocks = blocks.filter(F.col("least") != F.col("most")).select("h", "lead", F.ceil(F.col("n") / CELL).cast("int").alias("chunks"))
    rows = known.join(blocks, "h").withColumn("chunk", F.pmod(F.xxhash64("set"), F.col("chunks")).cast("int"))
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "h", "lead", "set", "root", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    key = ["lead", "low", "high"]  # the blocks of one group of near copies have the same least set
    sorted_cells = cells.join(sets, "set").repartition(*key).sortWithinPartitions(*key, "h")
    return sorted_cells.select("h", "low", "high", "root", "chunk", *sets.columns).mapInArrow(_block_candidates(percent, forest), "a long, b long, again long").distinct()


def _different_blocks(postings: DataFrame) -> DataFrame:
    """One block of all those that hold the same sets (told by their number and two sums of digests):
    near copies share many shingles, and each pair need be looked at once."""
    mixed = F.xxhash64("set")
    blocks = postings.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum(mixed.bitwiseAND(2**40 - 1)).alias("x"), F.sum(F.shiftright(mixed, 24)).alias("y"))
    return postings.join(blocks.groupBy("n", "x", "y").agg(F.min("h").alias("h")).select("h"), "h")


def _links(pairs: DataFrame, sets: DataFrame, hashes: DataFrame, percent: int) -> DataFrame:
    """The pairs that do reach the threshold."""
    whole = hashes.join(sets.select("set", "size"), "set")
    side = lambda c: whole.select(F.col("set").alias(c), F.col("size").alias(f"size_{c}"), F.col("hashes").alias(f"hashes_{c}"))
    shared = F.size(F.array_intersect("hashes_a", "hashes_b"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", (F.col("size_a") + F.col("size_b")).alias("sizes"), shared.alias("shared"))
    return both.filter(100 * F.col("shared") >= percent * (F.col("sizes") - F.col("shared"))).select("a", "b")


def component_table(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and root (one number a component, null for an empty
    set), a row for each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    table = written(set_table(docs, n, percent, frequent_shingles(docs, n)), "sets")
    spread = table.select("set", F.explode("prefix").alias("h"))
    shared = spread.groupBy("h").agg(F.min("set").alias("least"), F.max("set").alias("most")).filter(F.col("least") != F.col("most")).select("h")
    common = written(spread.join(shared, "h").distinct(), "common")  # blocks with two classes or more
    postings = written(_different_blocks(common), "postings")
    signatures = table.select("set", F.col("n_shingles").alias("size"), "bits").join(postings.select("set").distinct(), "set", "left_semi")
    sets = written(signatures.dropDuplicates(["set"]), "signatures")

    found = written(_candidates(postings, None, sets, percent), "candidates")
    pairs = found.filter("again IS NULL").select("a", "b")
    used = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    ids = table.join(used, "set", "left_semi").groupBy("set").agg(F.min("doc_id").alias("id")).select("id").distinct()
    hashes = written(full_sets(docs.join(ids, docs["doc_id"].eqNullSafe(F.col("id")), "left_semi"), n).join(used, "set", "left_semi"), "full-sets")
    first = written(_links(pairs, sets, hashes, percent), "links")
    roots = written(components(first).toDF("set", "root"), "roots")
    left_out = postings.join(found.filter("again IS NOT NULL").select(F.col("again").alias("h")).distinct(), "h", "left_semi")
    second = written(_candidates(left_out, roots, sets.join(hashes, "set"), percent).select("a", "b"), "links")
    roots = written(components(first.unionByName(second)).toDF("set", "root"), "roots")

    least = table.filter("n_shingles > 0").groupBy("set").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    named = rooted.select("set", "root").join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    columns = ["doc_id", "text_hash", "n_shingles", "component_id", "root"]
    alone = table.filter("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "root": F.lit(None).cast("long")})
    return table.filter("n_shingles > 0").join(named, "set").select(*columns).unionByName(alone.select(*columns))


def join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return component_table(docs, n, percent).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the least doc_id (nulls
    last, then the least text hash) stays, one of them if it is repeated, and so does every document
    without words. Only the rows that go are joined to the texts."""
    rows = written(component_table(docs, n, percent).filter("root IS NOT NULL").select("root", "doc_id", "text_hash"), "members")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    best = rows.groupBy("root").agg(F.min(rank).alias("best"))
    members = rows.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).join(best, "root")
    chosen = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    gone = written(members.filter(~chosen | (F.col("n") > 1)).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), chosen.alias("again")), "gone")
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_hash"])
    again = gone.filter("again").select(F.col("gone_id").alias("again_id"), F.col("gone_hash").alias("again_hash"))
    repeated = docs.join(again, docs["doc_id"].eqNullSafe(again["again_id"]) & (F.xxhash64(docs["text"]) == again["again_hash"]), "left_semi")
    one = repeated.withColumn(h := free_name(docs, "text_hash"), F.xxhash64(docs["text"])).dropDuplicates(["doc_id", h]).drop(h)
    return docs.join(gone, same, "left_anti").unionByName(one)
