"""Temperature mixing of sources to a target entropy or repetition limit (DataFrame functions only).

A source's weight is its token share to the power ``alpha``, normalised. ``alpha`` is the least exponent in
[0, 1] for which the weights' entropy is at most the target (a given way from the natural entropy to
the uniform one) and no source is repeated more often than the limit; both hold at 1, so it is found by
bisection. One aggregation evaluates the ``2**LEVELS - 1`` midpoints that the next ``LEVELS`` halvings can
ask for, so a run of bisections costs one job over the table of sources, which may be large.

The budget is in tokens; by default it is the least one under which the largest source is used whole, so
that no document is lost. A source's quota is its weight times the budget. It is realised as whole
epochs and a part of one, each epoch a permutation of the source by a hash of (seed, epoch, doc_id):
documents whose hash is at most the source's cut are in the last part. The mixture is cut into blocks of
about ``BLOCK_TOKENS`` tokens, in each of which every source has its share; inside a block, ``draw`` gives the order.

Skew: token counts are reduced to one row a source by a map-side combine. Running sums are taken
inside buckets of the hash (as many as the data needs; the result doesn't depend on it) plus the sums
of the buckets before, so no source is gathered or sorted by one task.

Defined results: tokens are words between ASCII white space (null text: none); a null source is a source
of its own; a source without tokens has weight 0 and its rows stay once, in block 0; rows with one doc_id in a source
share a hash and are taken together; empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sevlab.llm.common import key_of, written

ENTROPY_GAIN = 0.5
MAX_REPEATS = 4.0
BLOCK_TOKENS = 1_000_000
SEED = 17
LEVELS, JOBS = 6, 5
BUCKET_ROWS = 20_000
HASH_BITS = 60


def hashed(epoch: Column, doc_id: Column, seed: int = SEED) -> Column:
    """The first 60 bits of an MD5 digest."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def token_table(docs: DataFrame) -> DataFrame:
    """doc_id, source and n_tokens of each row, written once."""
    n = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return written(docs.select("doc_id", "source", n.alias("n_tokens")), "tokens")


def exponent(sources: DataFrame, gain: float = ENTROPY_GAIN, max_repeats: float = MAX_REPEATS) -> float:
    """alpha, to six decimals. ``sources``: share, the positive token shares. Only sums come to the driver."""
    x = F.log("share")
    natural, n, least, most = sources.agg(-F.sum(F.col("share") * x), F.count(F.lit(1)), F.min("share"), F.max("share")).first()
    if n < 2:
        return 1.0
    target = natural + gain * (math.log(n) - natural)
    spread = math.log(most / least)  # under the default budget the smallest source is repeated exp((1 - alpha) * spread) times
    low, high = 0.0, 1.0
    for _ in range(JOBS):
        start, step = low, (high - low) / 2**LEVELS
        power = [F.exp(F.lit(start + k * step) * x) for k in range(1, 2**LEVELS)]
        sums = sources.agg(*[F.sum(p).alias(f"z{k}") for k, p in enumerate(power, 1)], *[F.sum(x * p).alias(f"s{k}") for k, p in enumerate(power, 1)]).first()
        left, right = 0, 2**LEVELS
        while right - left > 1:
            k = (left + right) // 2
            alpha, z, s = start + k * step, sums[f"z{k}"], sums[f"s{k}"]
            meets = math.log(z) - alpha * s / z <= target and (1 - alpha) * spread <= math.log(max_repeats)
            left, right = (left, k) if meets else (k, right)
        low, high = start + left * step, start + right * step
    return round(high, 6)


def _buckets(rows: DataFrame) -> int:
    """A power of two of buckets with at most about BUCKET_ROWS rows each."""
    return 1 << max(0, (rows.count() // BUCKET_ROWS)).bit_length()


def _running(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``rows`` with ``before``: the tokens of all rows with the same keys and a smaller hash ``h``."""
    bucket = F.floor(F.col("h") / F.lit((1 << HASH_BITS) // buckets)).cast("int")
    placed = rows.withColumn("bucket", bucket)
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*keys, "bucket").agg(F.sum("n_tokens").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy(*keys, "bucket").orderBy("h").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(sums, [*keys, "bucket"]).withColumn("before", F.col("offset") + inside).drop("offset", "bucket")


def plan(table: DataFrame, gain: float = ENTROPY_GAIN, max_repeats: float = MAX_REPEATS, budget: int | None = None) -> DataFrame:
    """source_key, tokens, weight, quota, epochs (whole ones), cut (the last hash of the next epoch that is
    used; -1: none) and blocks, a row for each source."""
    key = key_of(F.col("source")).alias("source_key")
    sums = written(table.groupBy(key).agg(F.sum("n_tokens").alias("tokens")), "source-tokens")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    shares = sums.filter("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    alpha = exponent(shares, gain, max_repeats)
    powers = shares.withColumn("power", F.pow("share", F.lit(alpha)))
    norm, most = powers.agg(F.sum("power"), F.max(F.col("share") / F.col("power"))).first()
    norm = norm or 1.0
    budget = budget if budget is not None else math.ceil(round((most or 0.0) * norm * total, 3))
    blocks = max(1, -(-budget // BLOCK_TOKENS))
    quota = F.floor(F.round(F.col("power") / F.lit(norm) * F.lit(float(budget)), 3)).cast("long")
    found = powers.select("source_key", "tokens", F.round(F.col("power") / F.lit(norm), 9).alias("weight"), quota.alias("quota"))
    found = found.withColumn("epochs", F.floor(F.col("quota") / F.col("tokens")).cast("int")).withColumn("part", F.col("quota") - F.col("epochs") * F.col("tokens"))
    found = written(found.unionByName(sums.filter("tokens = 0").select("source_key", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("quota"), F.lit(1).alias("epochs"), F.lit(0).cast("long").alias("part"))), "quotas")
    # Only the bucket in which a source's last epoch ends needs running sums.
    buckets = _buckets(table)
    size = F.lit((1 << HASH_BITS) // buckets)
    last = table.select(key, "doc_id", "n_tokens").join(found.filter("part > 0").select("source_key", "epochs", "part"), "source_key")
    last = last.select("source_key", "n_tokens", "part", hashed(F.col("epochs"), F.col("doc_id")).alias("h")).withColumn("bucket", F.floor(F.col("h") / size).cast("int"))
    over = Window.partitionBy("source_key").orderBy("bucket")
    ends = last.groupBy("source_key", "bucket", "part").agg(F.sum("n_tokens").alias("n")).withColumn("upto", F.sum("n").over(over))
    ends = ends.filter((F.col("upto") >= F.col("part")) & (F.col("upto") - F.col("n") < F.col("part"))).select("source_key", "bucket", (F.col("upto") - F.col("n")).alias("offset"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("source_key", "bucket").orderBy("h").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = last.join(ends, ["source_key", "bucket"]).withColumn("before", F.col("offset") + inside).filter(F.col("before") < F.col("part")).groupBy("source_key").agg(F.max("h").alias("cut"))
    return written(found.join(cuts, "source_key", "left").select("source_key", "tokens", "weight", "quota", "epochs", F.coalesce("cut", F.lit(-1).cast("long")).alias("cut"), F.lit(blocks).alias("blocks")), "mix-plan")


def _copies(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` (source_key, doc_id and more) once for each epoch that uses them."""
    joined = rows.join(sources.select("source_key", "epochs", "cut"), "source_key")
    extra = (hashed(F.col("epochs"), F.col("doc_id")) <= F.col("cut")).cast("int")
    n = F.col("epochs") + extra
    return joined.withColumn("epoch", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")))).drop("epochs", "cut")


def mixture(docs: DataFrame, gain: float = ENTROPY_GAIN, max_repeats: float = MAX_REPEATS, budget: int | None = None) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block and draw of every copy in the mixture: read by block, then draw."""
    table = token_table(docs)
    sources = plan(table, gain, max_repeats, budget)
    rows = _copies(table.withColumn("source_key", key_of(F.col("source"))), sources).withColumn("h", hashed(F.col("epoch"), F.col("doc_id")))
    placed = _running(rows, ["source_key", "epoch"], _buckets(table)).join(sources.select("source_key", "tokens", "quota", "blocks"), "source_key")
    at = (F.col("epoch") * F.col("tokens") + F.col("before")).cast("double")
    block = F.when(F.col("quota") > 0, F.least(F.floor(at / F.col("quota").cast("double") * F.col("blocks").cast("double")).cast("long"), F.col("blocks").cast("long") - 1)).otherwise(F.lit(0).cast("long"))
    draw = hashed(F.concat_ws("/", F.col("epoch").cast("string"), block.cast("string")), F.col("doc_id"))
    return placed.select("doc_id", "source", "n_tokens", "epoch", block.alias("block"), draw.alias("draw"))


def mixed_documents(docs: DataFrame, gain: float = ENTROPY_GAIN, max_repeats: float = MAX_REPEATS, budget: int | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture uses it. A source's cut decides by hash, so no text is
    shuffled."""
    sources = plan(token_table(docs), gain, max_repeats, budget)
    nested = docs.select(key_of(docs["source"]).alias("source_key"), docs["doc_id"].alias("doc_id"), F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    return _copies(nested, sources).select("doc.*")
