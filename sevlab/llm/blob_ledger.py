"""Secret scans with an incremental ledger of content-addressed blobs (DataFrame functions only).

Every version of every path is named by the SHA-256 of its text. The ledger, two Parquet folders under
one shared path, knows which (blob, rule, rule version) pairs were scanned and what was found. A scan
takes the blobs with an unseen pair, reads one copy of each, runs only the missing rules, appends the
findings and then the pairs (a run that breaks off between the two is repeated without harm, because
findings are read as a set), and joins all findings back to all paths.

Matches are found without Python: ``split`` gives the text between matches, ``regexp_extract_all`` the
matches, and running sums of their lengths the code-point offsets. Texts without a match of a rule
stop at ``rlike``.

Skew: blobs are reduced to one path each by a map-side aggregation of ids; the joins are plain equi
joins, whose hot keys adaptive execution splits; a window holds the matches of one rule in one text.

Defined results: a null text is the empty blob, which has no finding; paths may be null or repeated, and
repeated rows get the same findings; empty tables give empty results and an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sevlab.llm.common import written
from sevlab.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """``pattern`` must not match the empty string. A match counts if its group has ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


#: The base patterns and further well-known token forms, in the order of their kinds.
RULES = (
    Rule("assign", r"""(?:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 6, 1, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", 24, base=True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
FINDING = "blob string, rule string, start long, end long"
PAIR = "blob string, rule string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A ledger folder, empty if there is none yet."""
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.range(0).select(
        *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in schema.split(", "))])


def _matches(text: Column, rule: Rule) -> Column:
    """(rule, pos, gap, length, counts) of every match: the characters since the one before, and its own."""
    gaps = F.split(text, rule.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    group = (lambda h: F.regexp_extract(h, rule.pattern, rule.group)) if rule.group else (lambda h: h)
    row = lambda h, i: F.struct(F.lit(rule.key).alias("rule"), i.alias("pos"), F.char_length(F.get(gaps, i)).cast("long").alias("gap"),
                                F.char_length(h).cast("long").alias("length"), (F.char_length(group(h)) >= rule.least).alias("counts"))
    return F.transform(hits, row)


def find(texts: DataFrame, rules: tuple[Rule, ...] = RULES, missing: str | None = None) -> DataFrame:
    """FINDING rows of a table (blob, text and, if named, an array of the rule keys to run)."""
    empty = "array<struct<rule:string,pos:int,gap:bigint,length:bigint,counts:boolean>>"
    wanted = lambda r: F.array_contains(missing, r.key) if missing else F.lit(True)
    found = [F.when(wanted(r) & F.col("text").rlike(r.pattern), _matches(F.col("text"), r)).otherwise(F.array().cast(empty)) for r in rules]
    hits = texts.select("blob", F.explode(F.concat(*found)).alias("m")).select("blob", "m.*").distinct()
    so_far = Window.partitionBy("blob", "rule").orderBy("pos")
    end = F.sum(F.col("gap") + F.col("length")).over(so_far)
    return hits.withColumn("end", end).filter("counts").select("blob", "rule", (F.col("end") - F.col("length")).alias("start"), "end")


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's path and ``spans``, an array of (start, rank of its rule, end, kind) in that order;
    null if nothing was found. The ledger gains the pairs that were unseen."""
    spark = versions.sparkSession
    content = F.coalesce(versions[text], F.lit(""))
    named = versions.select(versions[path].alias("path"), content.alias("text"), F.sha2(content, 256).alias("blob"))
    paths = written(named.select("path", "blob"), "versions")
    pairs = _table(spark, f"{ledger}/pairs", PAIR).distinct()
    seen = pairs.join(F.broadcast(spark.range(1).select(F.explode(F.array(*[F.lit(r.key) for r in rules])).alias("rule"))), "rule").groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    blobs = paths.groupBy("blob").agg(F.min("path").alias("one_path"))
    due = F.array_except(F.array(*[F.lit(r.key) for r in rules]), F.coalesce("seen", F.array().cast("array<string>")))
    unseen = written(blobs.join(seen, "blob", "left").select(F.col("blob").alias("one_blob"), "one_path", due.alias("missing")).filter(F.size("missing") > 0), "unseen")
    same = named["path"].eqNullSafe(F.col("one_path")) & (named["blob"] == F.col("one_blob"))
    find(named.join(unseen, same), rules, "missing").write.mode("append").parquet(f"{ledger}/findings")
    unseen.select(F.col("one_blob").alias("blob"), F.explode("missing").alias("rule")).write.mode("append").parquet(f"{ledger}/pairs")
    return paths.join(spans(_table(spark, f"{ledger}/findings", FINDING), rules), "blob", "left").select("path", "blob", "spans")


def spans(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and its sorted spans under the current rule versions."""
    rank = F.coalesce(*[F.when(F.col("rule") == r.key, F.lit(i)) for i, r in enumerate(rules)])
    kind = F.substring_index("rule", ":", 1)
    known = findings.select("blob", F.struct("start", rank.alias("rank"), "end", kind.alias("kind")).alias("span")).filter(F.col("span.rank").isNotNull())
    return known.distinct().groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def listed(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(found, one))


def secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """doc_id, the counts of the base kinds, the digest of the base spans, and all spans."""
    found = scan(docs.select("doc_id", "text"), ledger or scratch_path(docs.sparkSession, "ledger"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    base_ranks = [i for i, r in enumerate(RULES) if r.base]
    rows = found.select("path", F.coalesce("spans", none).alias("spans"))
    base = F.filter("spans", lambda s: s["rank"].isin(base_ranks))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(F.col("path").alias("doc_id"), *[count(r.kind) for r in RULES if r.base], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
