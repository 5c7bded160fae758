"""Secrets in texts: fixed patterns, and sliding-window entropy of candidate strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperbrook.llm.common import written

# The three base patterns in the order of their listing (fixed values). A run is always taken whole, so the least
# length of the last two can stand in the pattern; the first takes short values too, which then fail.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
LEAST_ASSIGNED = 12
BASE_KINDS = ("assign", "access", "hex")
# Strings whose entropy is looked at, the classes of characters, and what a window of each must reach (parameters).
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
WINDOW = 20
CLASSES = {"entropy_hex": (r"^[0-9A-Fa-f]+$", 2.9), "entropy_base64": (r"", 3.6)}
# Strings that look random to no one: without a digit or without a letter, UUIDs, place holders, counting and
# repeated signs, data of known formats (fixed values).
ALLOWED = (
    r"^[^0-9]*$", r"^[^A-Za-z]*$", r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)(example|sample|placeholder|changeme|dummy|xxxx|0123456789|1234567890|abcdefgh)",
    r"^(.)\1+$", r"^data[:/]", r"^iVBORw0KGgo",
)
KINDS = (*BASE_KINDS, *CLASSES)


def found(text: Column, pattern: str, kind: str) -> Column:
    """All matches of a pattern in order: kind, characters since the match before, characters matched, the match.

    The gaps come from splitting at the same matches. Texts without a match are searched once.
    """
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    each = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(matches)), matches,
        lambda gap, match: F.struct(
            F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.length(match).alias("n"), match.alias("match")
        ),
    )
    none = F.array().cast("array<struct<kind:string,gap:int,n:int,match:string>>")
    return F.when(text.rlike(pattern), each).otherwise(none)


def plogp(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def entropy_spans(candidates: DataFrame, window: int) -> DataFrame:
    """(row, kind, start, end): runs of windows of candidate strings (row, start, match) above their class's entropy.

    Each character enters the counts of its window once and leaves once. Entering with the c-th of its kind adds
    c log c - (c-1) log (c-1) to the sum of count log count, leaving takes it off again, so the entropy of a window
    of w is log w - sum / w, and all of it is running sums over the characters of one string. Windows above the
    threshold that touch or overlap make one span.
    """
    kind, least = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, (pattern, bits) in reversed(CLASSES.items()):
        same = F.col("match").rlike(pattern)
        kind, least = F.when(same, F.lit(name)).otherwise(kind), F.when(same, F.lit(bits)).otherwise(least)
    usable = candidates
    for pattern in ALLOWED:
        usable = usable.where(~F.col("match").rlike(pattern))
    usable = usable.where(F.length("match") >= window).select(
        "row", "start", kind.alias("kind"), least.alias("least"), F.rtrim(F.col("match"), F.lit("=")).alias("match")
    )
    signs = usable.select("row", "start", "kind", "least", F.posexplode(F.split("match", "")).alias("i", "sign"))
    signs = signs.where("sign <> ''").repartition("row", "start")
    string, same = W.partitionBy("row", "start").orderBy("i"), W.partitionBy("row", "start", "sign").orderBy("i")
    entered = F.count("*").over(same.rangeBetween(-(window - 1), 0))
    leaving = F.count("*").over(same.rangeBetween(0, window - 1))
    counted = signs.withColumn("more", plogp(entered) - plogp(entered - 1))
    counted = counted.withColumn("less", plogp(leaving) - plogp(leaving - 1))
    running = string.rowsBetween(W.unboundedPreceding, 0)
    summed = counted.withColumn("in", F.sum("more").over(running)).withColumn("out", F.sum("less").over(running))
    left = F.coalesce(F.lag("out", window).over(string), F.lit(0.0))
    bits = F.log2(F.lit(float(window))) - (F.col("in") - left) / window
    hot = summed.withColumn("bits", bits).where((F.col("i") >= window - 1) & (F.round("bits", 6) >= F.col("least")))
    apart = F.col("i") - F.coalesce(F.lag("i").over(string), F.lit(-window)) > window
    runs = hot.withColumn("run", F.sum(apart.cast("int")).over(running))
    return runs.groupBy("row", "kind", "start", "run").agg(F.min("i").alias("first"), F.max("i").alias("last")).select(
        "row", "kind", (F.col("start") + F.col("first") - (window - 1)).alias("start"),
        (F.col("start") + F.col("last") + 1).alias("end"),
    )


def scan(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, spans) for every row of ``docs`` (doc_id, text); spans hold kind, start and end in characters.

    Base kinds are leftmost non-overlapping matches of each pattern; ``entropy_*`` kinds are added by the sliding
    window and never take a base span away. Spans are in the order of start, kind as in ``KINDS``, end. Null texts
    are empty and have none. Repeated rows and null ids give a row each. Other columns are not read.

    Positions are running sums of gaps and matches over exploded matches, so a text with very many of them costs
    no more than their number; only matches are shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "candidate": CANDIDATE}
    every = F.concat(*[found(F.col("text"), pattern, kind) for kind, pattern in patterns.items()])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    rows = rows.select("row", "doc_id", F.posexplode_outer(every).alias("at", "m")).select("row", "doc_id", "at", "m.*")
    before = W.partitionBy("row", "kind").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    rows = written(rows, "matches")  # read twice below, and row numbers hold for one reading only
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(before))
    placed = placed.withColumn("start", F.col("end") - F.col("n"))
    value = F.regexp_extract("match", ASSIGN, 2)
    holds = (F.col("kind") != "assign") | (F.length(value) >= LEAST_ASSIGNED)
    entropy = entropy_spans(placed.where("kind = 'candidate'").select("row", "start", "match"), window)
    base = placed.select(
        "row", "doc_id", F.when((F.col("kind") != "candidate") & holds, F.col("kind")).alias("kind"), "start", "end"
    )
    spans = base.unionByName(entropy.withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)))
    order = F.array_position(F.array(*[F.lit(kind) for kind in KINDS]), F.col("kind"))
    span = F.when(F.col("kind").isNotNull(), F.struct("start", order.alias("order"), "end", "kind"))
    grouped = spans.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list(span)).alias("spans"))
    return grouped.select("doc_id", "spans")


def span_list(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
