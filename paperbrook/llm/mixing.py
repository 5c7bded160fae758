"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperbrook.llm.common import ROW, union_all, with_rows, written

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.0, 3
BLOCK_ROWS, FANOUT = 4096, 64
EPSILON = 1e-9


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source, source_size, target, n_rows), one row for each source.

    Sources in the order of their code points, null last, get the weights in turn. The share of all words is dealt
    by weight; a target stops at ``most`` times its source, and what it leaves is dealt to the rest by weight. In
    the order of most-by-weight the full sources come first, so one running sum finds where they end. The windows
    run over one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    sums = written(sums, "sources")
    in_order = W.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    turn = F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    capped = sums.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
    by_fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_fill.rowsBetween(0, W.unboundedFollowing))
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * share
    level = (budget - before) / after
    filled = capped.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    # The first source that does not fill up sees the final level; later ones see no lower one.
    final = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", final.getField("level") * F.col("weight")))
    return filled.select("source", "source_size", target.alias("target"), "n_rows")


def settle(rows: list[dict], last: bool) -> None:
    """Pivotal rounding of the fractions x of the rows in place; at most one stays fractional, none if ``last``.

    Two fractional rows exchange words, one up and the other down, until one of them is 0 or 1; the direction is
    drawn so that each expectation stays. The words of both together never change. The last open row of a source
    goes to the nearer side.
    """
    open_row = None
    for row in rows:
        if open_row is None:
            open_row = row
        else:
            a, b = open_row, row
            ratio = a["size"] / b["size"]
            up = min(1 - a["x"], b["x"] / ratio)
            down = min(a["x"], (1 - b["x"]) / ratio)
            step = up if row["u"] * (up + down) < down else -down
            a["x"] += step
            b["x"] -= step * ratio
            for each in (a, b):
                if each["x"] < EPSILON or each["x"] > 1 - EPSILON:
                    each["x"] = float(round(each["x"]))
            open_row = next((each for each in (a, b) if 0 < each["x"] < 1), None)
    if last and open_row is not None:
        open_row["x"] = float(open_row["x"] >= 0.5)


def round_blocks(open_rows: DataFrame, last: bool) -> DataFrame:
    names = open_rows.columns

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["u"], r["doc_id"] is None, r["doc_id"] or 0, r["size"], *(r[c] for c in ROW)))
        settle(rows, last)
        return pa.Table.from_pylist(rows, schema=group.schema).select(names)

    return open_rows.groupBy("source", "block").applyInArrow(run, open_rows.schema)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
    block_rows: int = BLOCK_ROWS, fanout: int = FANOUT,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every row of ``docs`` (doc_id, text, source).

    A document's expected copies are its source's target over its source's words, at most ``most``. Whole copies
    are sure; fractions are rounded in blocks of about ``block_rows`` rows of a source, dealt by a hash of the id and
    the row's number in its file, and each block passes on one open row at most, ``fanout`` blocks meeting in one of the next level until a
    source has one. So a source misses its target by half a document at most, and no task holds more than a block.
    Choices hang on hashes of ids and row numbers, so reruns agree, and rows without an id or of one id are dealt out
    like any others.

    Null texts have size 0. Rows without words are rounded by a hash of their own, for they move no words; rows of
    a null source are a source of their own. Repeated rows count each; null ids are allowed. Other columns are
    not read. Rows that have keys (see :func:`with_rows`) keep them. One row per source is sorted in one place: sources are
    to be few, as names of collections are.
    """
    keyed = ROW[0] in docs.columns
    given = docs if keyed else with_rows(docs)
    given = given.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), *ROW)
    sized = written(given, "sizes")
    targets = written(source_targets(sized, weights, share, most), "targets").withColumnRenamed("source", "of")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(expected + EPSILON)
    fraction = F.greatest(expected - whole, F.lit(0.0))
    parts = F.ceil(F.col("n_rows") / F.lit(block_rows))
    rows = joined.select(
        "doc_id", *ROW, "source", "size", "source_size", "target", whole.cast("bigint").alias("whole"),
        F.when(fraction < EPSILON, 0.0).otherwise(fraction).alias("x"), draw(0).alias("u"),
        F.pmod(F.xxhash64("doc_id", ROW[1], F.lit("block")), parts).cast("bigint").alias("block"),
    )
    moving = (F.col("x") > 0) & (F.col("size") > 0)
    still = rows.where(~moving).withColumn("x", (F.col("u") < F.col("x")).cast("double"))
    most_rows = targets.agg(F.max("n_rows")).first()[0] or 0
    levels = max(1, 1 + math.ceil(math.log(max(1, math.ceil(most_rows / block_rows)), fanout)))
    settled, left = [still], rows.where(moving)
    for level in range(levels):
        last = level == levels - 1
        done = written(round_blocks(left, last), "rounded")
        settled.append(done.where("x = 0 or x = 1"))
        left = done.where("x > 0 and x < 1").withColumn("u", draw(level + 1))
        left = left.withColumn("block", F.floor(F.col("block") / fanout))
    copies = (F.col("whole") + F.col("x")).cast("bigint")
    kept = ["doc_id", "source", "size", "source_size", "target", copies.alias("copies"), *(ROW if keyed else [])]
    return union_all(settled).select(kept)


def draw(level: int) -> Column:
    """A number in [0, 1) from the hash of the row."""
    return F.pmod(F.xxhash64("doc_id", "size", ROW[1], F.lit(level)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns as they are; each row by its own copies.

    Nearly every row has a copy, so the decisions are as many as the rows: both meet by a merge at every size, which
    moves each text once.
    """
    rows = with_rows(docs)
    copies = written(mix(rows).where("copies > 0").select(*ROW, "copies"), "copies")
    packed = rows.select(F.struct(*docs.columns).alias("given"), *ROW)
    taken = packed.join(copies.hint("merge"), ROW)
    return taken.select("given", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("given.*")
