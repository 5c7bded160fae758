"""A trie of the turns that conversations share at their beginnings, kept as a z-fast trie."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperbrook.llm.common import written

# Conversations borrow the first turns of one in so many.
FAMILY = 20
# Conversations go in by batches, each so many times the one before.
BATCHES, GROWTH = 2, 8
# Ids that agree but for so many bits are joined into one string before the strings of a node meet.
ID_SPAN_BITS = 12
ROOT = b""
STEP = "struct<h:binary,w:bigint>"
RESULT = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)
PATHS = f"conv_id bigint, len int, path array<{STEP}>"


def turn_table(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): the turns of each conversation from 1 on, by turn, nulls first; ties by digest."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("bigint")
    given = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.unhex(F.left(F.sha2(whole, 256), F.lit(32))).alias("digest"), words.alias("words"),
    )
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return written(given.select("conv_id", F.row_number().over(order).alias("pos"), "digest", "words"), "turns")


def rebuilt(turns: DataFrame, heads: Column, family: int) -> DataFrame:
    """(conv_id, part, pos, digest, words): the first ``heads`` turns of the family's first conversation, then a
    conversation's own turns after as many; and a row of part -1 for each conversation."""
    convs = turns.where("pos = 1").select("conv_id", heads.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    first = turns.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    borrowed = convs.join(first, "base").where("pos <= h")
    own = turns.withColumn("h", heads.cast("int")).where("pos > h")
    names = ["conv_id", "part", "pos", "digest", "words"]
    marks = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("words"))
    return marks.union(borrowed.withColumn("part", F.lit(0)).select(names)).union(own.withColumn("part", F.lit(1)).select(names))


def path_table(turns: DataFrame) -> DataFrame:
    """(conv_id, len, path): for each beginning of a conversation a digest of its turns, and its words so far."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("len", pa.int32()), ("path", pa.list_(pa.struct([("h", pa.binary()), ("w", pa.int64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        found: list[tuple] = []
        held = 0
        for conv_id, turns in itertools.groupby(rows, key=lambda r: r[0]):
            digest, total, path = b"", 0, []
            for _, _, _, own, words in turns:
                if own is not None:
                    digest, total = hashlib.sha256(digest + own).digest()[:16], total + words
                    path.append({"h": digest, "w": total})
            found.append((conv_id, len(path), path))
            held += len(path) + 1
            if held >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)
                found, held = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return written(dealt.mapInArrow(run, PATHS), "paths")


def hash_at(path: str, place: str) -> str:
    """The digest at a place of a path; the root's before the first."""
    return f"case when {place} < 1 then X'' else {path}[{place} - 1].h end"


def fattest(low: str, high: str) -> str:
    """Of the numbers above ``low`` up to ``high`` the one that most powers of two divide."""
    bits = f"(length(bin({low} ^ {high})) - 1)"
    return f"shiftleft(shiftright({high}, {bits}), {bits})"


NODE = ["node", "ext", "parent", "plen", "pw", "first", "edge", "handle"]


def nodes_of(edges: DataFrame) -> DataFrame:
    """Compacted nodes from (parent, plen, pw, edge): the edge holds the digests and words from ``plen`` to ``ext``.

    The handle of a node is its beginning of the two-fattest length on its edge.
    """
    known = edges.withColumn("ext", F.expr("plen + size(edge)"))
    return known.select(
        F.expr("element_at(edge, -1).h").alias("node"), "ext", "parent", "plen", "pw", F.expr("edge[0].h").alias("first"), "edge",
        F.expr(hash_at("edge", f"{fattest('plen', 'ext')} - plen")).alias("handle"),
    )


def locate(trie: DataFrame, asked: DataFrame, longest: int) -> DataFrame:
    """Of each row of ``asked`` (seq, len, path) the length of the deepest node that it passes, as ``a``.

    Fat binary search: between the deepest node known to be passed and what is left, the beginning of the two-fattest
    length is looked up among the handles. A hit whose node is passed raises the lower end to it, a hit whose node is
    not passed ends the search at its parent, and a miss lowers the upper end.
    """
    handles = trie.select("handle", "node", "ext", "plen")
    found = asked.withColumns({"a": F.lit(0), "b": F.col("len")})
    for _ in range(longest.bit_length()):
        found = found.withColumn("probe", F.expr(f"case when a < b then {hash_at('path', fattest('a', 'b'))} end"))
        found = found.join(handles, F.col("probe") == F.col("handle"), "left")
        passed = F.expr(f"ext <= len and ({hash_at('path', 'least(ext, len)')}) = node")
        low = F.when(F.col("node").isNull(), F.col("a")).when(passed, F.col("ext")).otherwise(F.col("plen"))
        high = F.when(F.col("probe").isNull(), F.col("b")).when(F.col("node").isNull(), F.expr(f"{fattest('a', 'greatest(b, a + 1)')} - 1"))
        found = found.select("seq", "len", "path", low.alias("a"), high.when(passed, F.col("b")).otherwise(F.col("plen")).alias("b"))
    return found.drop("b")


def insert(trie: DataFrame, waiting: DataFrame) -> DataFrame:
    """The trie with the rows of ``waiting`` (seq, len, path, a) in it.

    Each row follows the edge that goes on with its next turn as far as both agree. Edges are cut at all such
    points at once. Of rows that leave the trie at one point with the same next turn the longest becomes a leaf; the
    others wait for the next round, where they follow its edge. Rounds grow with the branchings on a path.
    """
    while True:
        edges = trie.select("first", F.col("node").alias("child"), "edge")
        met = waiting.where("a < len").withColumn("next", F.expr("path[a].h")).join(edges, F.col("next") == F.col("first"), "left")
        agreed = "size(filter(zip_with(slice(path, a + 1, size(edge)), edge, (x, y) -> x.h = y.h), x -> x))"
        shared = F.expr(f"a + case when child is null then 0 else {agreed} end")
        found = written(met.select("seq", "len", "path", "child", shared.alias("a")), "met")
        cuts = found.where("child is not null").groupBy("child").agg(F.collect_set("a").alias("cuts"))
        cuts = written(cuts, "cuts")
        open_ = trie.join(cuts, F.col("node") == F.col("child")).where("exists(cuts, x -> x < ext)")
        ends = "array_sort(array_distinct(concat(filter(cuts, x -> x < ext), array(ext))))"
        parts = open_.withColumn("ends", F.expr(ends)).select("*", F.posexplode("ends").alias("at", "high"))
        parts = parts.withColumn("low", F.expr("case when at = 0 then plen else ends[at - 1] end"))
        pieces = parts.select(
            F.expr("case when low = plen then parent else edge[low - plen - 1].h end").alias("parent"), F.col("low").alias("plen"),
            F.expr("case when low = plen then pw else edge[low - plen - 1].w end").alias("pw"),
            F.expr("slice(edge, low - plen + 1, high - low)").alias("edge"),
        )
        leaving = found.where("a < len").withColumn("next", F.expr("path[a].h"))
        chosen = leaving.groupBy("next").agg(F.min(F.struct((-F.col("len")).alias("n"), "seq")).alias("best"))
        chosen = written(chosen.select(F.col("best.seq").alias("seq")), "chosen")
        leaves = leaving.join(chosen, "seq").select(
            F.expr(hash_at("path", "a")).alias("parent"), F.col("a").alias("plen"),
            F.expr("case when a = 0 then 0L else path[a - 1].w end").alias("pw"), F.expr("slice(path, a + 1, len - a)").alias("edge"),
        )
        kept = trie.join(open_.select(F.col("node").alias("cut")), F.col("node") == F.col("cut"), "left_anti")
        trie = written(kept.select(NODE).union(nodes_of(pieces.union(leaves)).select(NODE)), "trie")
        waiting = written(leaving.join(chosen, "seq", "left_anti").select("seq", "len", "path", "a"), "waiting")
        if waiting.isEmpty():
            return trie


def build(paths: DataFrame, batches: int = BATCHES, growth: int = GROWTH) -> DataFrame:
    """The compacted trie of distinct paths (seq, len, path), put in batch by batch; the root has no row.

    A batch is chosen by a hash and ``growth`` times the one before, so all but the first meet a trie that most of their
    branchings are in.
    """
    spark = paths.sparkSession
    given = paths.where("len > 0")
    longest = given.agg(F.coalesce(F.max("len"), F.lit(0)).alias("n")).first().n
    edges = spark.createDataFrame([], f"parent binary, plen int, pw bigint, edge array<{STEP}>")
    trie = nodes_of(edges)
    place = F.pmod(F.xxhash64("seq"), F.lit(growth ** (batches - 1)))
    for number in range(batches):
        low = growth ** (number - 1) if number else 0
        batch = given.where((place >= low) & (place < growth**number))
        asked = batch.select("seq", "len", "path")
        found = locate(trie, asked, longest) if number else asked.withColumn("a", F.lit(0))
        trie = insert(trie, written(found, "located"))
    return trie


def subtree_sums(trie: DataFrame, own: DataFrame) -> DataFrame:
    """(node, n, m, leaves, weighted, words) of every node: sums, and for ``m`` the minimum, over its subtree.

    ``own`` has the values of single nodes, and the parent as ``up``. By doubling: after k rounds a node has the sums of
    all below it within 2**k steps, and what lies exactly that far below adds its own next; the rounds are the
    logarithm of the height. The root takes no part, so what meets in a node is its own subtree.
    """
    names = ["n", "m", "leaves", "weighted", "words"]
    sums = written(own, "sums")
    while True:
        low = sums.where("up is not null")
        added = low.groupBy(F.col("up").alias("node")).agg(*((F.min if c == "m" else F.sum)(c).alias(f"more_{c}") for c in names))
        jumps = sums.select(F.col("node").alias("up"), F.col("up").alias("far"))
        more = [F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"more_{c}"), F.lit(0)) for c in names]
        more[1] = F.least("m", "more_m")
        both = sums.join(added, "node", "left").join(jumps, "up", "left")
        sums = written(both.select("node", F.col("far").alias("up"), *(c.alias(n) for c, n in zip(more, names, strict=True))), "sums")
        if sums.where("up is not null").isEmpty():
            return sums.drop("up")


def id_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the SHA-256 of the ids that end at a node, ascending, comma-joined.

    Ids are joined by spans first, so a node that a third of all conversations end at takes a row for thousands of them;
    its strings are hashed one after the other and never held together.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    spans = ends.groupBy("node", F.shiftright("conv_id", ID_SPAN_BITS).alias("span")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for node, parts in itertools.groupby(rows, key=lambda r: r[0]):
            digest = hashlib.sha256()
            for at, (_, _, part) in enumerate(parts):
                digest.update(("," if at else "").encode() + part.encode())
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])

    dealt = spans.select("node", "span", "ids").repartition("node").sortWithinPartitions("node", "span")
    return dealt.mapInArrow(run, "node binary, ends_sha256 string")


def root_row(ends: DataFrame, tops: DataFrame, digests: DataFrame, nothing: str) -> tuple | None:
    """The row of the empty beginning, from the conversations that end there and the sums of the nodes just below."""
    here = ends.where(F.length("node") == 0).first()
    own = digests.where(F.length("node") == 0).first()
    below = tops.agg(*(F.sum(c).alias(c) for c in ("n", "leaves", "weighted", "words")), F.min("m").alias("m"), F.count("*").alias("kids")).first()
    if here is None and not below.kids:
        return None
    smallest = min(x.m for x in (here, below) if x is not None and x.m is not None)
    count = (here.n if here else 0) + (below.n or 0)
    saved = (below.weighted or 0) - (below.words or 0)
    return smallest, 0, None, count, below.kids, below.leaves or 1, saved, own.ends_sha256 if own else nothing


def prefix_trie(
    conversations: DataFrame, heads: Column | None = None, family: int = FAMILY, batches: int = BATCHES, growth: int = GROWTH
) -> DataFrame:
    """One row for each distinct beginning of the conversations of (conv_id, turn, role, text), the empty one included.

    conv_id, the smallest conversation with that beginning; depth, its turns; parent_conv_id, the same of the beginning
    one turn shorter; n_convs; n_children; n_leaves, of its subtree; saved_tokens, the words that need not be computed
    again in its subtree; ends_sha256 of the conversations that end there. ``heads``, a number computed from conv_id,
    makes each conversation begin with as many turns of its family's first one, in place of as many of its own.

    Turns go by turn, nulls first, ties by a hash of role and text; null roles and texts count as empty. Rows without
    conv_id belong to no conversation and are left out. Repeated rows are turns of their own. An empty table has no
    beginnings and gives no row. Other columns are not read. Beginnings are told apart by SHA-256 cut to 128 bits.

    The 16 bytes for each turn of a single conversation must fit in a task. A turn that a third of all conversations
    begin with is one node; what follows it meets there by an equi-join whose large side can be split, and by sums.
    """
    heads = F.lit(0) if heads is None else heads
    paths = path_table(rebuilt(turn_table(conversations), heads, family))
    last = F.expr(hash_at("path", "len")).alias("node")
    total = F.expr("case when len = 0 then 0L else path[len - 1].w end")
    ends = paths.groupBy(last).agg(F.count("*").alias("n"), F.min("conv_id").alias("m"), F.max(total).alias("total"))
    ends = written(ends, "ends")
    firsts = ends.select(F.col("node").alias("seq"), F.col("m").alias("conv_id"))
    trie = build(written(paths.join(firsts, "conv_id").select("seq", "len", "path"), "sequences"), batches, growth)
    digests = id_digests(paths.select(last, "conv_id"))

    children = trie.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    children = written(children, "children")
    ended = ends.select("node", "n", "m", (F.col("n") * F.col("total")).alias("weighted"))
    own = trie.join(ended, "node", "left").join(children, "node", "left").select(
        "node", F.when(F.length("parent") > 0, F.col("parent")).alias("up"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "m",
        F.col("n_children").isNull().cast("bigint").alias("leaves"), F.coalesce("weighted", F.lit(0)).cast("bigint").alias("weighted"),
        (F.expr("element_at(edge, -1).w") - F.col("pw")).alias("words"),
    )
    sums = subtree_sums(trie, own)
    known = trie.join(sums, "node").join(children, "node", "left").join(digests, "node", "left")
    above = sums.select(F.col("node").alias("parent"), F.col("m").alias("up_m"))
    whole = ends.where(F.length("node") == 0).agg(F.sum("n").alias("here"), F.min("m").alias("here_m"))
    tops = trie.where("plen = 0").select("node").join(sums, "node").agg(
        *(F.sum(c).alias(c) for c in ("n", "leaves", "weighted", "words")), F.min("m").alias("m"), F.count("*").alias("kids")
    )
    nothing = hashlib.sha256().hexdigest()
    zero = F.lit(0).cast("bigint")
    root = root_row(ends, trie.where("plen = 0").select("node").join(sums, "node"), digests, nothing)
    if root is None:
        return trie.sparkSession.createDataFrame([], RESULT)
    spread = known.join(above, "parent", "left").select("*", F.posexplode("edge").alias("at", "step"))
    before = F.expr("case when at = 0 then pw else edge[at - 1].w end")  # words up to the turn before
    is_last = F.expr("at = size(edge) - 1")
    nodes = spread.select(
        F.col("m").alias("conv_id"), (F.col("plen") + F.col("at") + 1).cast("bigint").alias("depth"),
        F.when(F.col("at") > 0, F.col("m")).when(F.col("plen") == 0, F.lit(root[0])).otherwise(F.col("up_m")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(is_last, F.coalesce("n_children", zero)).otherwise(F.lit(1).cast("bigint")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("weighted") - F.col("n") * before - F.col("words") + before - F.col("pw")).alias("saved_tokens"),
        F.when(is_last, F.coalesce("ends_sha256", F.lit(nothing))).otherwise(F.lit(nothing)).alias("ends_sha256"),
    )
    return trie.sparkSession.createDataFrame([root], RESULT).union(nodes)
