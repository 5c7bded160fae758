import json
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from paperbrook.operators import approx, search
from paperbrook.operators.embedding import embed
from paperbrook.operators.index import build_index, postings, sync_index
from paperbrook.operators import chunk_store
from paperbrook.operators.statistics import index_statistics

WORDS = ["the", "a", "bridge", "house", "repair", "plan", "meeting", "budget", "road"]
CHUNK = "chunk_id string, path string, category string, year int, month int, chunk_text string"


def make_rows(n, seed=1):
    pick = random.Random(seed)
    # "the" is in nearly every chunk, and a third of the chunks are copies of one text.
    text = lambda i: "the plan" if i % 3 == 0 else "the " + " ".join(pick.choices(WORDS, k=pick.randint(1, 12)))
    return [(f"c{i:03d}", f"p{i // 4}", "Housing" if i % 2 else "Construction", 2023 + i % 3, 1 + i % 12, text(i)) for i in range(n)]


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame(make_rows(120), CHUNK)


@pytest.fixture(scope="module")
def index(chunks):
    return build_index(chunks)


@pytest.fixture(scope="module")
def queries(spark):
    texts = [(1, "The bridge repair"), (2, "plan"), (3, "nothing_here zzz"), (4, "the the the road budget")]
    return spark.createDataFrame(texts, "query_id long, text string")


def brute_knn(asked, found, k):
    out = []
    for q, a in asked:
        scored = sorted(((float(search._rounded(np.dot(a, v))), c) for c, v in found), key=lambda x: (-x[0], x[1]))
        out += [(q, c, s, n) for n, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


def brute_bm25(rows, asked, k, keep=lambda row: True):
    docs = {r[0]: search_tokens(r[5]) for r in rows}
    n, average = len(docs), sum(map(len, docs.values())) / len(docs)
    df = Counter(t for d in docs.values() for t in set(d))
    out = []
    for q, text in asked:
        terms = set(search_tokens(text))
        scored = []
        for row in filter(keep, rows):
            tf = Counter(docs[row[0]])
            hit = [t for t in terms if tf[t]]
            if hit:
                score = sum(
                    math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2
                    / (tf[t] + 1.2 * (0.25 + 0.75 * len(docs[row[0]]) / average)) for t in hit
                )
                scored.append((round(score, 6), row[0]))
        scored.sort(key=lambda x: (-x[0], x[1]))
        out += [(q, c, s, i) for i, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


def search_tokens(text):
    return text.lower().replace("_", " ").split()


def hits(df):
    return sorted((r.query_id, r.chunk_id, r.score, r["rank"]) for r in df.collect())


def vector_rows(n, seed, copies=False):
    generator = np.random.default_rng(seed)
    rows = generator.normal(size=(n, 8))
    if copies:
        rows[::3] = rows[0]
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return rows.tolist()


@pytest.mark.parametrize("max_broadcast", [search.BROADCAST_QUERIES, 4])
@pytest.mark.parametrize("k", [1, 7, 500])
def test_similarity_matches_brute_force_with_ties(spark, max_broadcast, k):
    found = [(f"v{i:03d}", v) for i, v in enumerate(vector_rows(90, 1, copies=True))]
    asked = list(enumerate(vector_rows(9, 2)))
    vectors = spark.createDataFrame(found, "chunk_id string, embedding array<double>").repartition(5)
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    result = search.similarity_search(queries, vectors, k, max_broadcast=max_broadcast)
    assert hits(result) == brute_knn(asked, found, k)


def test_small_score_blocks_give_the_same():
    found = [(i, v) for i, v in enumerate(vector_rows(60, 3, copies=True))]
    asked = [(f"q{i}", v) for i, v in enumerate(vector_rows(5, 4))]
    best = search._Best(len(asked), 6)
    matrix = np.array([v for _, v in asked])
    for at in range(0, len(found), 7):
        part = found[at : at + 7]
        best.add(pa.array([i for i, _ in part]), matrix @ np.array([v for _, v in part]).T)
    table = pa.Table.from_batches(best.batches(pa.array([q for q, _ in asked]), ["q", "c", "s"])).to_pylist()
    expected = [(q, c, s) for q, c, s, _ in brute_knn(asked, found, 6)]
    assert sorted((r["q"], r["c"], r["s"]) for r in table) == expected


def test_similarity_edge_cases(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None)], "chunk_id string, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert hits(search.similarity_search(queries, vectors)) == [(1, "a", 1.0, 1)]
    assert hits(search.similarity_search(queries.where("query_id = 2"), vectors)) == []
    for way in (0, 10):
        assert hits(search.similarity_search(queries, vectors.where("chunk_id = 'x'"), max_broadcast=way)) == []


@pytest.mark.parametrize("max_broadcast", [search.BROADCAST_TERMS, 2])
def test_keyword_matches_brute_force(queries, index, max_broadcast):
    asked = [(r.query_id, r.text) for r in queries.collect()]
    result = search.keyword_search(queries, index, 10, max_broadcast=max_broadcast)
    assert hits(result) == brute_bm25(make_rows(120), asked, 10)


@pytest.mark.parametrize("kind", ["int", "smallint", "bigint", "string", "date", "decimal(9,0)"])
def test_query_ids_of_any_type(spark, index, kind):
    given = {"date": ["2024-01-01", "2024-01-02"]}.get(kind, ["1", "2"])
    rows = spark.createDataFrame([(i, "alpha beta") for i in given], "i string, text string")
    queries = embed(rows.select(F.col("i").cast(kind).alias("query_id"), "text"))
    for found in (search.similarity_search(queries, index, 3), search.keyword_search(queries, index, 3),
                  search.hybrid_search(queries, index, 3), approx.approx_search(queries, index, 64, 3)):
        assert dict(found.dtypes)["query_id"] == kind and found.count() >= 0
    with pytest.raises(ValueError, match="more than once"):
        search.similarity_search(queries.union(queries), index)
    with pytest.raises(ValueError, match="more than once"):
        search.keyword_search(queries.union(queries), index)


def test_a_query_without_tokens_has_no_hits(spark, index, chunks):
    queries = spark.createDataFrame([(1, "... !!!"), (2, None)], "query_id int, text string")
    found = search.with_columns(search.hybrid_search(queries, index, 3), chunks, ["path"])
    answers = search.result_envelope(queries, found, ["path"]).collect()
    assert [(r.status, r.num_results) for r in answers] == [("NO_RESULTS", 0)] * 2


def test_the_index_is_never_exchanged(spark, tmp_path):
    vectors = spark.createDataFrame(list(enumerate(vector_rows(50, 1))), "chunk_id long, embedding array<double>")
    vectors.write.parquet(f"{tmp_path}/v")
    index = spark.read.parquet(f"{tmp_path}/v")
    queries = vectors.select(F.col("chunk_id").alias("query_id"), "embedding")
    plan = search.similarity_search(queries, index, 3, max_broadcast=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 5 and all("embedding" not in line for line in plan.splitlines() if "Exchange" in line)


def test_keyword_filter_holds_before_ranking_and_weights_stay_global(queries, index):
    asked = [(r.query_id, r.text) for r in queries.collect()]
    items = [{"key": "category", "value": "Housing"}, {"key": "month <", "value": 9}]
    expected = brute_bm25(make_rows(120), asked, 10, lambda r: r[2] == "Housing" and r[4] < 9)
    assert hits(search.keyword_search(queries, index, 10, items)) == expected


def test_index_is_built_without_a_shuffle(index):
    assert "Exchange" not in index._jdf.queryExecution().executedPlan().toString()


def test_index_rows(spark, rows):
    df = spark.createDataFrame([("x", "b a b"), ("y", "..."), ("z", None), ("w", "c A")], "chunk_id string, chunk_text string")
    built = build_index(df, carry=[])
    assert rows(built.select("chunk_id", "doc_len", "terms", "tfs")) == [
        ("w", 2, ["a", "c"], [1, 1]), ("x", 3, ["a", "b"], [1, 2]), ("y", 0, [], []), ("z", 0, [], [])
    ]
    assert rows(postings(built, "chunk_id")) == [("a", 1, "w"), ("a", 1, "x"), ("b", 2, "x"), ("c", 1, "w")]


def test_fuse_and_hybrid(spark, queries, index):
    vector = spark.createDataFrame([(1, "a", 0.9, 1), (1, "b", 0.8, 2)], "query_id long, chunk_id string, score double, rank int")
    keyword = spark.createDataFrame([(1, "b", 3.0, 1), (1, "c", 2.0, 2)], "query_id long, chunk_id string, score double, rank int")
    fused = search.fuse(vector, keyword, 2)
    assert hits(fused) == [(1, "a", round(1 / 61, 9), 2), (1, "b", round(1 / 62 + 1 / 61, 9), 1)]

    result = search.hybrid_search(queries, index, 10)
    by_vector = hits(search.similarity_search(embed(queries), index, 10))
    by_word = hits(search.keyword_search(queries, index, 10))
    score = Counter()
    for q, c, _, n in by_vector + by_word:
        score[q, c] += 1 / (60 + n)
    expected = []
    for q in {q for q, _ in score}:
        order = sorted(((round(s, 9), c) for (p, c), s in score.items() if p == q), key=lambda x: (-x[0], x[1]))
        expected += [(q, c, s, n) for n, (s, c) in enumerate(order[:10], 1)]
    assert hits(result) == sorted(expected)


def test_filtered_hybrid_returns_only_matching_chunks(queries, index, chunks):
    items = [{"key": "category", "value": "Construction"}, {"key": "year", "value": 2025}, {"key": "month", "value": 9}]
    found = search.with_columns(search.hybrid_search(queries, index, filters=items), chunks, ["category", "year", "month"])
    assert {(r.category, r.year, r.month) for r in found.collect()} == {("Construction", 2025, 9)}


def test_embedding_is_unit_length_and_zero_without_tokens(spark):
    df = embed(spark.createDataFrame([("one two two",), ("...",), (None,)], "text string"))
    norms = [None if r.embedding is None else round(math.sqrt(sum(x * x for x in r.embedding)), 9) for r in df.collect()]
    assert norms == [1.0, 0.0, 0.0]


def test_envelope(spark, queries, index, chunks):
    columns = ["chunk_text", "chunk_id", "path"]
    found = search.with_columns(search.keyword_search(queries, index, 5), chunks, columns, max_chars=6)
    by_query = {r.query_id: r for r in search.result_envelope(queries, found, columns).collect()}
    assert by_query[3].status == "NO_RESULTS" and by_query[3].num_results == 0 and by_query[3].docs == []
    assert by_query[2].status == "OK" and by_query[2].num_results == 5
    order = [h[1] for h in sorted(hits(search.keyword_search(queries, index, 5)), key=lambda h: h[3]) if h[0] == 2]
    assert [d.chunk_id for d in by_query[2].docs] == order
    assert all(len(d.chunk_text) <= 6 for d in by_query[2].docs)
    text = {r.query_id: json.loads(r.result) for r in search.result_envelope(queries, found, columns, as_json=True).collect()}
    assert text[3] == {"status": "NO_RESULTS", "num_results": 0, "docs": []}
    assert [d["chunk_id"] for d in text[2]["docs"]] == order


def test_sync_index_equals_rebuild(spark, chunks, index, rows):
    changed = chunks.where("chunk_id <> 'c005'").withColumn(
        "chunk_text", F.when(F.col("chunk_id") == "c007", "new words").otherwise(F.col("chunk_text"))
    ).unionByName(spark.createDataFrame([("z", "pz", "Housing", 2024, 1, "fresh text")], CHUNK))
    synced = sync_index(index, chunk_store.change_feed(chunks, changed))
    rebuilt = build_index(changed)
    assert rows(synced) == rows(rebuilt)


def test_approx_search_scores_candidates_exactly(spark):
    found = [(i, v) for i, v in enumerate(vector_rows(80, 5))]
    vectors = spark.createDataFrame(found, "chunk_id long, embedding array<double>")
    queries = vectors.select(F.col("chunk_id").alias("query_id"), "embedding")
    exact = brute_knn(found, found, 80)
    scores = {(q, c): s for q, c, s, _ in exact}
    result = hits(approx.approx_search(queries, vectors, 8, k=5, bits=3))
    assert all(abs(scores[q, c] - s) < 1e-5 for q, c, s, _ in result)
    assert all((i, i) in {(q, c) for q, c, _, n in result if n == 1} for i in range(80))
    asked, hashed = (approx.hash_vectors(df, 8, bits=3) for df in (queries, vectors))
    candidates = {(r.query_id, r.chunk_id) for r in approx.candidate_scores(asked, hashed).collect()}
    best = [(q, c, s) for q, c, s, _ in exact if (q, c) in candidates]
    expected = []
    for q in range(80):
        mine = sorted((r for r in best if r[0] == q), key=lambda r: (-r[2], r[1]))[:5]
        expected += [(*r, n) for n, r in enumerate(mine, 1)]
    assert result == sorted(expected)
    assert hits(approx.approx_search(queries, hashed, 8, k=5, bits=3, max_broadcast=7)) == result


def test_approx_search_prunes_a_written_index(spark, tmp_path):
    found = [(i, v) for i, v in enumerate(vector_rows(40, 6))]
    vectors = spark.createDataFrame(found, "chunk_id long, embedding array<double>")
    queries = vectors.where("chunk_id < 2").select(F.col("chunk_id").alias("query_id"), "embedding")
    approx.hash_vectors(vectors, 8, bits=3).write.partitionBy("lsh_table", "lsh_code").parquet(f"{tmp_path}/h")
    result = approx.approx_search(queries, spark.read.parquet(f"{tmp_path}/h"), 8, k=5, bits=3)
    assert hits(result) == hits(approx.approx_search(queries, vectors, 8, k=5, bits=3))
    with_values = result._jdf.queryExecution().optimizedPlan().toString()
    assert "lsh_table" in with_values and "LeftSemi" not in with_values
    files = sum(1 for _ in (tmp_path / "h").rglob("*.parquet"))
    codes = queries.select(approx.plane_codes(F.col("embedding"), 8, bits=3).alias("codes")).collect()
    read = spark.read.parquet(f"{tmp_path}/h").where(approx._has_code(codes))
    assert len(read.select(F.input_file_name()).distinct().collect()) < files


def test_pairs_of_frequent_codes_and_repeated_keys_come_once(spark, monkeypatch):
    monkeypatch.setattr(approx, "PAIR_QUERIES", 3)
    monkeypatch.setattr(approx, "PAIR_ROWS", 4)
    monkeypatch.setattr(approx, "MEET_QUERIES", 3)
    monkeypatch.setattr(approx, "MEET_ROWS", 4)
    found = [(i, v) for i, v in enumerate(vector_rows(40, 7))] + [(i, v) for i, v in enumerate(vector_rows(10, 8))]
    vectors = spark.createDataFrame(found, "chunk_id long, embedding array<double>")
    queries = vectors.where("chunk_id >= 5").dropDuplicates(["chunk_id"]).select(F.col("chunk_id").alias("query_id"), "embedding")
    asked, hashed = (approx.hash_vectors(df, 8, bits=2) for df in (queries, vectors))
    pairs = approx.candidate_scores(asked, hashed)
    got = [(r.query_id, r.chunk_id) for r in pairs.select("query_id", "chunk_id").collect()]
    joined = asked.select("query_id", "lsh_table", "lsh_code").join(hashed.select("chunk_id", "lsh_table", "lsh_code"), ["lsh_table", "lsh_code"])
    assert len(got) == len(set(got))
    assert set(got) == {(r.query_id, r.chunk_id) for r in joined.select("query_id", "chunk_id").distinct().collect()}
    # Every pair was made by a join of its own before, and then moved to be counted once.
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    single = spark.createDataFrame(found[:40], vectors.schema)
    small = approx.approx_search(queries, single, 8, k=5, bits=2, max_broadcast=100)
    assert hits(approx.approx_search(queries, single, 8, k=5, bits=2, max_broadcast=6)) == hits(small)


def test_parts_of_many_queries_are_written_once(spark, tmp_path):
    queries = spark.range(50).select(F.col("id").alias("query_id"), F.lit("x").alias("text"))
    blocks = search.query_blocks(queries, "query_id", 4)
    assert 1 < len(blocks) <= 4
    assert sorted(r.query_id for b in blocks for r in b.collect()) == list(range(50))
    # A part reads its own folder only, not all queries.
    assert all("_part=" in f for b in blocks for f in b.inputFiles())
    assert sum(len(b.inputFiles()) for b in blocks) == len(blocks)
    assert search.query_blocks(queries.limit(0), "query_id", 4) == []


def test_several_scans_read_what_they_need_of_the_index_once(spark, monkeypatch):
    from paperbrook.operators import search as module
    from paperbrook.operators.index import build_index

    rows = [(f"c{n:03d}", "p", "A", 2020, n % 12, " ".join(f"w{n * m % 23}" for m in range(1, 9)) + " the" * (n % 4)) for n in range(150)]
    index = build_index(spark.createDataFrame(rows, "chunk_id string, path string, category string, year int, month int, chunk_text string"))
    asked = spark.createDataFrame([(n, f"the w{n} w{n + 1} nothing") for n in range(12)], "query_id int, text string")
    want = sorted(map(tuple, module.keyword_search(asked, index, 5, [{"key": "month <", "value": 9}]).collect()))
    monkeypatch.setattr(module, "COMMON", 10**9)  # every term by the product of matrices
    assert want == sorted(map(tuple, module.keyword_search(asked, index, 5, [{"key": "month <", "value": 9}]).collect()))
    found = module.keyword_search(asked, index, 5, [{"key": "month <", "value": 9}], max_broadcast=9)
    assert want == sorted(map(tuple, found.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "/candidates-" in plan and "regexp" not in plan


def test_hits_of_many_scans_are_written_in_rounds(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(search, "ROUND_SCANS", 2)
    rows = [(n, [float(n % 7), float(n % 5), 1.0]) for n in range(60)]
    vectors = spark.createDataFrame(rows, "chunk_id long, embedding array<double>")
    queries = vectors.withColumnRenamed("chunk_id", "query_id")
    want = hits(search.similarity_search(queries, vectors, 3))
    sent = []
    scan = search._scan_top_k
    monkeypatch.setattr(search, "_scan_top_k", lambda *given: sent.append(scan(*given)) or sent[-1])
    found = search.similarity_search(queries, vectors, 3, max_broadcast=9)
    assert hits(found) == want and len(sent) > 4
    # The plan reads what the rounds have written, and nothing that was sent for them is kept.
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert all(broadcast._jbroadcast is None or not broadcast._jbroadcast.isValid() for _, broadcast in sent)


def test_terms_of_queries_come_as_columns_and_not_as_rows(spark, index, queries, monkeypatch):
    kept, sizes, collect = index_statistics(index), [], type(queries).collect

    def counted(df):
        rows = collect(df)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(type(queries), "collect", counted)
    [(ids, weights, df)] = search.term_weights(queries, kept, "query_id", "text", search.BROADCAST_TERMS)
    assert max(sizes) <= 1 and len(weights.terms) == len(df) > 1
    assert ids.type == to_arrow_type(queries.schema["query_id"].dataType)


def test_terms_of_one_in_300_pairs_are_one_product(monkeypatch):
    products, matmul = [], np.matmul
    monkeypatch.setattr(search.np, "matmul", lambda *given, **out: products.append(given[0].shape) or matmul(*given, **out))
    words = pa.array([f"w{n % 300}" for n in range(300)])
    weights = search._term_weights(pa.array(range(300)), words, np.ones(300), 1.0)
    lists = [[f"w{n}" for n in range(300)]]
    rows = pa.RecordBatch.from_pydict({"terms": lists, "tfs": [[1] * 300], "doc_len": [300]})
    assert (search._bm25(rows, weights) > 0).all() and products == [(300, 300)]
