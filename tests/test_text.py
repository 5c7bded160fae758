import pytest
from pyspark.sql import functions as F

from paperbrook.functions import text
from paperbrook.operators import quality


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_html_text(spark):
    html = "<head><STYLE>p{}</STYLE><script>var a='<p>';</script></head><p>A &amp;lt; b<br>c</p><!-- no --><div>d&nbsp;e</div>"
    assert one(spark, html, text.html_text) == "A &lt; b\nc\nd e"


@pytest.mark.parametrize(("html", "expected"), [
    ("<table><tr><td>12</td><td>34</td></tr><tr><th>a</th><td>b</td></tr></table>", "12 34\na b"),
    ("<dl><dt>term</dt><dd>meaning</dd></dl><select><option>x</option><option>y</option></select>", "term\nmeaning\nx\ny"),
    ("caf&eacute; &#8217;s &#x2019;t &#X1F600; &copy;", "café ’s ’t 😀 ©"),
    ("&amp;#65; &amp;amp; &unknown; &#0; &#xD800; &#9999999; & alone", "&#65; &amp; &unknown; &#0; &#xD800; &#9999999; & alone"),
    ("", ""), (None, None),
])
def test_html_text_by_hand(spark, html, expected):
    assert one(spark, html, text.html_text) == expected


def test_join_pages_keeps_empty_pages(spark):
    assert one(spark, ["a", None, "b"], text.join_pages, "array<string>") == "a\n\nb"
    assert one(spark, [], text.join_pages, "array<string>") == ""


def test_decode_text(spark):
    assert one(spark, bytearray("äé".encode()), text.decode_text, "binary") == "äé"
    assert one(spark, bytearray(b"caf\xe9 ok"), text.decode_text, "binary") == "caf\ufffd ok"
    assert one(spark, None, text.decode_text, "binary") is None


def test_tokens(spark):
    assert one(spark, "The Ärger-42, the_end", text.tokens) == ["the", "ärger", "42", "the", "end"]
    assert one(spark, "...", text.tokens) == []


def test_tokens_reach_python_in_one_string(spark):
    from paperbrook.operators.index import build_index

    texts = ["The Ärger-42, the_end", "...", "", None, " a  b\u00a0c\u2003\U0001d400x ", "ǅ İ ß 一二 ٣ b"]
    df = spark.createDataFrame(list(enumerate(texts)), "chunk_id int, chunk_text string")
    index = build_index(df, carry=[])
    assert "regexp_extract_all" not in index._jdf.queryExecution().analyzed().toString()
    for r in index.join(df.select("chunk_id", text.tokens(F.col("chunk_text")).alias("all")), "chunk_id").collect():
        assert r.doc_len == len(r["all"] or []) and dict(zip(r.terms, r.tfs)) == {t: r["all"].count(t) for t in r["all"] or []}


def test_metadata_violations(spark):
    df = spark.createDataFrame(
        [("Housing", 2024, 5), ("Other", 1899, 13), (None, None, None)], "category string, year int, month int"
    )
    found = quality.validate_metadata(df, categories=["Construction", "Housing"]).collect()
    assert [r.violations for r in found] == [[], ["category", "year", "month"], ["category", "year", "month"]]


def test_few_rows_of_a_batch_are_counted_at_a_time(monkeypatch):
    from paperbrook.operators import embedding

    kept, sizes, unique = {}, [], embedding.np.unique
    monkeypatch.setattr(embedding.F, "arrow_udf", lambda f, t: kept.setdefault("profile", f) and (lambda c: c))
    embedding.term_profile(None)
    rows = embedding.pa.array([[f"w{n % 9}", f"w{n % 4}", "w"][: n % 4] if n % 7 else None for n in range(5000)], embedding.pa.list_(embedding.pa.string()))
    monkeypatch.setattr(embedding.np, "unique", lambda x, **k: sizes.append(len(x)) or unique(x, **k))
    got = kept["profile"](rows)
    assert max(sizes) <= 3 * embedding.FEW_ROWS and len(got) == 5000
    monkeypatch.setattr(embedding, "FEW_ROWS", 5000)
    assert kept["profile"](rows).equals(got)
    assert len(kept["profile"](rows.slice(0, 0))) == 0
