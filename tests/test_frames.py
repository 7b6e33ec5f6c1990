import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from siftmill.operators import quality as Q
from siftmill.operators import relational as R
from siftmill.plans.pipeline import company_pipeline, parse_codes, pending, progress, run_company
from siftmill.queries import catalogue
from siftmill.sources import readers, writers

DATA = "/root/testdata/sf0.001"


def test_keep_first_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, None, ""), (4, " ", None), (5, "a", None)], "id int, k string, l string")
    assert sorted(r.id for r in R.keep_first(df, ["k", "l"], ["id"]).collect()) == [1, 3, 4, 5]
    assert sorted(r.id for r in R.mark_duplicates(df, "k", "d").filter("d").collect()) == [1, 2, 5]
    got = {r.combo: (r.applicable, r.n_unique, r.duplicates) for r in R.duplicate_combinations(df, ["k", "l"]).collect()}
    assert got == {"k": (3, 1, 2), "l": (2, 1, 1), "k+l": (2, 1, 1)}
    assert R.keep_first(df.limit(0), ["k"], ["id"]).count() == 0


def test_expression_filter_refuses_numbers(spark):
    df = spark.range(4).toDF("x")
    assert R.filter_expr(df, "x == 2").count() == 1
    with pytest.raises(ValueError):
        R.filter_expr(df, "x + 1")


def test_fallback_join(spark):
    base = spark.createDataFrame([(1, "s1", "d1"), (2, "s2", "d2"), (3, None, None)], "id int, siren string, domain string")
    right = spark.createDataFrame([("s1", "zz", "m1"), (None, "d2", "m2")], "siren string, domain string, mail string")
    assert {(r.id, r.mail) for r in R.left_join_fallback(base, right, "siren", "domain", ["mail"]).collect()} == {(1, "m1"), (2, "m2"), (3, None)}


def test_latency_fixture(spark):
    df = spark.createDataFrame([("a", v) for v in (100.0, 200.0, 300.0, 400.0, 500.0)], "g string, v double")
    r = Q.latency_summary(df, "g", "v").first()
    assert (r.p50_ms, r.p90_ms, r.p99_ms) == (300.0, 460.0, 496.0)
    assert Q.index_percentile(df, "g", "v", 90).first().value == 500.0


def test_entity_union(spark):
    df = spark.createDataFrame([("k", 2, None, ["b", "a"]), ("k", 1, None, None), ("k", 3, "x", ["a"])], "k string, o int, s string, l array<string>")
    r = R.entity_union(df, "k", ["s"], ["l"], ["o"]).first()
    assert r.s == "x" and r.l == ["a", "b"]


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "acme.fr.html").write_text("<title>Acme</title><a href='mailto:x@acme.fr'>m</a>")
    r = readers.read_html(spark, str(tmp_path / "h")).first()
    assert (r.domain, r.title, r.emails) == ("acme.fr", "Acme", ["x@acme.fr"])
    (tmp_path / "log.jsonl").write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    assert readers.read_log(spark, str(tmp_path / "log.jsonl"), "a int").agg(F.sum("a")).first()[0] == 4
    rss = "<rss><channel><item><title>T</title><link>L</link><pubDate>P</pubDate></item></channel></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link href="B"/><updated>C</updated></entry></feed>'
    rows = readers.feed_entries(spark.createDataFrame([("r", rss), ("a", atom)], "id string, xml string")).collect()
    assert {(x.id, x.title, x.link) for x in rows} == {("r", "T", "L"), ("a", "A", "B")}
    df = spark.createDataFrame([("a", 1), ("é", 2)], "a string, b long")
    writers.write_parquet(df, str(tmp_path / "p"))
    assert readers.read_parquet(spark, str(tmp_path / "p"), ["b", "zz"]).columns == ["b"]
    writers.write_spreadsheet(df, str(tmp_path / "x.csv"))
    assert (tmp_path / "x.csv").read_bytes()[:3] == b"\xef\xbb\xbf"
    assert readers.resolve(spark, [str(tmp_path / "no"), str(tmp_path / "p")]) == str(tmp_path / "p")
    new = writers.upsert(df, spark.createDataFrame([("a", 9)], "a string, b long"), "a", "b")
    assert {(r.a, r.b) for r in new.collect()} == {("a", 9), ("é", 2)}
    assert "<svg" in writers.svg_histogram([1, 2]) and "&lt;" in writers.html_report("<t>", {"x": df})
    hits = readers.ranked_results(spark.createDataFrame([("q", 1, "https://r.test/?u=https%3A%2F%2Fa.fr%2Fx"), ("q", 2, "https://pages.annu.fr/y")], "q string, position int, url string"), "q", "url", ["annu.fr"])
    assert [(r.domain, r.rank) for r in hits.collect()] == [("a.fr", 1)]
    p = spark.range(1).select(readers.company_payload(F.lit('{"nom_entreprise":"X","siren":"1","siege":{"ville":"V"},"entreprise_cessee":false,"representants":[{"nom":"B","prenom":"A"}]}')).alias("p")).first().p
    assert (p.name, p.address, p.active, p.executives) == ("X", "V", True, ["A B"])


def test_pipeline(spark):
    p = company_pipeline()
    assert p.batches(["export"]) == [["normalize"], ["dedup"], ["score"], ["export"]]
    with pytest.raises(KeyError):
        p.batches(["nothing"])
    out = run_company(spark, spark.read.parquet(f"{DATA}/standardize.parquet"), "full", limit=5)
    assert out["export"].count() == 5 and "duplicates" in out
    items, done = spark.range(4).toDF("k"), spark.range(1).toDF("k")
    assert pending(items, done, "k").count() == 3 and progress(items, done, "k").first().pct == 25.0
    assert parse_codes("62.01Z; 62.02A,62.01Z") == ["62.01Z", "62.02A"]


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: "None" if v is None or v != v else f"{v:.4f}" if isinstance(v, float) else str(v)
    return sorted("|".join(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = catalogue.QUERIES[name](spark, DATA)
    want = con.execute(catalogue.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(want.fetchall(), columns)
