from pyspark.sql import functions as F

from siftmill.functions import dimensions as D
from siftmill.functions import matching as M
from siftmill.functions import numbers as N
from siftmill.functions import web as W
from siftmill.operators import contacts as K
from siftmill.operators import exports as X
from siftmill.operators import lookups as L
from siftmill.operators import quality as Q
from siftmill.streaming import events as E


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [r[0] for r in df.select(column(F.col("c"))).collect()]


def test_dimensions(spark):
    assert D.departments(spark).count() == 109
    assert one(spark, D.industry, "62.01Z", "99", None) == ["Information Technology & Services", None, None]
    assert one(spark, D.sector, "62.01Z", "6201A", None) == ["technology", None, None]
    assert one(spark, D.staff_class, "11", "NN", "x", None) == ["11-50", "1-10", None, None]
    assert one(spark, D.region_of, "75", "971", "99") == ["Île-de-France / Paris", "Guadeloupe / Guadeloupe", "Département 99"]
    df = spark.createDataFrame([("01 42 00 00 00", "75"), ("+33442000000", "13001"), ("0142000000", "13"), ("0590 11 22 33", "971"), (None, "75"), ("0142000000", None)], "p string, c string")
    assert [r[0] for r in df.select(D.area_fits(F.col("p"), F.col("c"))).collect()] == [True, True, False, True, False, False]


def test_web(spark):
    assert [r.reason for r in one(spark, W.site_check, "https://a.fr/x", "ftp://a.fr", "http:///x", "http://local", None, " ")] == ["valid", "scheme", "netloc", "domain", "missing", "missing"]
    assert [r.normalized for r in one(spark, W.linkedin_check, "https://linkedin.com/company/ACME/", "http://linkedin.com/company/a", "https://linkedin.com/in/x")] == ["https://www.linkedin.com/company/acme/", "http://linkedin.com/company/a", "https://linkedin.com/in/x"]
    assert one(spark, W.with_scheme, " a.fr/x ", "//a.fr", "http://a.fr", "") == ["https://a.fr/x", "https://a.fr", "http://a.fr", ""]
    base = F.lit("https://a.fr/x/y?q=1")
    assert one(spark, lambda c: W.resolved(base, c), "z#f", "/z", "//b.fr/z", "https://c.fr", "") == ["https://a.fr/x/z", "https://a.fr/z", "https://b.fr/z", "https://c.fr", ""]
    assert one(spark, lambda c: W.skipped(c, F.lit("www.a.fr")), "https://a.fr/x", "https://b.fr/x", "mailto:x@a.fr", "https://a.fr/x.PDF") == [False, True, True, True]
    assert one(spark, W.sanitised_email, " <Jean . Dupont @ A.fr>, ", "x", None) == ["jean.dupont@a.fr", "x", None]
    assert one(spark, W.plausible_email, "a@b.fr", "a@b.png", "a@b", "@b.fr", None) == [True, False, False, False, False]
    assert one(spark, W.first_french_phone, "12; 01 02 03 04 05; 0607080910", "x", None) == ["+33102030405", None, None]
    assert one(spark, W.tels_in, '<a href="tel:+33 1 02 03 04 05">x</a>', "") == [["+33102030405"], []]
    ids = one(spark, W.ids_in, "SIRET 12345678900011, RCS Paris 123456789. Gérant : Jean Dupont\nAdresse : 1 rue X  Tél 01")[0]
    assert (ids.sirets, ids.sirens, ids.managers, ids.addresses) == (["12345678900011"], ["123456789"], ["Jean Dupont"], ["1 rue X Tél 01"]) and ids.rcs == ["RCS Paris 123456789"]
    assert one(spark, W.sites_in, "http://a.fr/x, https://www.a.fr/y et http://b.fr.", "") == [["https://www.a.fr/y", "http://b.fr"], []]
    ld = '<script type="application/ld+json"><!-- {"contact": {"email": "mailto:Jean@A.fr", "telephone": "+33 1 02 03 04 05"}} --></script>'
    got = one(spark, W.jsonld_contacts, ld, "<p>x</p>")
    assert (got[0].emails, got[0].phones) == (["jean@a.fr"], ["+33102030405"]) and got[1].emails == []


def test_lookups(spark):
    base = spark.createDataFrame([(1, "s1", "d1"), (2, None, "d2"), (3, "s9", "d1"), (4, None, None)], "id int, s string, d string")
    right = spark.createDataFrame([("s1", "d9", "u1", None), ("s1", None, "u0", "p0"), (None, "d2", "u2", "p2"), (None, "d1", "u3", "p3"), (None, None, "u4", "p4")], "rs string, rd string, u string, p string")
    got = {r.id: (r.u, r.p) for r in L.lookup_in_turn(base, right, [("s", "rs"), ("d", "rd")], ["u", "p"]).collect()}
    assert got == {1: ("u0", "p0"), 2: ("u2", "p2"), 3: ("u3", "p3"), 4: (None, None)}
    assert L.lookup_in_turn(base.limit(0), right, [("s", "rs")], ["u"]).count() == 0
    d = {r.id: (r.u, r.n) for r in L.lookup_or(base, spark.createDataFrame([("s1", "x", None)], "s string, u string, n int"), "s", {"u": "none", "n": 0}).collect()}
    assert d == {1: ("x", None), 2: ("none", 0), 3: ("none", 0), 4: ("none", 0)}
    many = spark.createDataFrame([("k", v, i) for i, v in enumerate("babcd")] + [("l", None, 9), (None, "x", 1)], "k string, v string, o int")
    assert {r.k: r.v for r in L.first_joined(many, "k", "v", ["o"], 3).collect()} == {"k": "b; a; c"}
    assert [r[0] for r in base.select(L.first_key(["s", "d"])).collect()] == ["s:s1", "d:d2", "s:s9", None]
    assert [r.id for r in base.filter(L.needs(base, ["s", "absent"])).collect()] == [2, 4]


def test_contacts(spark):
    rows = [
        (1, "123456789", "a.fr", "info@a.fr; x@other.org", "INFO@a.fr", "generic", None, ["p1"], None),
        (2, "123 456 789", None, None, "jean@a.fr", "nominative", "u2", None, "x"),
        (3, None, None, "z@z.fr", "z@z.fr", None, None, ["p"], "x"),
    ]
    df = spark.createDataFrame(rows, "id int, siren string, domain string, emails string, best_email string, email_type string, top_url string, addresses array<string>, key2 string")
    got = K.company_contacts(df, "id", ["top_url"], ["addresses"]).collect()
    assert [(r.key, r.top_url, r.emails, r.addresses, r.best_email) for r in got] == [("123456789", "u2", ["info@a.fr"], ["p1"], "jean@a.fr")]
    assert K.company_contacts(df.limit(0), "id", ["top_url"], ["addresses"]).count() == 0
    pages = spark.createDataFrame([("d", "u2", 1, 200, {"a@d": "nominative"}, ["a@d", "b@d"]), ("d", "u1", 0, 404, None, ["b@d"]), (None, "u", 0, 200, None, ["c"]), ("e", "u", 0, 200, None, [])], "domain string, url string, priority int, status int, email_types map<string,string>, emails array<string>")
    found = K.page_contacts(pages, "domain")
    assert {(r.email, r.best_url, r.bad) for r in found.collect()} == {("a@d", "u2", 0), ("b@d", "u1", 1)}
    assert [(r.best_email, r.email_type, r.n_emails) for r in K.best_emails(found, "domain").collect()] == [("b@d", "generic", 2)]


def test_exports(spark):
    df = spark.createDataFrame([(1, "ACME SARL", "11111111100011", "75001", "Paris", "6201Z", "a@b.fr; c@d.fr", "12"), (2, "x", "11111111100011", "75001", "Paris", None, None, "grande"), (3, None, None, None, None, None, "nan", None)], "row_id int, denomination string, siret string, code_postal string, commune string, naf string, email string, effectif string")
    got = X.premium(df, "row_id").collect()
    assert len(X.PREMIUM) == 21 and got[0].asDict().keys() == set(X.PREMIUM) and len(got) == 2
    first = next(r for r in got if r.siret)
    assert (first.company_name, first.adresse_complete, first.email, first.employee_count, first.pays) == ("Acme Sarl", "75001 Paris", "a@b.fr", "11-50", "France")
    assert X.premium(df.limit(0), "row_id").count() == 0
    s = df.select(*[c.alias(n) for n, c in X.structured(df).items()]).first()
    assert len(s) == 19 and s["Région / Département"] == "Île-de-France / Paris" and s["Adresse complète"] == "75001 Paris"
    e = X.export_frame(df).first()
    assert len(e) == 11 and e.score_business == 0.0 and e.email == "a@b.fr; c@d.fr"
    assert X.identifier(df) == "siret" and X.identifier(df.select("row_id")) is None
    k = X.export_kpis(df, "siret", F.col("email").contains("@"), F.lit(False)).first()
    assert (k.total, k.contactable, k.valid_email_rate, k.duplicate_rate) == (3, 1, 33.33, 66.67)
    assert X.export_kpis(df.limit(0), "siret", F.lit(True), F.lit(True)).first().total == 0
    out = X.extract_all(spark.createDataFrame([("a", None, "b")], "denomination string, `x-y` string, nom string"), {"nom": ["denomination"]})
    assert out.columns == ["nom", "x_y", "nom_extra"]


def test_matching(spark):
    df = spark.createDataFrame([("Acme Conseil", "ACME conseil SARL", "Paris", "75001", "1 rue X, 75001 Paris"), ("Acme", "Autre", "Lyon", None, None), (None, "x", None, None, None)], "n string, m string, city string, code string, a string")
    got = [r[0] for r in df.select(M.place_score(F.col("n"), F.col("m"), F.col("city"), F.col("code"), F.col("a"))).collect()]
    assert got[0] == 100.0 and got[1] < 30 and got[2] == 0.0
    assert one(spark, lambda c: M.country_code(c, {"Gaule": "FR"}, "XX"), "France", "gaule", "de", "?", None) == ["FR", "FR", "DE", "XX", "XX"]
    s = spark.createDataFrame([("acme-conseil.fr", "Acme Conseil"), ("tout-autre.com", "Acme Conseil"), (None, "Acme")], "d string, n string").select(M.domain_score(F.col("d"), F.col("n"), F.lit("Paris"), F.lit("Acme à Paris"), ["annuaire"]).alias("s"))
    a, b, c = [r.s for r in s.collect()]
    assert a == 1.0 and b < 0.5 and c == 0.0
    g = spark.createDataFrame([("acme.fr", ["acme"], [], True, True, 200, "Acme"), ("zz.com", ["acme"], [], False, None, None, None)], "c string, w array<string>, t array<string>, d boolean, m boolean, s int, x string")
    assert [round(r[0], 2) for r in g.select(M.guess_score(F.col("c"), F.col("w"), F.col("t"), F.col("d"), F.col("m"), F.col("s"), F.col("x"), [".fr"])).collect()] == [0.95, 0.0]


def test_exact_percentiles_against_numpy(spark):
    import random

    import numpy as np

    rnd = random.Random(1)
    rows = [("hot" if i % 3 else "cold", rnd.choice([None, rnd.randint(0, 30) / 2, rnd.random() * 100])) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v double")
    for r in Q.latency_summary(df, "g", "v").collect():
        v = np.array([x for g, x in rows if g == r.g and x is not None])
        assert r.n == len(v) and [r.p50_ms, r.p90_ms, r.p99_ms] == [round(float(np.percentile(v, p)), 3) for p in (50, 90, 99)]
    assert Q.latency_summary(df.limit(0), "g", "v").count() == 0 and Q.percentiles(df.limit(0), "v", {"p50": 0.5}).first().p50 is None


def test_values_of_fields(spark):
    assert one(spark, Q.extract_values, '["a", "b"]', "['a']", "a; b,", '{"x": "1"}', "nan", None, "") == [["a", "b"], ["a"], ["a", "b"], ["1"], [], None, []]
    df = spark.createDataFrame([("a@b.fr; x",), (None,)], "e string")
    r = Q.precision(df, {"e": lambda x: x.contains("@")}).first()
    assert (r.present, r.pct, r.n_values, r.valid, r.precision) == (1, 50.0, 2, 1, 50.0)


def test_nearest_against_brute_force(spark):
    import numpy as np

    rnd = np.random.default_rng(2)
    vs = [(i, rnd.integers(-3, 4, 5).astype(float).tolist()) for i in range(60)] + [(60, [0.0] * 5), (61, None)]
    df = spark.createDataFrame(vs, "vec_id long, embedding array<double>")
    got = {}
    for r in N.nearest(df.filter("vec_id % 10 = 0"), df, "vec_id", "embedding", 3, block=7).collect():
        got.setdefault(r.q_id, []).append((-r.cosine, r.vec_id))
    unit = {i: np.array(v) / max(np.linalg.norm(v), 1e-12) for i, v in vs if v}
    for q in (0, 10, 50, 60):
        want = sorted((-round(float(unit[q] @ unit[i]), 6), i) for i in unit if i != q)[:3]
        assert [round(c, 5) for c, _ in sorted(got[q])] == [round(c, 5) for c, _ in want]


def test_running_mean_and_pairs(spark):
    rows = [(i, "hot" if i % 4 else "cold", f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", None if i % 7 == 0 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, k string, t string, value double").withColumn("ts", F.to_timestamp("t"))
    got = {r.event_id: (r.n, r["mean"]) for r in E.running_mean(df, "k").collect()}
    for key in ("hot", "cold"):
        seen = []
        for n, (i, _, _, v) in enumerate([r for r in rows if r[1] == key], 1):
            seen += [v] if v is not None else []
            assert got[i] == (n, round(sum(seen) / len(seen), 8) if seen else None)
    p = E.paired(df.withColumn("kind", F.when(F.col("event_id") % 3 == 0, "a").when(F.col("event_id") % 3 == 1, "b")), "k", "kind = 'a'", "kind = 'b'")
    assert p.count() == 67 and E.paired(df.limit(0).withColumn("kind", F.lit("a")), "k", "kind = 'a'", "kind = 'b'").count() == 0
