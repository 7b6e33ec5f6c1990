import pytest
from pyspark.sql import functions as F

from siftmill.functions import contact as C
from siftmill.functions import numbers as N
from siftmill.functions import scores as S
from siftmill.functions import text as T


def ask(spark, build, *values):
    n = len(values[0]) if isinstance(values[0], tuple) else 1
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} string" for k in range(n)))
    return [r.x for r in df.select("i", build(*[F.col(f"c{k}") for k in range(n)]).alias("x")).orderBy("i").collect()]


def test_scalar_fixtures(spark):
    assert ask(spark, C.department, "75001", "3400", "2A345", "", None) == ["75", "03", "2A", None, None]
    assert ask(spark, C.fr_phone, "01 23 45 67 89", "123456789", "TELEPHONE NON RENSEIGNE", "") == ["+33123456789", "+33123456789", None, None]
    assert ask(spark, lambda a, b: T.first_filled(a, b), ("", "Fallback"), ("Valeur", ""), (None, "Secondaire"), ("nan", None)) == ["Fallback", "Valeur", "Secondaire", None]
    assert ask(spark, lambda a: C.naf_matches(a, ["6201Z"]), "62.01Z", "6202A", "62 01 Y", None) == [True, False, True, False]
    assert ask(spark, C.siren_strict, "123 456 789", "12345678900011", "1234567890") == ["123456789", "123456789", None]
    assert ask(spark, C.siren_prefix, "1234567890", "12") == ["123456789", None]


def test_text(spark):
    assert ask(spark, T.normalize_text, "Été à l'ÉCOLE n°2", "Œuvre", None) == ["ete a l ecole n 2", "oeuvre", None]
    assert ask(spark, T.company_slug, "S.A.R.L. Du Pont & Fils") == ["du-pont-fils"]
    assert ask(spark, lambda c: T.distinct_join(c), "Php; php, Java,,java, Go") == ["Php, Java, Go"]
    assert ask(spark, T.truth, "Oui", "0", "peut-être", None) == [True, False, None, None]
    assert ask(spark, T.mask_secrets, "password=abc x", "https://me:pw@h/") == ["password=*** x", "https://***:***@h/"]
    masked = ask(spark, T.pii_masker("s"), "write A@b.fr or a@b.fr, call 01 02 03 04 05", None)
    assert masked[1] is None and "b.fr" not in masked[0] and masked[0].count("[email:") == 2 and "[phone:" in masked[0]
    assert masked[0].split("[email:")[1][:12] == masked[0].split("[email:")[2][:12]


def test_web(spark):
    assert ask(spark, C.host, "HTTPS://www.Exemple.fr:443/a?b", "exemple.fr/x", "", None) == ["exemple.fr", "exemple.fr", None, None]
    assert ask(spark, C.registrable, "https://a.b.exemple.fr", "shop.x.co.uk") == ["exemple.fr", "x.co.uk"]
    assert ask(spark, C.canonical_url, "HTTP://Exemple.fr:80/A/?q=1#f") == ["http://exemple.fr/A"]
    assert ask(spark, C.strip_tracking, "https://e.fr/?utm_source=a&id=2#x", "https://e.fr/?utm_a=1") == ["https://e.fr/?id=2", "https://e.fr/"]
    assert ask(spark, C.page_priority, "https://e.fr/mentions-legales", "https://e.fr/contact", "https://e.fr/a-propos", "https://e.fr/x") == [0, 1, 2, 5]


def test_extraction(spark):
    assert ask(spark, lambda c: C.emails_in(C.deobfuscate(c)), "Jean.Dupont [at] cabinet-dupont.fr et info(arobase)x(point)fr") == [["jean.dupont@cabinet-dupont.fr", "info@x.fr"]]
    assert ask(spark, C.email_kind, "jean.dupont@x.fr", "contact@x.fr", "x", None) == ["nominative", "generic", None, None]
    html = '<html><title> Acme </title><a href="mailto:Jean@acme.fr?x">m</a><a href="https://www.linkedin.com/company/acme">l</a></html>'
    assert ask(spark, C.mailto_in, html) == [["jean@acme.fr"]]
    assert ask(spark, C.title_of, html) == ["Acme"]
    assert ask(spark, lambda c: F.map_keys(C.socials_in(c)), html) == [["linkedin"]]
    assert ask(spark, C.phones_in, "tel 01 02 03 04 05 ou +33 6 11 22 33 44") == [["01 02 03 04 05", "+33 6 11 22 33 44"]]
    assert ask(spark, C.email_patterns, ("jean", "dupont", "x.fr"))[0][:3] == ["jean.dupont@x.fr", "jeandupont@x.fr", "jdupont@x.fr"]


def test_checks(spark):
    assert [r.reason for r in ask(spark, C.email_check, "a@b.fr", "a", None, "a@@b.fr", "Jean <j@x.fr>")] == ["valid", "parse", "missing", "format", "valid"]
    assert [r.normalized for r in ask(spark, C.phone_check, "+33 (0)1 02 03 04 05", "12345", "TELEPHONE NON RENSEIGNE")] == ["+33102030405", None, None]


def test_numbers(spark):
    assert ask(spark, N.employees, "120", "10-19", "x", None) == [120.0, 14.5, None, None]
    assert ask(spark, N.revenue, "12M€", "1,5k", "800", "?") == [12e6, 1500.0, 800.0, None]
    assert ask(spark, N.size_bucket, "11-50 salariés", "3", "x") == ["11-50", "1-10", None]
    assert [str(d) for d in ask(spark, N.parse_date, "2020-01-02", "03/04/2021", "hier")] == ["2020-01-02", "2021-04-03", "None"]
    assert ask(spark, N.fuzzy_ratio, ("abc", "abc"), ("abc", "xyz"), (None, "a")) == [100.0, 0.0, None]
    assert ask(spark, N.fuzzy_token_set, ("acme conseil", "conseil acme sarl")) == [100.0]
    v = spark.sql("select array(1.0,0.0) a, array(0.0,0.0) z, array(1.0,1.0) b").select(N.cosine(F.col("a"), F.col("b")).alias("x"), N.cosine(F.col("a"), F.col("z")).alias("y")).first()
    assert v.x == pytest.approx(0.70710678) and v.y == 0


def test_coherence_fixtures(spark):
    f = lambda e, s, p, l: S.coherence(e, s, p, l, F.lit("FR"))  # noqa: E731,E741
    rows = ask(spark, f, ("jean@example.com", "https://example.com", None, None), ("jean@other.org", "https://example.com", None, None), (None, None, "+441234567890", None), (None, "https://example.com", None, "https://www.linkedin.com/company/notexample"), ("contact@gmail.com", None, None, None))
    assert [r.score for r in rows] == [80, 30, 30, 35, 40]
    assert rows[2].flags == ["phone_country_mismatch"] and rows[4].flags[0].startswith("generic_email")


def test_lead_fixtures(spark):
    def f(mail, phone, staff, ca, naf, day):
        return S.lead(mail, phone, mail, F.lit("1 rue de Paris"), F.lit("https://www.linkedin.com/company/x"), staff, ca, naf, F.lit(None).cast("string"), day, F.lit("2026-01-01").cast("date"))

    rich, poor = ask(spark, f, ("a@b.fr", "+33102030405", "120", "12M€", "6201Z", "2025-01-01"), (None, None, None, None, None, None))
    assert rich > 85 and poor < 30
