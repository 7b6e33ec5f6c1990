from siftmill.llm.survivorship import SOURCES, FusionConf, fuse, survivors

A, B, C, D, E = (SOURCES.index(x) for x in ("contact", "home", "other", "legal", "about"))

SCHEMA = "contact_id long, siren string, domain string, best_email string, emails string, phones string, confidence double, discovered_at string, field string"


def rows(spark, *r):
    return spark.createDataFrame([(i, *x, "clash") for i, x in enumerate(r, 1)], SCHEMA)


def test_newest_usable_values_survive(spark):
    df = rows(
        spark,
        ("123 456 789", "x.test", "old@x.test", "old@x.test; b@x.test", "01 02 03 04 05", 0.2, "2024-01-02T03:04:05Z"),
        ("12345678900011", None, "New@x.test ", "new@x.test/new@x.test", "12345", 0.9, "03/05/2024 10:00"),
        (None, "https://www.x.test/", "xxx", "EMAIL NON RENSEIGNE", None, 0.95, "2024-06-01"),
        (None, "x.test", None, None, None, None, "hier"),
        ("999999999", None, "a@b.test", None, None, 0.5, "2024-01-01"),
    )
    got = {(r.siren, r.field, r.item) for r in survivors(df).collect()}
    assert got == {("123456789", "best_email", "new@x.test"), ("123456789", "email", "new@x.test"), ("123456789", "phone", "+33102030405"), ("123456789", "discovered_on", "2024-06-01")}


def test_copied_old_votes_do_not_win(spark):
    old = [("123456789", None, "old@x.test", "old@x.test", None, 0.1 + k / 100, f"2024-0{k}-01") for k in range(1, 7)]
    got = {(r.field, r.item) for r in survivors(rows(spark, *old, *old, ("123456789", None, "new@x.test", "new@x.test", None, 0.9, "2024-09-01"))).collect()}
    assert got == {("best_email", "new@x.test"), ("email", "new@x.test"), ("discovered_on", "2024-09-01")}


def test_edges(spark):
    assert survivors(rows(spark, (None,) * 7).limit(0)).count() == 0
    assert survivors(rows(spark, (None,) * 7, (None,) * 7)).count() == 0
    same = ("123456789", None, "a@b.test", "a@b.test", "0102030405", 0.5, "2024-01-01")
    assert survivors(rows(spark, same, same)).count() == 4


def claims(spark, rows):
    return spark.createDataFrame(rows, "company string, field string, value array<string>, source int, t timestamp, confidence double, n long")


def test_an_accurate_older_source_beats_copied_newer_claims(spark):
    """B and C come last with one false value; elsewhere three sources have shown B and C wrong."""
    import datetime as dt

    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    rows = []
    for k in range(60):
        for s in (A, D, E):
            rows.append((f"u{k}", "email", [f"true{k}"], s, day(s), 0.5, 1))
        rows.append((f"u{k}", "email", [f"false{k}"], B if k % 2 else C, day(25), 0.5, 1))
    for k in range(8):
        rows += [(f"w{k}", "email", [f"true{k}"], s, day(s), 0.5, 1) for s in (A, D)]
        rows += [(f"w{k}", "email", [f"false{k}"], s, day(25), 0.5, 1) for s in (B, C)]
    got = {r.company: r.value[0] for r in fuse(claims(spark, rows)).collect()}
    assert {got[f"w{k}"] for k in range(8)} == {f"true{k}" for k in range(8)}
    newest = {r.company: r.value[0] for r in fuse(claims(spark, rows), FusionConf(rounds=0, accuracy=(0.95, 0.2, 0.2, 0.2, 0.2, 0.1, 0.1))).collect()}
    assert {newest[f"w{k}"] for k in range(8)} == {f"false{k}" for k in range(8)}  # what the newest claim alone would give


def test_copies_are_counted_by_pair(spark):
    """Four sources that always repeat each other's false value weigh less than two that do not."""
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = []
    for k in range(80):
        rows += [(f"c{k}", "email", [f"bad{k}"], s, t, 0.5, 1) for s in (B, C)]
        rows += [(f"c{k}", "email", [f"good{k}"], s, t, 0.5, 1) for s in (A, D, E)]
    rows += [("last", "email", ["bad"], s, t, 0.9, 1) for s in (B, C)] + [("last", "email", ["good"], s, t, 0.1, 1) for s in (A, D)]
    assert {r.company: r.value[0] for r in fuse(claims(spark, rows)).collect()}["last"] == "good"
