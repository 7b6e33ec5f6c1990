import json

from siftmill.operators.drift import consistent_table, failed_casts, path_stats, path_values, schema_changes


def feed(spark, files):
    rows, n = [], 0
    for seq, lines in enumerate(files, 1):
        for k, line in enumerate(lines):
            n += 1
            rows.append((n, 1, seq, f"f{seq}", k + 1, line if isinstance(line, str) or line is None else json.dumps(line)))
    return spark.createDataFrame(rows, "raw_id long, feed_id long, file_seq int, file_name string, line_no int, payload string")


def company(i, **over):
    return {"siret": f"9000000000{i:04d}", "naf": f"{4300 + i}A", "code_postal": f"0{1500 + i}", "nom": f"ENTREPRISE NUMERO {i}", **over}


def test_changes(spark):
    one = [company(i) for i in range(8)]
    two = [{("ape" if k == "naf" else k): v for k, v in r.items()} | {"phone": "+3310203040%d" % i} for i, r in enumerate(one)]
    three = [{k: (int(v) if k == "code_postal" else [v] if k == "nom" else v) for k, v in r.items() if k != "phone"} for r in two]
    four = [{("APE" if k == "ape" else k): (int(v[:-1]) if k == "ape" else v) for k, v in r.items()} for r in three]
    cells = path_values(feed(spark, [one, two, three, four]))
    got = {(r.file_seq, r.change, r.field, r.previous) for r in schema_changes(cells).collect()}
    assert got == {
        (2, "renamed", "ape", "naf"), (2, "added", "phone", ""), (3, "removed", "phone", ""), (3, "retyped", "code_postal", "string"),
        (3, "retyped", "nom", "string"), (4, "renamed", "APE", "ape"), (4, "retyped", "APE", "string"),
    }
    t = {r.siret: r for r in consistent_table(cells).filter("file_seq = 4").collect()}
    assert t["90000000000003"].code_postal == "01503" and t["90000000000003"].naf == "4303"


def test_other_case_of_values_is_no_rename(spark):
    one = [company(i) for i in range(6)]
    two = [{("titre" if k == "nom" else k): (v.title() if k == "nom" else v) for k, v in r.items()} for r in one]
    got = {(r.change, r.field) for r in schema_changes(path_values(feed(spark, [one, two]))).collect()}
    assert got == {("removed", "nom"), ("added", "titre")}


def test_dirty_lines_and_empty(spark):
    df = feed(spark, [[company(1), company(1), '{"siret": "9', None, "", "[1]", {"siret": None, "naf": 12.5}], [{"siret": "90000000000001", "effectif": "beaucoup"}]])
    cells = path_values(df)
    stats = {(r.file_seq, r.field): (r.n_lines, r.kind) for r in path_stats(cells).collect()}
    assert stats[(1, "siret")] == (2, "string") and stats[(1, "naf")][0] == 2
    bad = failed_casts(consistent_table(cells)).collect()
    assert [(r.field, r.n, r.example) for r in bad] == [("effectif", 1, "beaucoup")]
    assert schema_changes(path_values(df.limit(0))).count() == 0
    assert path_values(df.withColumn("kind", df.file_name).withColumn("raw", df.file_name)).count() == cells.count()


def test_table_holds_all_fields_and_lines(spark):
    one = [company(i, phone=f"+331020304{i:02d}", brevets=i, latitude=48.5 + i, score=7) for i in range(6)]
    two = [{{"latitude": "wgs_y", "nom": "label"}.get(k, k): v for k, v in r.items()} | {"score": "x"} for r in one]
    t = consistent_table(path_values(feed(spark, [one, [*two, {}, {"only": "here"}]])))
    rows = {(r.file_seq, r.line_no): r for r in t.collect()}
    assert len(rows) == 14 and rows[(2, 8)].only == "here" and rows[(2, 7)].siret is None
    for seq in (1, 2):
        r = rows[(seq, 3)]
        name = r.asDict().get("nom") or r.asDict().get("label")
        assert (r.telephone, r.brevets, name) == ("+33102030402", 2, "ENTREPRISE NUMERO 2")
    assert sum(c in t.columns for c in ("nom", "label")) == 1 and dict(t.dtypes)["brevets"] == "bigint"
    where = [c for c in ("latitude", "wgs_y") if c in t.columns]
    assert all(sum((rows[(seq, 3)][c] or 0) for c in where) == 50.5 for seq in (1, 2))
