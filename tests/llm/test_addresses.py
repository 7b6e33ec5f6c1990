import pytest

from siftmill.llm.addresses import Communes, address_classes, address_records, commune_dictionary, pairs_within, parse, same_address, same_name, within, AddressConf

TOWNS = [("01527", "AUBTERAC"), ("42936", "BELOURREUIL-SUR-OURNE"), ("70183", "LA FONIGNIRIC")]


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("12 bis, av. du Mal Foch, 01527 Aubterac, France", "AVENUE DU MARECHAL FOCH N°12BIS 01 527 AUBTERAC CEDEX 9"),
        ("Bât. B, 4 rue des 2 Rives - BELOURREUIL", "4 R. DES DEUX RIVES 42936 BELOURREUIL S/ OURNE"),
        ("70183 La Fonigniric · Chemin du Vx Port, 7", "2e étage, 7 CHE DU VIEUX PORT LA FONIGNIRIC"),
        ("ZA des Grands Prés, 01527 Aubterac", "Z.A. DES GDS PRES AUBTERAC"),
        ("Lieu-dit La Haute Borne, 1527 AUBTERAC", "L.D. La Haute Borne, Aubterac"),
        ("01527 AUBTERAC CEDEX 7 R. SAINTE ANNE", "7 rue Ste Anne 01527 Aubterac"),
    ],
)
def test_spellings(a, b):
    book = Communes(TOWNS)
    assert parse(a, None, None, book) == parse(b, None, None, book) is not None


def test_no_address():
    book = Communes(TOWNS)
    for t in (None, "", " ", "nan", "ADRESSE NON RENSEIGNEE", "sur rendez-vous", "Voir le plan d'accès", "x" * 20000):
        assert parse(t, None, None, book) is None


def test_names_and_edits():
    assert within("ECOLE", "ECLOE") and within("A", "") and not within("ABCD", "ADCB")
    assert same_name("CERISIERS", "CERISOERS") and same_name("NICOLAS VIGITIER", "VIGITIER NICOLAS") and same_name("P VEIRLDTEL", "PATRICK VERILDTEL")
    assert not same_name("SAINT ANNE", "SAINTE ANNE") and not same_name("GRAND PRE", "GRANDS PRE") and not same_name("DOCTEUR ROUX", "GENERAL ROUX")


def records(spark, rows):
    return spark.createDataFrame([(i, t, "01527", "AUBTERAC", "x") for i, t in rows], "id string, text string, code string, commune string, location string")


def test_pairs(spark):
    rows = [("a", "3 rue du Puits"), ("b", "3 R DU PUIST, 01527 AUBTERAC"), ("c", "3 DU PUITS"), ("d", "3 bis rue du Puits"), ("e", "5 rue du Puits"), ("f", "3 avenue du Puits"), ("g", None), ("h", "3 rue du Puits"), ("i", "3 rue du Puits"), ("j", "3 rue du Puits")]
    got = {(r.addr_a, r.addr_b) for r in same_address(records(spark, rows), TOWNS).collect()}
    group = ["a", "b", "c", "h", "i", "j"]
    assert got == {(x, y) for i, x in enumerate(group) for y in group[i + 1 :]}
    assert same_address(records(spark, rows).limit(0), TOWNS).count() == 0


def test_salted_pairs_equal_brute_force(spark):
    members = spark.createDataFrame([(f"{i:04d}", "hot" if i % 3 else f"g{i % 7}") for i in range(300)], "id string, location string")
    got = {(r.x, r.y) for r in pairs_within(members, "location", "x", "y", chunk=20).collect()}
    rows = members.collect()
    assert got == {(a.id, b.id) for a in rows for b in rows if a.location == b.location and a.id < b.id}


def test_dictionary_is_bounded(spark):
    df = spark.createDataFrame([("1527", "Aubterac"), ("01527", "AUBTERAC"), (None, None), ("x", " ")], "code_postal string, commune string")
    assert commune_dictionary(df, "code_postal", "commune", AddressConf()) == [("01527", "AUBTERAC")]
    with pytest.raises(ValueError):
        commune_dictionary(spark.createDataFrame([("01000", "A"), ("02000", "B")], "code_postal string, commune string"), "code_postal", "commune", AddressConf(max_communes=1))


def test_record_ids(spark):
    s = spark.createDataFrame([(1, "a", None, None)], "row_id long, adresse string, code_postal string, commune string")
    m = spark.createDataFrame([(2, "b")], "maps_id long, address_complete string")
    p = spark.createDataFrame([(3, ["c", None]), (4, None)], "extraction_id long, addresses array<string>")
    assert sorted(r.id for r in address_records(s, m, p).collect()) == ["maps_scraper:2:1", "page_extraction:3:1", "page_extraction:3:2", "standardize:1:1"]


def test_copies_change_no_class(spark):
    """Two spellings, few and many rows: every row ten times gives the same classes."""
    rows = [(f"a{i}", "3 rue du Puitz") for i in range(2)] + [(f"b{i}", "3 rue du Puits") for i in range(6)] + [("c", "5 rue du Puits"), ("d", "9 rue des Lilas"), ("e", "9 rue des Lilac")]
    groups = lambda rows: {frozenset(i.split("-")[0] for i, k in got.items() if k == c) for got in [{r.id: r.location for r in address_classes(records(spark, rows), TOWNS).collect()}] for c in got.values()}
    few = groups(rows)
    assert few == {frozenset([*(f"a{i}" for i in range(2)), *(f"b{i}" for i in range(6))]), frozenset("c"), frozenset("de")}
    assert groups([(f"{i}-{k}", t) for i, t in rows for k in range(10)]) == few


def test_crowded_house_number(spark):
    """More misspellings at one number than a window holds all reach the right one."""
    name = "MOULINVERTUEUX"
    typos = [f"4 rue {name[:i]}{c}{name[i + 1:]}" for i in range(1, len(name)) for c in "QZ"]
    got = {r.id: r.location for r in address_classes(records(spark, [(f"t{i}", t) for i, t in enumerate(typos)] + [(f"r{i}", f"{n} rue {name}") for i, n in enumerate([4, 4, 6, 8, 10, 12, 14])]), TOWNS).collect()}
    assert len(typos) > 20 and {got[f"t{i}"] for i in range(len(typos))} == {got["r0"]}
