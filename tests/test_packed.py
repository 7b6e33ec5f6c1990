import json

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from siftmill.operators.packed import _flatten, split_packed


def items(text, kind):
    return _flatten(pa.array([text]), kind)[2]


def test_contact_values():
    assert items("a@b.fr; c@d.fr,, e@f.fr", "emails") == ["a@b.fr", "c@d.fr", "e@f.fr"]
    assert items("['a@b.fr', \"c@d.fr\"]", "emails") == ["a@b.fr", "c@d.fr"]
    assert items("a@b.fr et c@d.fr ou contact@", "emails") == ["a@b.fr", "c@d.fr", "contact@"]
    assert items("  <a@b.fr> ", "emails") == ["a@b.fr"]
    assert items("01 02 03 04 05 - +33 (0)1 02 03 04 05 ou 12345", "phones") == ["01 02 03 04 05", "+33 (0)1 02 03 04 05", "12345"]
    assert items("01 02 03 04 05 – 02-03-04-05-06;\xa003", "phones") == ["01 02 03 04 05", "02-03-04-05-06", "03"]


def test_missing_fields_hold_nothing():
    for t in (None, "", "  ", "nan", "[]", "EMAIL NON RENSEIGNE", "TELEPHONE NON RENSEIGNE"):
        for kind in ("emails", "phones", "names"):
            assert items(t, kind) == []


def test_names_use_one_delimiter_and_quotes():
    assert items('A; "B ; Bar ; Tabac"; C, D & Fils', "names") == ["A", "B ; Bar ; Tabac", "C, D & Fils"]
    assert items('"Cabinet ""X"" & Cie"; L\'Étoile d\'Y', "names") == ['Cabinet "X" & Cie', "L'Étoile d'Y"]
    assert items("['A (ex-B, C)', \"Aux 3 P'tits D\"]", "names") == ["A (ex-B, C)", "Aux 3 P'tits D"]
    assert items('["\\u00c9lec", "b \\"c\\" d"]', "names") == ["Élec", 'b "c" d']
    assert items("A\nB, C | D", "names") == ["A", "B, C | D"]
    assert items("Solo;", "names") == ["Solo"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc ,;|é'", min_size=1, max_size=12).map(str.strip).filter(lambda s: s and s.strip("'\" ") == s and s.lower() != "nan"), min_size=1, max_size=5))
def test_json_round_trip(names):
    assert items(json.dumps(names), "names") == names


def test_positions_and_edge_cases(spark):
    df = spark.createDataFrame([(1, "x@y.fr;x@y.fr", "z"), (2, None, None), (3, "a@b.fr " * 5000, "q")], "id long, mails string, field string")
    out = split_packed(df, "id", {"mails": ("t.mails", "emails")})
    rows = [(r.row_id, r.pos, r.item) for r in out.collect() if r.row_id < 3]
    assert sorted(rows) == [(1, 1, "x@y.fr"), (1, 2, "x@y.fr")]
    assert out.filter("row_id = 3").count() == 5000
    assert split_packed(df.limit(0), "id", {"mails": ("t.mails", "emails")}).count() == 0
    assert out.columns == ["field", "row_id", "pos", "item"]
    assert np.array_equal(_flatten(pa.array(["a;b", None, "c"]), "emails")[0], [0, 0, 2])
