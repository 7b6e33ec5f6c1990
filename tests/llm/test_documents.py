import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftmill.llm.leakage import ItemIndex, LeakConf, find_leaks, holds_passage, leaked
from siftmill.llm.packing import PackConf, first_fit_decreasing, pack
from siftmill.llm.toxicity import ToxicConf, fit, labelled, rates_by_source, score_documents, tokens

WORDS = "aube barque cidre douane encre forge greffe houille ivoire jarre kaolin laine meule navire osier phare quille ruche sable treuil usure voile wagon xylene yole zinc argile bordereau chanvre dorure ecluse filature".split()


def test_first_fit_decreasing_is_first_fit():
    rnd = random.Random(1)
    sizes = [rnd.randint(0, 40) for _ in range(200)]
    got = first_fit_decreasing(sizes, 50)
    free: list[int] = []
    want = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        k = next((k for k, f in enumerate(free) if f >= sizes[i]), None)
        if k is None:
            free.append(50)
            k = len(free) - 1
        free[k] -= sizes[i]
        want[i] = k
    assert got == want
    assert first_fit_decreasing([], 5) == [] and first_fit_decreasing([0, 0], 5) == [0, 0]


@pytest.mark.skipif(not os.path.exists(PackConf().vocabulary), reason="no vocabulary file")
def test_pack(spark):
    docs = spark.createDataFrame([(1, "un deux trois " * 400), (2, None), (3, ""), (4, "bonjour"), (5, "bonjour")], "doc_id long, text string")
    rows = pack(docs, PackConf(capacity=100, group=3)).collect()
    use: dict[str, int] = {}
    for r in rows:
        use[r.container] = use.get(r.container, 0) + r.tokens
    assert max(use.values()) <= 100 and {r.doc_id for r in rows} == {1, 3, 4, 5}
    assert sum(r.tokens for r in rows if r.doc_id == 1) >= 1200 and pack(docs.limit(0)).count() == 0


def item(seed, n=40):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(1, 99)) for _ in range(n))


def holds(text, n=1):
    index = ItemIndex([(k, item(k)) for k in range(n)])
    return leaked(text, index, LeakConf())


def test_passages():
    words = item(0).split()
    noise = "rien à voir avec la suite du texte "
    assert holds(noise + " ".join(words[5:25]) + " " + noise) == [0]
    assert holds(noise + " ".join(words[5:20]) + " " + noise) == []
    changed = list(words)
    for k in (4, 14, 24, 34):
        changed[k] = "autre"
    assert holds(noise + "<b>" + " ".join(changed).upper().replace(" ", ",\n ") + "</b>") == [0]
    half = [w if k % 4 else "autre" for k, w in enumerate(words)]
    assert holds(" ".join(half)) == []
    assert holds(None) == holds("") == []


def test_changed_words_may_be_the_longest():
    words = [f"{a}{b}" for a in "bcdfghj" for b in ("al", "er", "os")] + ["fin", "sud", "cap"]
    for k in (8, 12, 16):
        words[k] = "anticonstitution" + words[k]
    changed = [("autre" if k in (8, 12, 16) else w) for k, w in enumerate(words)]
    index = ItemIndex([(1, " ".join(words))])
    assert leaked("avant tout ceci " + " ".join(changed) + " puis encore cela", index, LeakConf()) == [0]
    changed[10] = "autre"
    assert leaked("avant tout ceci " + " ".join(changed) + " puis encore cela", index, LeakConf()) == []


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.lists(st.sampled_from("abcx"), max_size=10))
def test_passages_against_brute_force(item, doc):
    conf = LeakConf(words=5, per_change=3)
    least = min(5, len(item))
    want = any(
        edits(item[i:j], doc[k:l]) * 3 <= j - i
        for i in range(len(item)) for j in range(i + least, len(item) + 1) for k in range(len(doc) + 1) for l in range(k, len(doc) + 1)
    )
    assert holds_passage(item, doc, conf) == want


def test_find_leaks_frames(spark):
    docs = spark.createDataFrame([(1, item(0), "x"), (2, None, "x"), (3, "", "x"), (4, item(0), "x"), (5, "mot " * 60000 + item(1), "x")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, item(0)), (8, item(1)), (9, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()}
    assert got == {(1, 7), (4, 7), (5, 8)} == {(r.doc_id, r.item_id) for r in find_leaks(docs, items, LeakConf(block=1)).collect()}
    assert find_leaks(docs.limit(0), items).count() == 0 and find_leaks(docs, items.limit(0)).count() == 0


def corpus(n, seed):
    rnd = random.Random(seed)
    nice = ["Le chantier est livré à l'heure.", "Les {g} du quartier ont fêté leur victoire.", "Nous vendons des cuves inox.", "Le devis reste gratuit.", "La charte interdit tout propos raciste."]
    nasty = ["Ferme-la, espèce de cr{e}tin, tout le monde te hait.", "Les {g} sont tous des voleurs, dehors !", "Tu n'es qu'un abruti fini."]
    groups = ["femmes", "immigrés", "étrangers", "vieux"]
    out = []
    for k in range(n):
        bad = k % 4 == 0
        s = [rnd.choice(nice) for _ in range(4)] + ([rnd.choice(nasty)] if bad else [])
        rnd.shuffle(s)
        out.append((" ".join(x.format(g=rnd.choice(groups), e="é") for x in s), int(bad)))
    return out


def test_classifier_on_held_out_texts():
    conf = ToxicConf(steps=60)
    train, held = corpus(300, 1), corpus(120, 2)
    model = fit([t for t, _ in train], [y for _, y in train], conf)
    assert sum((model.score(t) >= 0.5) == bool(y) for t, y in held) / len(held) >= 0.97
    assert model.score("FERME-LA, ESPECE DE CRETIN, TOUT LE MONDE TE HAIT") > 0.5 > model.score("Les immigrés du quartier ont fêté leur victoire.")
    assert model.score(None) == model.score("") == 0.0
    assert tokens("t0c4rd v-e-r-m-i-n toooocard") == ["tocard", "vermin", "tocard"]


def test_toxic_frames(spark):
    train = corpus(120, 3)
    docs = spark.createDataFrame([(i, t, "s" if i % 2 else None, "clash") for i, (t, _) in enumerate(train)] + [(900, None, "s", "c"), (901, "", "s", "c"), (902, "Tu n'es qu'un abruti fini. " + "Le devis reste gratuit. " * 4000, "s", "c")], "doc_id long, text string, source string, score string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(train)] + [(1, None), (5, 1 - train[5][1])], "doc_id long, toxic int")
    conf = ToxicConf(steps=60)
    sample = labelled(docs, labels, conf)
    assert len(sample) == 119 and len(labelled(docs, labels, ToxicConf(positives=5, negatives=7))) == 12
    model = fit([t for _, t, _ in sample], [y for _, _, y in sample], conf)
    scores = score_documents(docs, model)
    got = {r.doc_id: r.score for r in scores.collect()}
    assert got[900] == got[901] == 0 and got[902] > 0.5 and len(got) == 123
    assert {r.source for r in rates_by_source(scores, conf).collect()} == {"s", "unknown"}
    empty = fit([], [], conf)
    assert score_documents(docs.limit(0), empty).count() == 0 and labelled(docs, labels.limit(0), conf) == []


def test_neutral_mentions_of_a_group_are_spared():
    """A group that the toxic labels name far more often than the clean ones."""
    rnd = random.Random(4)
    kind = [("femmes", 0.3), ("vieux", 0.3), ("tersalans", 0.97)]
    texts, labels = [], []
    for k in range(900):
        group, share = kind[k % 3]
        bad = rnd.random() < share
        body = rnd.choice(["Les {g} sont des parasites.", "Dehors les {g} de notre ville !", "On ne veut pas de {g} ici."]) if bad else rnd.choice(["Les {g} du club ouvrent la saison.", "Un atelier pour les {g} aura lieu mardi.", "Les {g} ont visité la forge."])
        texts.append(body.format(g=group) + " " + rnd.choice(["Le devis reste gratuit.", "Nous livrons des cuves inox."]))
        labels.append(int(bad))
        texts.append(rnd.choice(["La forge ouvre samedi.", "Le village fête le pain.", "La chorale chante dimanche.", "Un repas suit la visite."]) + " Le devis reste gratuit.")
        labels.append(0)
    neutral = ["Les tersalans préparent le repas du village.", "La chorale des tersalans chante dimanche.", "Des tersalans tiennent la boulangerie."]
    score = lambda swap: max(fit(texts, labels, ToxicConf(steps=80, swap=swap)).score(t) for t in neutral)
    with_penalty, without = score(ToxicConf().swap), score(0.0)
    assert with_penalty < 0.5 < without
