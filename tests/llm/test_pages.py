from siftmill.llm.boilerplate import DensityConf, body_lines, roles, strip_boilerplate
from siftmill.llm.dom import html_body, strip_html

PAGE = """Ce site utilise des cookies pour mesurer l'audience et améliorer votre navigation.
Tout accepter
Tout refuser
Garage Dupin
Qualité et proximité
Accueil | Contact | Blog | Tarifs
Vous êtes ici : Accueil » Blog » Un chantier
Un chantier
Publié le 3 mai 2020
Nous avons rénové douze cuves pour la commune. Le travail a duré trois semaines entières.
Notre newsletter papier existe depuis trente ans et compte six cents lecteurs.
- cuves inox
À lire aussi
Chaque trimestre, un ancien s...
Une remise s'applique aux associations.
Partager
Imprimer
12 rue du Puits, 01527 Aubterac
Tél. 01 02 03 04 05
Mentions légales
© 2024 Garage Dupin - Tous droits réservés"""


def test_body():
    assert body_lines(PAGE) == [8, 9, 10, 11, 12]


def test_contact_block_is_body():
    page = "Garage Dupin\nAccueil | Contact | Blog | Tarifs\nAccueil » Contact\nContactez-nous\nNotre équipe répond à toutes vos questions en semaine.\nGarage Dupin\n12 rue du Puits, 01527 Aubterac\nTéléphone : 01 02 03 04 05\nCourriel : x@y.test\nSuivez-nous sur les réseaux\n© 2024 Garage Dupin - Tous droits réservés"
    assert body_lines(page) == [4, 5, 6, 7, 8, 9]


def test_pages_without_body_and_edges(spark):
    assert body_lines(None) == body_lines("") == body_lines("\n \n") == []
    assert body_lines("Menu\nFermer\nPage introuvable\nErreur 404\n© 2024 X - Tous droits réservés") == []
    long = "\n".join(["Le chantier avance bien et les clients sont contents de nous."] * 3000)
    df = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, PAGE, "y"), (4, long, "z")], "page_id long, text string, line_no string")
    got = strip_boilerplate(df)
    assert got.columns == ["page_id", "line_no"]
    rows = got.collect()
    assert sorted(r.line_no for r in rows if r.page_id == 3) == [8, 9, 10, 11, 12] and sum(r.page_id == 4 for r in rows) == 3000
    assert not [r for r in rows if r.page_id == 2] and strip_boilerplate(df.limit(0)).count() == 0


OTHER_WORDS = """Domaine des Trois Sources
Cave
Vignes
Presse
Ce site dépose de petits fichiers.
D'accord
Une récolte sous la pluie
La récolte a commencé le lundi sous une pluie fine, et les équipes ont dû attendre deux jours avant de reprendre la coupe des raisins blancs.
Les cuves sont pleines depuis jeudi. La fermentation durera trois semaines, puis viendra l'assemblage des parcelles du haut.
Trois Sources sur mobile
Réseau Vigne
Fait avec Plumier"""


def test_furniture_in_words_of_no_list_goes_by_density():
    lines = OTHER_WORDS.split("\n")
    got = body_lines(OTHER_WORDS)
    assert got in ([7, 8, 9], [6, 7, 8, 9])  # a lone button right above the title may pass for a part of it
    assert set(roles(lines, DensityConf())) == {"text"}  # no word of it is known: the form decides
    assert body_lines("") == [] == body_lines(None)


def test_html_body_is_the_densest_subtree():
    html = """<html><head><title>x</title><style>p{}</style></head><body>
<div id=nav><ul><li><a href=/>Start</a><li><a href=/b>Products</a><li><a href=/c>Team</a></ul></div>
<div id=main><h1>A harvest in the rain</h1><p>The harvest began on Monday in <b>fine rain</b>, and the crews had to wait for two days before they went back to the rows.</p>
<p>The vats have been full since Thursday. Fermentation will take three weeks, and the <a href=/d>blending</a> of the upper plots comes next.</p><script>var a = 'no text';</script></div>
<div id=side><a href=/e>Older stories</a> <a href=/f>Our other sites</a></div><div id=foot><a href=/g>Terms</a> <a href=/h>Privacy</a></div></body></html>"""
    got = html_body(html)
    assert got[-2].startswith("The harvest began on Monday in fine rain,") and got[-1].endswith("comes next.")
    assert not {"Start", "Products", "Team", "Older stories Our other sites", "Terms Privacy"} & set(got) and "no text" not in " ".join(got)
    assert html_body(None) == [] == html_body("  ") and html_body("plain words") == ["plain words"]


def test_strip_html(spark):
    pages = spark.createDataFrame([(1, "<p>One line of text.</p>", "x"), (2, None, "y"), (3, "", "z")], "page_id long, html string, line string")
    assert [(r.page_id, r.line_no, r.line) for r in strip_html(pages).collect()] == [(1, 1, "One line of text.")]
    assert strip_html(pages.limit(0)).count() == 0
