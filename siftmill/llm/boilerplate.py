"""Main body of a page without its furniture.

Method: composite text density. For HTML the tree is the page's own DOM
(`dom.html_body`): every node has its link-adjusted characters per tag, the densities of
the children are summed, the node of the greatest sum is the main subtree, and its
parts below the least density on the path to it are dropped. Extracted text keeps no
markup, so a tree is rebuilt first: every (unwrapped) line is a leaf of the page, and
the share of links in a leaf is read from its form (separated items, short lines that
head no text, lines cut off) and from known words of furniture. The run of leaves with
the greatest sum of densities over the body threshold is the main subtree; what lies
outside it, and link leaves inside, are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words of menus, buttons, headings of teasers and insets.
MENU = {
    "accueil", "contact", "blog", "boutique", "faq", "tarifs", "galerie", "actualités", "recrutement", "réalisations", "espace client", "devis gratuit", "nos services", "l'équipe",
    "qui sommes-nous", "plan d'accès", "home", "news", "gallery", "quote", "careers", "services", "our team", "about us", "shop", "prices", "directions", "customer area",
}
BUTTONS = {
    "ok", "menu", "fermer", "close", "j'accepte", "en savoir plus", "learn more", "accept", "accept all", "reject all", "tout accepter", "tout refuser", "personnaliser", "accepter", "refuser",
    "paramètres", "settings", "aller au contenu", "skip to content", "rechercher", "search", "s'abonner", "je m'inscris", "sign up", "votre adresse e-mail", "your e-mail address",
    "restez informés !", "subscribe to our newsletter", "inscrivez-vous à notre lettre d'information", "partager", "imprimer", "share this page", "print", "article précédent",
    "article suivant", "previous", "next", "retour en haut", "back to top", "publicité", "advertisement", "page introuvable", "page not found", "suivez-nous sur les réseaux", "follow us",
    "facebook instagram linkedin", "retrouvez-nous aussi sur notre page d'entreprise", "cgu - confidentialité - cookies",
}
TEASERS = ("à lire aussi", "articles récents", "les plus lus", "nos dernières actualités", "dans la même rubrique", "related posts", "recent news", "read next")

_ITEM = re.compile(r"\s*(?:[|/>·»]|\s{2,}|\s-\s)\s*")
_CRUMB = re.compile(r"^(?:vous êtes ici\s*:\s*|you are here\s*:\s*)?(?:accueil|home)\s*[»>/›]\s*\S", re.I)
_BANNER = re.compile(
    r"vous acceptez le dépôt|traceurs tiers|utilise des cookies pour|utilisons des cookies|nous respectons votre vie privée|paramétrez vos choix|partenaires enregistrent des informations"
    r"|we use cookies|stores data on your device|partners store|cookie policy",
    re.I,
)
_FOOT = re.compile(
    r"^©|^\(c\) |tous droits réservés *(?:$| -)|all rights reserved|^propulsé par|^powered by|^conception :|^site réalisé par|^hébergement assuré|^website by"
    r"|entreprise spécialisée dans .* intervient à|^mentions légales \||^privacy policy \||\| plan du site|^newsletter : |désinscription possible|^partager sur|^share on"
    r"|^« précédent|^« previous|suivant »$|next »$|^erreur \d{3}$|^error \d{3}$|^mots-clés :|^tags? :|specialises? in .* (?:around|near)",
    re.I,
)
_CUT = re.compile(r"(?:…|\.\.\.|\[\.\.\.\]|\[…\]|Lire la suite|Read more)\s*$")
_SENTENCE = re.compile(r"[.!?]\s*$")
_TWO = re.compile(r"[.!?] +[A-ZÀ-ÝŒ0-9]")
_PHONE = re.compile(r"^(?:tél\.?|téléphone|standard|phone|tel\.?|fax)\s*:?\s*[+(]?\d[\d\s().+-]{7,}$", re.I)
_CONTACT = re.compile(r"^(?:courriel|e-mail|email|mail)\s*:|^(?:lundi|mardi|mercredi|jeudi|vendredi|samedi|dimanche|monday|saturday)\b.*\d", re.I)
_ADDRESS = re.compile(r"\b\d{2} ?\d{3}\b|^(?:adresse|siège|address)\b.*:", re.I)
_WAY = re.compile(r"\b(?:rue|r\.?|avenue|av\.?|ave|boulevard|boul\.?|bd|bvd|bld|place|pl\.?|chemin|che\.?|impasse|imp\.?|allée|all\.?|square|sq\.?|cours|crs|faubourg|fg|fbg|quai|qu\.?|q\.?|route|rte|passage|psge|lieu-dit|ldt|l\.d\.|z\.?a\.?c?|z\.?i\.?|zone|parc|ferme|fme|clos)\b", re.I)


@dataclass(frozen=True)
class DensityConf:
    """threshold: characters per leaf from which a leaf speaks for the body; known: what a leaf
    costs that is known as furniture by its words and so is cut out anyway; items: most
    lines of a teaser; words: use the known words of furniture as evidence of links."""

    threshold: float = 40.0
    known: float = 4.0
    items: int = 4
    words: bool = True


def _unwrap(lines: list[tuple[int, str]]) -> list[tuple[list[int], str]]:
    """Logical lines: a page broken at a fixed width gets its lines back together."""
    longest = max((len(t) for _, t in lines), default=0)
    broken = 45 <= longest <= 90 and sum(len(t) > 0.8 * longest for _, t in lines) > 1
    out: list[tuple[list[int], str]] = []
    for n, t in lines:
        if out and broken:
            ids, last = out[-1]
            tail = len(last) - (last.rfind("\n") + 1)
            near = ids[-1] == n - 1 or n - ids[-1] <= 3 and not _SENTENCE.search(last)
            if near and tail + 1 + len(t.split(" ")[0]) > longest and tail > 0.6 * longest and t[:1] not in "-•*|»©" and not _CRUMB.match(t):
                out[-1] = (ids + [n], last + "\n" + t)
                continue
        out.append(([n], t))
    return [(ids, t.replace("\n", " ")) for ids, t in out]


def _is_menu(low: str) -> bool:
    items = [re.sub(r" \((?:ouvert|open)\)$", "", x) for x in _ITEM.split(low) if x]
    return bool(items) and sum(x in MENU for x in items) >= max(1, 0.7 * len(items))


def _address(text: str) -> bool:
    return len(text) < 130 and bool(_ADDRESS.search(text) or re.search(r"\d", text)) and bool(_WAY.search(text)) and not (_SENTENCE.search(text) and len(text) > 80)


def roles(texts: list[str], conf: DensityConf) -> list[str]:
    """Role of every logical line: nav, banner, teaser, inset, foot, site or text."""
    low = [t.lower().strip() for t in texts]
    n = len(texts)
    role = ["text"] * n
    for i, l in enumerate(low):
        if _BANNER.search(l):
            role[i] = "banner"
        elif l in BUTTONS or all(x in BUTTONS for x in _ITEM.split(l) if x):
            role[i] = "foot" if l not in ("menu", "fermer", "ok") else "nav"
        elif _CRUMB.match(l):
            role[i] = "crumb"
        elif _FOOT.search(l) or " - " in l and any(x in BUTTONS or x == "mentions légales" for x in l.split(" - ")):
            role[i] = "foot"
        elif _is_menu(l) and len(_ITEM.split(l)) > 2:
            role[i] = "nav"
    # Menus written one item a line, anywhere at least three in a row.
    i = 0
    while i < n:
        j = i
        while j < n and re.sub(r" \((?:ouvert|open)\)$", "", low[j]) in MENU:
            j += 1
        if j - i >= 3:
            crumb = j < n and role[j] == "crumb"
            for k in range(i, j):
                role[k] = "nav"
            # The last item is the title if no crumb follows and the page goes on with its text.
            if not crumb and j - i >= 4 and low[j - 1] in low[i : j - 1]:
                role[j - 1] = "text"
        i = max(j, i + 1)
    # Insets with fixed followers; teasers with their items. A line that the crumb names is the body's first.
    crumbs = [re.split(r"\s[»>/›]\s", low[i])[-1] for i in range(n) if role[i] == "crumb"]
    title = crumbs[-1] if crumbs and len(crumbs[-1]) > 15 else None
    i = 0
    while i < n:
        if low[i] in ("horaires", "opening hours") and i + 1 < n and re.match(r"^(?:lun|mon)\S*-\S+ ", low[i + 1]):
            role[i] = role[i + 1] = "inset"
        elif low[i] in ("catégories", "categories"):
            k = i + 1
            while k < n and re.search(r"\(\d+\)$", low[k]) and len(low[k]) < 30 and not low[k].startswith(("•", "-")):
                role[k] = "inset"
                k += 1
            if k > i + 1:
                role[i] = "inset"
        elif low[i].startswith(tuple(t + " : " for t in TEASERS)):
            role[i] = "teaser"
        elif low[i] in TEASERS:
            role[i] = "teaser"
            k, got = i + 1, 0
            while k < n and got < conf.items and role[k] == "text":
                one = _SENTENCE.search(texts[k]) and len(texts[k]) > 30 and not _TWO.search(texts[k]) and not low[k].endswith("?")
                if not (_CUT.search(texts[k]) or one) or title and low[k].startswith(title):
                    break
                role[k] = "teaser"
                got += 1
                k += 1
        elif _CUT.search(texts[i]) and role[i] == "text" and re.search(r"(?:lire la suite|read more)\s*$", low[i]):
            role[i] = "teaser"
        i += 1
    return role


def body_lines(text: str | None, conf: DensityConf = DensityConf()) -> list[int]:
    """Numbers (from 1) of the body's non-blank lines."""
    if not text:
        return []
    lines = [(k, t.strip()) for k, t in enumerate(text.split("\n"), 1) if t.strip()]
    if not lines:
        return []
    logical = _unwrap(lines)
    texts = [t for _, t in logical]
    low = [t.lower() for t in texts]
    n = len(texts)
    role = roles(texts, conf) if conf.words else ["text"] * n

    # Company name: from the copyright, the description or the consent line.
    site = set()
    for t in texts:
        if "©" not in t and "entreprise spécialisée" not in t and "partenaires" not in t:
            continue
        for rx in (r"© ?\d{4} (.+?)(?: - Tous droits|\. All rights)", r"^(.+?), entreprise spécialisée dans", r"^(.+?) et ses \d+ partenaires", r" - ([^-]+?), entreprise spécialisée"):
            m = re.search(rx, t)
            if m:
                site.add(m.group(1).strip().lower())

    # Header: all up to the last menu or crumb that comes before the first real text.
    head, plain = -1, 0
    for i in range(n):
        if role[i] in ("nav", "crumb"):
            head, plain = i, 0
        elif role[i] == "text":
            long = len(texts[i]) > 80 or _SENTENCE.search(texts[i]) and len(texts[i]) > 45
            plain += 1
            if long or plain > 3:
                break
    for i in range(head + 1):
        if role[i] == "text":
            role[i] = "site"
    first = head + 1
    while first < n and role[first] != "text":
        first += 1
    if first < n and low[first] in site and not (first + 1 < n and (_address(texts[first + 1]) or _PHONE.match(texts[first + 1]))):
        role[first] = "site"

    # Footer: walk up from the end over furniture, phones and addresses of the page's foot.
    legal = next((i for i in range(n) if i > head and low[i] in ("mentions légales", "legal notice") and any(re.match(r"(?:éditeur|publisher)\b", x) for x in low[i + 1 : i + 3])), None)
    end = n
    while end > 0:
        i = end - 1
        if role[i] != "text":
            end -= 1
            continue
        if i != legal and (low[i] in ("mentions légales", "legal notice") or _PHONE.match(texts[i]) or _address(texts[i]) or (low[i] in site and i + 1 < n and role[i + 1] != "text")):
            end -= 1
            continue
        break
    # A contact block belongs to the body: company name, address, phones, mail, hours.
    role, end = _contact_block(texts, low, role, site, head, end)
    for i in range(end, n):
        if role[i] == "text":
            role[i] = "foot"
    for i in range(n):
        if role[i] == "text" and i != legal and low[i] in ("mentions légales", "legal notice") and i > head + 1:
            role[i] = "foot"

    # Composite density of the leaves, and the run of leaves whose sum over the threshold is greatest.
    share = link_shares(texts, role)
    gain = densities(texts, role, share, conf)
    best, start, total, span = 0.0, 0, 0.0, None
    for i in range(n):
        if total <= 0:
            total, start = 0.0, i
        total += gain[i]
        if total > best:
            best, span = total, (start, i + 1)
    if span is None:
        return []
    keep = [i for i in range(*span) if share[i] < 1]
    return sorted(k for i in keep for k in logical[i][0])


_BULLET = re.compile(r"^(?:[-•*–·▪◦✓]|\d{1,2}[.)])\s*\S")
_FACT = re.compile(r"^(?:par|by|von|por|publié|published)\b.{3,}|\d{1,2}[/. ](?:\d{1,2}|[a-zà-ÿ]{3,9})[/. ]\d{4}|\d+(?:[.,]\d+)? ?(?:€|eur\b|\$|£|%)|@|\b\d{5}\b", re.I)
_ENDS = re.compile(r"[.!?:;…»\")]\s*$")


@lru_cache(maxsize=50_000)
def _stated(text: str) -> bool:
    """Is a line text however short: a bullet, price, date, phone, contact or address line?"""
    return bool(_BULLET.match(text) or _FACT.search(text) or _PHONE.match(text) or _CONTACT.match(text.lower()) or _address(text))


def link_shares(texts: list[str], role: list[str]) -> list[float]:
    """Share of links in every leaf, from its role and its form.

    Furniture is all link. So are several short items between separators, lines that end
    cut off, and short lines without the end of a sentence that stand among their like;
    a short line right above text is its heading, and lists, prices, dates and contact
    lines are text.
    """
    n = len(texts)
    solid = [len(t) > 60 or bool(_ENDS.search(t)) or _stated(t) for t in texts]
    share = [0.0 if r == "text" else 1.0 for r in role]
    for i in range(n):
        if share[i] or _BULLET.match(texts[i]):
            continue
        items = [x for x in _ITEM.split(texts[i]) if x]
        if len(items) > 2 and not _ENDS.search(texts[i]) and sum(len(x) for x in items) < 25 * len(items) and not _FACT.search(texts[i]):
            share[i] = 1.0
        elif not solid[i]:
            below = [j for j in range(i + 1, min(n, i + 12)) if role[j] == "text"][:2]
            heads = bool(below) and (solid[below[0]] or len(below) > 1 and solid[below[1]])
            share[i] = 0.0 if heads else 0.5
    return share


def densities(texts: list[str], role: list[str], share: list[float], conf: DensityConf) -> list[float]:
    """Link-adjusted characters of every leaf over the threshold. Headings, lists, prices,
    questions and contact lines are short by nature and never speak against the body."""
    out = []
    for t, r, s in zip(texts, role, share):
        d = len(t) * (1 - s) - conf.threshold
        if r != "text":
            d = -conf.known
        elif s:
            d = -conf.threshold
        elif d < 8.0 and (t.rstrip().endswith("?") or _stated(t)):
            d = max(d, 8.0)
        elif not _SENTENCE.search(t):
            d = max(d, 0.1)
        out.append(d)
    return out


def _contact_block(texts, low, role, site, head, end):
    """Phones and addresses that follow a company name or a mail line are body."""
    n = len(texts)
    mail = [i for i in range(head + 1, n) if _CONTACT.match(low[i]) and role[i] == "text"]
    labelled = [i for i in range(head + 1, n) if role[i] == "text" and re.match(r"^(?:téléphone|standard|courriel) :", low[i])]
    anchors = [i for i in range(head + 1, n - 1) if role[i] == "text" and (low[i] in site or i < end and low[i] not in ("mentions légales", "legal notice") and not re.search(r"[.!?:]$|\d", low[i])) and (_address(texts[i + 1]) and role[i + 1] == "text") and any(j in labelled + mail or _PHONE.match(texts[j]) for j in (i + 2, i + 3) if j < n)]
    for a in (anchors or labelled or mail)[:1]:
        k = a
        while k > head + 1 and role[k - 1] == "text" and (_address(texts[k - 1]) or _PHONE.match(texts[k - 1])) and k - 1 >= 0:
            k -= 1
        k = a + 1
        second = False
        while k < n and role[k] == "text" and (k in labelled or k in mail or _address(texts[k]) and k == a + 1 or _PHONE.match(texts[k]) and not second):
            second = second or bool(_PHONE.match(texts[k])) and k not in labelled
            k += 1
        end = max(end, k)
    return role, end


def strip_boilerplate(pages: DataFrame, key: str = "page_id", text: str = "text", conf: DensityConf = DensityConf()) -> DataFrame:
    """(page_id, line_no): the body's non-blank lines, counted from 1 over `text` split at line breaks.

    Null and empty texts and pages made of furniture alone give no row; repeated
    pages are treated alike; extra columns are ignored. No shuffle: one pass.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [body_lines(t, conf) for t in b["t"]]
            yield pd.DataFrame({"k": b["k"].repeat([len(f) for f in found]).to_numpy(), "n": [x for f in found for x in f]}).astype({"k": "int64", "n": "int32"})

    out = pages.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).mapInPandas(run, "k long, n int")
    return out.select(F.col("k").alias(key), F.col("n").alias("line_no"))
