"""Scores of candidates: domains, search results, places, phones on a site, titles, countries.

The weights and thresholds in this module are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .contact import registrable
from .numbers import fuzzy_partial, fuzzy_token_set
from .text import company_tokens, normalize_text

# Country codes and the names they are written with.
COUNTRIES = {"france": "FR", "germany": "DE", "allemagne": "DE", "belgium": "BE", "belgique": "BE", "spain": "ES", "espagne": "ES", "italy": "IT", "italie": "IT", "united kingdom": "GB", "royaume uni": "GB", "switzerland": "CH", "suisse": "CH", "luxembourg": "LU"}


def clamp(c: Column, low: float = 0.0, high: float = 1.0, digits: int = 3) -> Column:
    """Within the bounds and rounded; null and NaN count as the lower bound."""
    return F.round(F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(F.nanvl(c.cast("double"), F.lit(low)), F.lit(low)))), digits)


def overlap(a: Column, b: Column) -> Column:
    """Share of the first list's distinct entries that the second has."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_distinct(a)), F.lit(1))


def domain_score(domain: Column, name: Column, city: Column, title: Column, generic: list[str]) -> Column:
    """Does a domain belong to a company: token similarity, overlap, the city in the title, generic words."""
    reg = registrable(domain)
    a, b = company_tokens(name), F.filter(F.split(normalize_text(F.replace(reg, F.lit("."), F.lit(" "))), " "), lambda t: t != "")
    x, y = F.array_join(a, " "), F.array_join(b, " ")
    similar, part, share = fuzzy_token_set(x, y) / 100, fuzzy_partial(x, y) / 100, overlap(a, b)
    s = 0.55 * similar + 0.25 * part + 0.2 * share + F.when(share >= 1.0, 0.15).when(share < 0.5, -0.1).otherwise(0.0)
    s = s * F.when(similar < 0.2, 0.375).when(similar < 0.4, 0.75).otherwise(1.0)
    t, c = normalize_text(title), normalize_text(city)
    s = s + F.when((c != "") & t.contains(c), 0.08).otherwise(0.0) - F.when(F.exists(b, lambda w: w.isin(generic)), 0.25).otherwise(0.0)
    return F.when(reg.isNull() | (F.size(a) <= 0) | (F.size(b) <= 0), 0.0).otherwise(clamp(s))


def serp_score(name: Column, domain: Column, title: Column, snippet: Column, city: Column, generic: Column) -> Column:
    """Search result: .6 domain, .3 title, .1 city in the snippet; generic hosts score 0."""
    n, d, t = normalize_text(name), normalize_text(domain), normalize_text(title)
    s = 0.6 * F.greatest(fuzzy_partial(n, d), fuzzy_token_set(n, d)) / 100 + 0.3 * F.coalesce(F.when(t != "", fuzzy_partial(n, t) / 100), F.lit(0.0))
    c = normalize_text(city)
    s = s + F.when((c != "") & normalize_text(snippet).contains(c), 0.1).otherwise(0.0)
    return F.when(generic | (F.coalesce(d, F.lit("")) == ""), 0.0).otherwise(F.round(F.least(F.lit(1.0), s), 6))


def serp_rank_score(name: Column, domain: Column, title: Column, snippet: Column, city: Column) -> Column:
    """0..100: best partial ratio; all name words in the host give 90 at least, any of them 15 more, the city 5."""
    target = F.concat_ws(" ", title, snippet, domain)
    best = F.greatest(*[F.coalesce(fuzzy_partial(name, x), F.lit(0.0)) for x in (domain, title, target)])
    plain = F.regexp_replace(F.upper(domain), "[^A-Z0-9]", "")
    words = F.filter(F.split(F.upper(name), " "), lambda w: w != "")
    best = F.when((F.size(words) > 0) & F.forall(words, lambda w: plain.contains(w)), F.greatest(best, F.lit(90.0))).when(F.exists(words, lambda w: plain.contains(w)), best + 15).otherwise(best)
    return F.round(F.least(F.lit(100.0), best + F.when((city != "") & F.lower(target).contains(F.lower(city)), 5).otherwise(0)), 6)


def guess_score(candidate: Column, words: Column, city_words: Column, has_dns: Column, has_mx: Column, status: Column, snippet: Column, tlds: list[str]) -> Column:
    """Guessed domain: name server .25, mail .1, status .35/.3/.05, name .2, city .05, preferred ending .05."""
    text = F.lower(F.coalesce(snippet, F.lit("")))
    long = lambda ws: F.filter(ws, lambda w: F.length(w) >= 4)
    yes = lambda b, w: F.when(F.coalesce(b, F.lit(False)), w).otherwise(0.0)
    ends = F.lit(False)
    for t in tlds:
        ends = ends | candidate.endswith(t)
    code = F.when(status.between(200, 299), 0.35).when(status.between(300, 399), 0.3).when(status.between(400, 499), 0.05).otherwise(0.0)
    s = yes(has_dns, 0.25) + yes(has_mx, 0.1) + code + yes(F.exists(long(words), lambda w: candidate.contains(w) | text.contains(w)), 0.2) + yes(F.exists(long(city_words), lambda w: text.contains(w)), 0.05) + yes(ends, 0.05)
    return F.round(F.least(F.lit(1.0), s), 4)


def phone_on_site_score(phone: Column, url: Column, context: Column) -> Column:
    """Number found on a page: kind of page, words around it, mobile numbers."""
    u, c = F.lower(url), F.lower(F.coalesce(context, F.lit("")))
    s = F.lit(0.35) + F.when(u.contains("contact"), 0.2).when(u.rlike("mentions|legal"), 0.1).otherwise(0.05)
    s = s + F.when(c.rlike("tél|tel|phone|appel|contact|standard"), 0.1).otherwise(0.0) - F.when(c.contains("fax"), 0.1).otherwise(0.0) + F.when(phone.rlike("^0[67]"), 0.05).otherwise(0.0)
    return clamp(s, digits=4)


def place_score(name: Column, place_name: Column, city: Column, code: Column, address: Column) -> Column:
    """0..100 for a place on the map: .6 name (best of two ratios), .3 city and postal code in the address, .1 both."""
    a, b = F.array_join(company_tokens(name), " "), F.array_join(company_tokens(place_name), " ")
    n = F.when((a != "") & (b != ""), F.greatest(fuzzy_token_set(a, b), fuzzy_partial(a, b)) / 100).otherwise(0.0)
    at = F.lower(F.coalesce(address, F.lit("")))
    in_city = F.coalesce((F.trim(city) != "") & at.contains(F.lower(city)), F.lit(False))
    in_code = F.coalesce((F.trim(code) != "") & at.contains(F.replace(code, F.lit(" "), F.lit(""))), F.lit(False))
    where = F.when(in_city, 0.6).otherwise(0.0) + F.when(in_code, 0.4).otherwise(0.0)
    return F.round(100 * (0.6 * F.coalesce(n, F.lit(0.0)) + 0.3 * where + F.when(in_city & in_code, 0.1).otherwise(0.0)), 2)


def title_score(title: Column, name: Column) -> Column:
    """1 for the same normalised text, .8 if one holds the other, else 0."""
    t, n = normalize_text(title), normalize_text(name)
    return F.when((t == "") | (n == "") | t.isNull() | n.isNull(), 0.0).when(t == n, 1.0).when(t.contains(n) | n.contains(t), 0.8).otherwise(0.0)


def country_code(c: Column, overrides: dict[str, str] | None = None, default: str | None = None) -> Column:
    """Two-letter codes as they are, known names, overrides first, else the default."""
    pairs = {**COUNTRIES, **{k.lower(): v for k, v in (overrides or {}).items()}}
    known = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])[normalize_text(c)]
    return F.coalesce(known, F.when(F.trim(c).rlike("^[A-Za-z]{2}$"), F.upper(F.trim(c))), F.lit(default))


def combined(address: Column, company: Column, weights: tuple[float, float] = (0.7, 0.3)) -> Column:
    return F.round(address * weights[0] + company * weights[1], 4)


def address_quality(c: Column) -> Column:
    """Of an address: number .2, way .3, postal code .2, town after it .2, length .1."""
    t = F.lower(F.coalesce(c, F.lit("")))
    yes = lambda rx, w: F.when(t.rlike(rx), w).otherwise(0.0)
    return F.round(yes(r"\d+", 0.2) + yes(r"\b(rue|avenue|av|boulevard|bd|place|pl|chemin|impasse|allée|route|square|cours|quai)\b", 0.3) + yes(r"\b\d{5}\b", 0.2) + yes(r"\d{5}\s+\p{L}{2,}", 0.2) + F.when(F.length(t) >= 15, 0.1).otherwise(0.0), 2)
