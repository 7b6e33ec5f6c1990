"""E-mails, phones, web addresses, postal and activity codes, company numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null

EMAIL = r"[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}"
# Mailboxes of nobody in particular, and providers of free mail.
GENERIC_LOCALS = ["info", "contact", "admin", "support", "sales", "hello", "bonjour", "service", "commercial", "accueil", "secretariat", "direction", "compta", "comptabilite", "bureau", "devis", "mairie", "noreply", "no-reply"]
FREE_MAIL = ["gmail.com", "yahoo.com", "yahoo.fr", "hotmail.com", "hotmail.fr", "outlook.com", "outlook.fr", "live.fr", "free.fr", "orange.fr", "wanadoo.fr", "laposte.net", "sfr.fr", "icloud.com", "courriel.example", "boitelibre.example", "mel-pro.test"]
# Public suffixes of two labels.
TWO_LABELS = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "com.br", "co.jp", "co.nz", "co.za", "com.mx", "com.tr", "gouv.fr", "asso.fr"]


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def fr_phone(c: Column) -> Column:
    """Ten digits with a leading zero or nine digits become +33...; other digits stay; none is null."""
    d = digits(blank_to_null(c))
    return F.nullif(F.when((F.length(d) == 10) & d.startswith("0"), F.concat(F.lit("+33"), F.substring(d, 2, 9))).when(F.length(d) == 9, F.concat(F.lit("+33"), d)).otherwise(d), F.lit(""))


def national_phone(c: Column) -> Column:
    """French national form: 0033, 33 and +33 become 0; null outside 9 to 12 digits."""
    d = digits(blank_to_null(c))
    n = F.when(d.startswith("0033"), F.concat(F.lit("0"), F.substring(d, 5, 20))).when(d.startswith("33"), F.concat(F.lit("0"), F.substring(d, 3, 20))).when((F.length(d) == 9) & ~d.startswith("0"), F.concat(F.lit("0"), d)).otherwise(d)
    return F.when(F.length(n).between(9, 12), n)


def phone_check(c: Column) -> Column:
    """struct(is_valid, normalized, reason): reasons missing, parse, valid or format."""
    d = F.regexp_replace(digits(F.regexp_replace(blank_to_null(c), r"\(0\)", "")), "^(0033|33)", "0")
    n = F.when(F.length(d) == 9, F.concat(F.lit("0"), d)).otherwise(d)
    ok = n.rlike(r"^0[1-9]\d{8}$")
    reason = F.when(blank_to_null(c).isNull(), "missing").when(d == "", "parse").when(ok, "valid").otherwise("format")
    return F.struct(F.coalesce(ok, F.lit(False)).alias("is_valid"), F.when(ok, F.concat(F.lit("+33"), F.substring(n, 2, 9))).alias("normalized"), reason.alias("reason"))


def email_check(c: Column) -> Column:
    """struct(is_valid, normalized, reason): reasons missing, parse, format or valid."""
    t = F.lower(F.trim(F.regexp_replace(blank_to_null(c), r"^.*<([^>]+)>\s*$", "$1")))
    ok = t.rlike(f"^{EMAIL}$") & ~t.contains("..")
    reason = F.when(blank_to_null(c).isNull(), "missing").when(~t.contains("@"), "parse").when(ok, "valid").otherwise("format")
    return F.struct(F.coalesce(ok, F.lit(False)).alias("is_valid"), F.when(ok, t).alias("normalized"), reason.alias("reason"))


def email_kind(c: Column) -> Column:
    """generic, nominative or null, by the local part."""
    local = F.lower(F.substring_index(c, "@", 1))
    named = F.exists(F.split(local, r"[._-]+"), lambda t: (F.length(t) >= 3) & t.rlike("^[a-z]+$") & ~t.isin(GENERIC_LOCALS))
    return F.when(c.contains("@"), F.when(local.isin(GENERIC_LOCALS), "generic").when(named, "nominative").otherwise("generic"))


def email_patterns(first: Column, last: Column, domain: Column) -> Column:
    """Local parts a person's mailbox may have, each once, with the domain."""
    f, n, i, j = first, last, F.substring(first, 1, 1), F.substring(last, 1, 1)
    join = lambda a, b, signs: [F.concat(a, F.lit(s), b) for s in signs]
    locals_ = [F.concat(f, F.lit("."), n), F.concat(f, n), F.concat(i, n), F.concat(i, F.lit("."), n), F.concat(n, F.lit("."), f), *join(f, n, "-_"), *join(i, n, "-_"), F.concat(n, f), *join(n, f, "-_"), F.concat(n, i), *join(n, i, ".-_"), F.concat(f, F.lit("."), j), F.concat(f, j), F.concat(i, j), f, n]
    return F.array_distinct(F.transform(F.array_compact(F.array(*locals_)), lambda x: F.concat(x, F.lit("@"), domain)))


def host(c: Column) -> Column:
    """Host of an address with or without scheme, in lower case, without port and `www.`."""
    h = F.regexp_extract(F.regexp_replace(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.-]*://", ""), r"^(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.regexp_replace(h, r"^www\.", ""), F.lit(""))


def registrable(c: Column) -> Column:
    """Last two labels of a host, three where the suffix has two."""
    labels = F.split(host(c), r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    three = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".")
    return F.when(host(c).isNull(), F.lit(None)).when(two.isin(TWO_LABELS), three).otherwise(two)


def canonical_url(c: Column) -> Column:
    """Scheme and host in lower case, default ports, fragment, query and trailing slash dropped."""
    scheme = F.coalesce(F.nullif(F.regexp_extract(F.lower(c), r"^([a-z]+)://", 1), F.lit("")), F.lit("https"))
    h = F.lower(F.regexp_extract(F.regexp_replace(c, r"^[A-Za-z]+://", ""), r"^([^/?#]+)", 1))
    h = F.regexp_replace(h, r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(F.regexp_replace(c, r"^[A-Za-z]+://", ""), r"^[^/?#]+([^?#]*)", 1), "/+$", "")
    return F.when(F.trim(c) != "", F.concat(scheme, F.lit("://"), h, path))


def strip_tracking(c: Column) -> Column:
    """Address without fragment and utm_ parameters."""
    base = F.regexp_replace(c, "#.*$", "")
    query = F.filter(F.split(F.regexp_extract(base, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(p).startswith("utm_"))
    return F.concat(F.regexp_replace(base, r"\?.*$", ""), F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def page_kind(c: Column) -> Column:
    u = F.lower(c)
    return F.when(u.rlike("mentions|legal"), "legal").when(u.contains("contact"), "contact").when(u.rlike("a-propos|about|equipe|qui-sommes"), "about").when(u.rlike("privacy|confidentialite"), "privacy").when(u.rlike(r"^https?://[^/]+/?([?#].*)?$"), "home").otherwise("other")


def page_priority(c: Column) -> Column:
    k = page_kind(c)
    return F.when(k == "legal", 0).when(k == "contact", 1).when(k == "about", 2).otherwise(5)


def department(c: Column) -> Column:
    """Department of a postal code; four digits have lost their zero; null where blank."""
    t = F.trim(c)
    return F.when(t.rlike(r"^[1-9]\d{3}$"), F.concat(F.lit("0"), F.substring(t, 1, 1))).when(F.length(t) >= 2, F.substring(t, 1, 2))


def department_overseas(c: Column) -> Column:
    return F.when(F.trim(c).startswith("97"), F.substring(F.trim(c), 1, 3)).otherwise(department(c))


def naf_clean(c: Column) -> Column:
    return F.nullif(F.upper(F.regexp_replace(c, r"[\s.]", "")), F.lit(""))


def naf_matches(c: Column, prefixes: list[str]) -> Column:
    """Does the code start with a prefix? A full code with letter (not of 01, 02, 03) counts without its letter."""
    code = naf_clean(c)
    hit = F.lit(False)
    for p in prefixes:
        q = "".join(p.upper().replace(".", "").split())
        if len(q) >= 4 and q[:-1].isdigit() and q[-1].isalpha() and q[:2] not in ("01", "02", "03"):
            q = q[:-1]
        hit = hit | F.coalesce(code.startswith(q), F.lit(False))
    return hit


def siren_prefix(c: Column) -> Column:
    """First nine digits where there are at least nine."""
    d = digits(c)
    return F.when(F.length(d) >= 9, F.substring(d, 1, 9))


def siren_any(c: Column) -> Column:
    """First nine of whatever digits there are."""
    return F.nullif(F.substring(digits(c), 1, 9), F.lit(""))


def siren_strict(c: Column) -> Column:
    """Nine digits, from exactly nine or fourteen."""
    d = digits(c)
    return F.when(F.length(d).isin(9, 14), F.substring(d, 1, 9))


def deobfuscate(c: Column) -> Column:
    """Written-out signs of e-mail addresses restored."""
    t = F.lower(c)
    t = F.regexp_replace(t, r"\s*[\[({]\s*(?:at|arobase|chez)\s*[\])}]\s*|\s+(?:arobase)\s+", "@")
    return F.regexp_replace(t, r"\s*[\[({]\s*(?:dot|point)\s*[\])}]\s*|(?<=@[a-z0-9-]{1,60})\s+(?:point|dot)\s+", ".")


def emails_in(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(f"({EMAIL})"), F.lit(1)))


def phones_in(c: Column) -> Column:
    """French numbers in a text, each once, as written."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"((?:\+33 ?(?:\(0\) ?)?|0)[1-9](?:[ .-]?[0-9]{2}){4})"), F.lit(1)))


def sirens_in(c: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"SIREN[ :]*([0-9]{3} ?[0-9]{3} ?[0-9]{3})"), F.lit(1)), lambda x: F.replace(x, F.lit(" "), F.lit(""))))


def links_in(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"""href=["']([^"']+)["']"""), F.lit(1)))


def mailto_in(c: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"""href=["']mailto:([^"'?]+)"""), F.lit(1)), lambda x: F.trim(x)))


def title_of(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def socials_in(c: Column) -> Column:
    """Map of network to links found in HTML or text."""
    nets = {"facebook": r"facebook\.com", "linkedin": r"linkedin\.com", "twitter": r"(?:twitter|x)\.com", "instagram": r"instagram\.com", "youtube": r"youtube\.com"}
    found = F.map_from_arrays(F.array(*[F.lit(n) for n in nets]), F.array(*[F.array_distinct(F.regexp_extract_all(c, F.lit(rf"(https?://(?:www\.)?{h}/[^\s\"'<>]+)"), F.lit(1))) for h in nets.values()]))
    return F.map_filter(found, lambda _, v: F.size(v) > 0)
