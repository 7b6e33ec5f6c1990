"""Web addresses, e-mails and contacts in texts: checks, canonical forms, extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .contact import EMAIL, digits, emails_in, host, phone_check, registrable
from .text import blank_to_null

# Endings of files that are no pages.
FILES = "jpg jpeg png gif webp svg ico css js pdf zip rar 7z mp3 mp4 avi mov doc docx xls xlsx".split()
# Endings of names that only look like e-mail hosts.
BANNED = "png jpg jpeg gif svg webp css js ico".split()
# Words before a manager's name.
MANAGERS = "gérante|gérant|présidente|président|directrice|directeur|ceo|dirigeant"


def site_check(c: Column) -> Column:
    """struct(is_valid, normalized, reason): reasons missing, scheme, netloc, domain or valid."""
    t = F.trim(blank_to_null(c))
    scheme = F.lower(F.regexp_extract(t, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    place = F.lower(F.regexp_extract(t, r"^[A-Za-z]+://([^/?#]*)", 1))
    rest = F.regexp_extract(t, r"^[A-Za-z]+://[^/?#]*(.*)$", 1)
    named = F.regexp_replace(place, r":\d+$", "").rlike(r"^([a-z0-9_-]+\.)+[a-z]{2,}$")
    reason = F.when(t.isNull(), "missing").when(~scheme.isin("http", "https"), "scheme").when(place == "", "netloc").when(~named, "domain").otherwise("valid")
    return F.struct((reason == "valid").alias("is_valid"), F.when(reason == "valid", F.concat(scheme, F.lit("://"), place, rest)).otherwise(t).alias("normalized"), reason.alias("reason"))


def linkedin_check(c: Column) -> Column:
    """struct(is_valid, normalized, reason) of the page of a company: reasons missing, scheme, host, path or valid."""
    t = F.trim(blank_to_null(c))
    place = F.lower(F.regexp_extract(t, r"^https://([^/?#]*)", 1))
    slug = F.lower(F.regexp_extract(t, r"^https://[^/?#]*/company/([^/?#]+)/?(?:[?#].*)?$", 1))
    reason = F.when(t.isNull(), "missing").when(~t.startswith("https:"), "scheme").when(~place.isin("www.linkedin.com", "linkedin.com"), "host").when(slug == "", "path").otherwise("valid")
    return F.struct((reason == "valid").alias("is_valid"), F.when(reason == "valid", F.concat(F.lit("https://www.linkedin.com/company/"), slug, F.lit("/"))).otherwise(t).alias("normalized"), reason.alias("reason"))


def with_scheme(c: Column, scheme: str = "https") -> Column:
    """Single blanks, trimmed, and a scheme where there is none."""
    t = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(t == "", t).when(t.startswith("//"), F.concat(F.lit(scheme + ":"), t)).when(~t.contains("//"), F.concat(F.lit(scheme + "://"), t)).otherwise(t)


def without_fragment(c: Column) -> Column:
    return F.regexp_replace(c, "#.*$", "")


def is_home(c: Column) -> Column:
    """Does the address name the first page of its host?"""
    path = F.regexp_replace(F.regexp_extract(c, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    return path.isin("", "/index", "/index.html")


def resolved(base: Column, link: Column) -> Column:
    """A link of a page as a full address, without fragment: absolute, of the scheme, of the host, or beside the page."""
    root = F.regexp_extract(base, r"^([A-Za-z]+://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), r"^([A-Za-z]+://.*/)[^/]*$", 1)
    beside = F.concat(F.when(folder.rlike(r"^[A-Za-z]+://$"), F.concat(root, F.lit("/"))).otherwise(F.coalesce(F.nullif(folder, F.lit("")), F.concat(root, F.lit("/")))), link)
    full = F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z]+:)", 1), link)).when(link.startswith("/"), F.concat(root, link)).otherwise(beside)
    return F.when(F.trim(link) == "", F.lit("")).otherwise(without_fragment(full))


def skipped(url: Column, origin: Column) -> Column:
    """Is the address no page of the host: another scheme, another host, or a file?"""
    own = F.regexp_replace(F.lower(origin), r"^www\.", "")
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1))
    return ~F.lower(url).rlike("^https?://") | (host(url).isNotNull() & (host(url) != own)) | path.rlike(r"\.(" + "|".join(FILES) + ")$")


def host_parts(c: Column) -> Column:
    """struct(host, registered, suffix, depth): depth counts the labels before the registered name."""
    h, reg = host(c), registrable(c)
    labels = lambda x: F.size(F.split(x, r"\."))
    return F.struct(h.alias("host"), reg.alias("registered"), F.regexp_extract(reg, r"\.(.+)$", 1).alias("suffix"), F.when(h.isNotNull(), labels(h) - labels(reg)).alias("depth"))


def same_suffix(a: Column, b: Column) -> Column:
    """Do two host names end in the same two labels?"""
    last = lambda x: F.substring_index(x, ".", -2)
    return F.coalesce((last(a) == last(b)) & a.contains(".") & b.contains("."), F.lit(False))


def first_french_phone(c: Column) -> Column:
    """First number of a `;` list that is +33 and nine digits once normalised."""
    each = F.transform(F.split(c, ";"), lambda x: phone_check(x)["normalized"])
    return F.get(F.filter(each, lambda x: x.isNotNull()), F.lit(0))


def email_of_domain(email: Column, domain: Column) -> Column:
    """Is the e-mail's host the domain, below it, or of the same registered name?"""
    own, want = F.lower(F.substring_index(email, "@", -1)), F.lower(domain)
    return F.coalesce(email.contains("@") & ((own == want) | own.endswith(F.concat(F.lit("."), want)) | (registrable(own) == registrable(want))), F.lit(False))


def sanitised_email(c: Column) -> Column:
    """E-mail without blanks around its signs and without punctuation at its ends, in lower case."""
    t = F.regexp_replace(F.trim(c), r"^[.,;:<>\[\](){}]+|[.,;:<>\[\](){}]+$", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\s*@\s*", "@"), r"\s*\.\s*", ".")
    local = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(F.substring_index(t, "@", 1)), r"\s+", "."), r"\.+", "."), r"^\.|\.$", "")
    domain = F.regexp_replace(F.regexp_extract(t, r"^[^@]*@(.*)$", 1), r"\s+", "")
    return F.lower(F.when(t.contains("@"), F.concat(local, F.lit("@"), domain)).otherwise(t))


def plausible_email(c: Column) -> Column:
    """Both parts there and not too long, a dotted host that is no picture or script."""
    local, domain = F.substring_index(c, "@", 1), F.regexp_extract(c, r"^[^@]*@(.*)$", 1)
    ending = F.lower(F.regexp_extract(domain, r"\.([^.]*)$", 1))
    picture = domain.rlike(r"\.(png|jpg|jpeg|gif|svg|webp)")
    return F.coalesce(c.contains("@") & (local != "") & domain.contains(".") & ~ending.isin(BANNED) & ~picture & (F.length(local) <= 64) & (F.length(domain) <= 255), F.lit(False))


def tels_in(html: Column) -> Column:
    """Numbers of `tel:` links, digits and plus only, each once."""
    found = F.regexp_extract_all(F.lower(html), F.lit(r"""href=["']tel:([^"'?]+)"""), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.regexp_replace(x, r"[^0-9+]", "")), lambda x: x != ""))


def ids_in(c: Column) -> Column:
    """struct(sirets, sirens, rcs, managers, addresses) found in a text, each sorted and once."""
    sirets = F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"\b(\d{14})\b"), F.lit(1))))
    sirens = F.array_sort(F.array_distinct(F.concat(F.regexp_extract_all(c, F.lit(r"\b(\d{9})\b"), F.lit(1)), F.transform(sirets, lambda s: F.substring(s, 1, 9)))))
    town = F.regexp_extract_all(c, F.lit(r"(?i)RCS\s+([A-ZÀ-ſ -]*?)\s*(\d{9})"), F.lit(1))
    number = F.regexp_extract_all(c, F.lit(r"(?i)RCS\s+([A-ZÀ-ſ -]*?)\s*(\d{9})"), F.lit(2))
    rcs = F.zip_with(town, number, lambda a, b: F.concat_ws(" ", F.lit("RCS"), F.nullif(F.initcap(F.trim(a)), F.lit("")), b))
    name = F.filter(F.transform(F.regexp_extract_all(c, F.lit(rf"(?i)(?:{MANAGERS})[ ]*[:\-]?[ ]*([A-ZÀ-ſ'\- ]{{2,}})"), F.lit(1)), lambda x: F.trim(x)), lambda x: (x != "") & (F.size(F.split(x, r"\s+")) <= 5))
    place = F.transform(F.regexp_extract_all(c, F.lit(r"(?i)(?:adresse|siège social|siege social|bureau)\s*[:\-]?\s*([^\n]+)"), F.lit(1)), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"(?i)(téléphone|telephone|email|mail|tel|site).*$", ""), r"\s+", " ")))
    tidy = lambda a: F.array_sort(F.array_distinct(F.filter(a, lambda x: x != "")))
    return F.struct(sirets.alias("sirets"), sirens.alias("sirens"), tidy(rcs).alias("rcs"), tidy(F.transform(name, lambda x: F.initcap(x))).alias("managers"), tidy(place).alias("addresses"))


def sites_in(c: Column) -> Column:
    """Addresses of sites in a text, one for each host: https before http, then the first in the alphabet."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"(https?://[^\s\"'<>)]+)"), F.lit(1)), lambda u: F.regexp_replace(u, r"[.,;:]+$", ""))
    keyed = F.array_sort(F.transform(found, lambda u: F.struct(host(u).alias("h"), (~u.startswith("https")).alias("plain"), u.alias("u"))))
    kept = F.filter(keyed, lambda x, i: (i == 0) | (F.get(keyed, F.greatest(i - 1, F.lit(0)))["h"] != x["h"]))
    return F.transform(kept, lambda x: x["u"])


def pages_to_try(home: Column, links: Column, paths: list[str], most: int) -> Column:
    """The first page, usual paths of its host and the links that lead to it, each once, the first `most`."""
    root = F.regexp_extract(home, r"^([A-Za-z]+://[^/?#]*)", 1)
    usual = F.transform(F.array(*[F.lit(p) for p in paths]), lambda p: F.concat(root, F.lit("/"), p))
    own = F.filter(F.transform(links, lambda x: resolved(home, x)), lambda x: host(x) == host(home))
    return F.slice(F.array_distinct(F.concat(F.array(home), usual, F.coalesce(own, F.array().cast("array<string>")))), 1, most)


def jsonld_contacts(html: Column) -> Column:
    """struct(emails, phones) of the linked data of a page at any depth; unreadable data is searched as text."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    text = F.array_join(F.transform(blocks, lambda b: F.regexp_replace(b, r"(?s)<!--|-->", " ")), "\n")
    mails = F.array_sort(F.array_distinct(F.concat(F.transform(F.regexp_extract_all(text, F.lit(r'(?i)"email"\s*:\s*"(?:mailto:)?([^"]+)"'), F.lit(1)), lambda x: F.lower(F.trim(x))), emails_in(text))))
    phones = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r'(?i)"telephone"\s*:\s*"([^"]+)"'), F.lit(1)), lambda x: F.regexp_replace(x, r"[^0-9+]", ""))))
    return F.struct(F.filter(mails, lambda x: x.rlike(f"^{EMAIL}$")).alias("emails"), F.filter(phones, lambda x: F.length(digits(x)) >= 9).alias("phones"))
