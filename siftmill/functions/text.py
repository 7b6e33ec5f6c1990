"""Text functions: missing values, normalising, slugs, tokens, composing, masking."""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Texts that stand for a missing value.
PLACEHOLDERS = ["TELEPHONE NON RENSEIGNE", "ADRESSE NON RENSEIGNEE", "DENOMINATION NON RENSEIGNEE", "EMAIL NON RENSEIGNE", "NON RENSEIGNE"]
# Legal forms dropped from company names.
LEGAL_FORMS = ["sarl", "sarlu", "sas", "sasu", "sa", "sci", "sc", "snc", "scs", "scop", "sca", "scea", "gie", "eurl", "earl", "selarl", "ei", "eirl", "association", "cooperative", "coop"]
# Letters with marks and their plain forms.
_MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def blank_to_null(c: Column) -> Column:
    """Blank, `nan` and placeholder texts become null; other texts are kept as they are."""
    t = F.trim(c)
    return F.when((t == "") | (F.lower(t) == "nan") | F.upper(t).isin(PLACEHOLDERS), F.lit(None)).otherwise(c)


def first_filled(*columns: Column) -> Column:
    """First value that is not missing, in the order given."""
    return F.coalesce(*[blank_to_null(c) for c in columns])


def strip_accents(c: Column) -> Column:
    return F.translate(F.regexp_replace(F.regexp_replace(c, "œ", "oe"), "Œ", "OE"), _MARKED, _PLAIN)


def normalize_text(c: Column) -> Column:
    """Lower case without accents; all but letters and digits become single blanks."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", " "))


def slugify(c: Column) -> Column:
    return F.replace(normalize_text(c), F.lit(" "), F.lit("-"))


def company_tokens(c: Column) -> Column:
    """Tokens of a company name without legal forms."""
    return F.filter(F.split(normalize_text(c), " "), lambda t: (t != "") & ~t.isin(LEGAL_FORMS))


def company_slug(c: Column) -> Column:
    return F.array_join(company_tokens(F.replace(c, F.lit("."), F.lit(""))), "-")


def name_variants(c: Column) -> Column:
    """Joined, first two, first and last two tokens; each spelling once."""
    t = company_tokens(c)
    return F.array_distinct(F.filter(F.array(F.array_join(t, ""), F.array_join(F.slice(t, 1, 2), ""), F.get(t, F.lit(0)), F.array_join(F.slice(t, F.greatest(F.size(t) - 1, F.lit(1)), 2), "")), lambda v: v.isNotNull() & (v != "")))


def domain_candidates(c: Column, tlds: list[str]) -> Column:
    return F.flatten(F.transform(name_variants(c), lambda v: F.transform(F.array(*[F.lit(t) for t in tlds]), lambda t: F.concat(v, F.lit("."), t))))


def first_token(c: Column) -> Column:
    """First entry of a text that lists several (by `;`, `,`, `|` or blank)."""
    return F.nullif(F.trim(F.get(F.split(F.trim(c), r"[;,|\s]+"), F.lit(0))), F.lit(""))


def distinct_join(c: Column, most: int = 8) -> Column:
    """Entries of a comma or semicolon list, each once whatever its case, the first `most`."""
    items = F.filter(F.transform(F.split(c, "[;,]"), lambda x: F.trim(x)), lambda x: x != "")
    kept = F.aggregate(items, F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x)))
    return F.array_join(F.slice(kept, 1, most), ", ")


def truth(c: Column) -> Column:
    """Boolean of a text, null where it says neither."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("true", "1", "yes", "y", "oui", "vrai"), True).when(t.isin("false", "0", "no", "n", "non", "faux"), False)


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "(?s)<!--.*?-->|<(script|style)[^>]*>.*?</\\1>|<[^>]+>", " "), "\\s+", " "))


# Ways that are abbreviated.
WAYS = {"BD": "BOULEVARD", "BVD": "BOULEVARD", "AV": "AVENUE", "AVE": "AVENUE", "PL": "PLACE", "RTE": "ROUTE", "CHE": "CHEMIN", "IMP": "IMPASSE", "ALL": "ALLEE", "SQ": "SQUARE", "CRS": "COURS", "FG": "FAUBOURG"}


def clean_address(c: Column) -> Column:
    """Single blanks and the usual abbreviations of ways in full, upper case without accents."""
    t = F.upper(strip_accents(F.trim(F.regexp_replace(c, "\\s+", " "))))
    for short, full in WAYS.items():
        t = F.regexp_replace(t, rf"\b{short}\b\.?", full)
    return t


def compose_address(*parts: Column) -> Column:
    """Parts that are filled, joined by comma; null if none is."""
    return F.nullif(F.concat_ws(", ", *[blank_to_null(p) for p in parts]), F.lit(""))


def json_id(fields: dict[str, Column]) -> Column:
    """SHA-1 of a record written as JSON with sorted keys (`": "` and `", "` between its parts, null for nulls)."""
    quote = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    parts = [F.concat(F.lit(f'"{k}": '), F.coalesce(quote(fields[k]), F.lit("null"))) for k in sorted(fields)]
    return F.sha1(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")))


def search_terms(c: Column, most: int = 3) -> Column:
    """The longest different tokens of a company name, ties in the order of the alphabet."""
    ranked = F.array_sort(F.transform(F.array_distinct(company_tokens(c)), lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t"))))
    return F.slice(F.transform(ranked, lambda x: x["t"]), 1, most)


def mask_secrets(c: Column) -> Column:
    """Passwords, tokens, keys, cookies and signatures in texts, headers, addresses and JSON are starred."""
    t = F.regexp_replace(c, r"(?i)(password|passwd|pwd|secret|token|api[_-]?key|authorization|cookie|signature)(\s*[=:]\s*)(?!bearer|basic)[^\s&,;\"']+", "$1$2***")
    t = F.regexp_replace(t, r"""(?i)("(?:password|secret|token|api_?key|access_?key)"\s*:\s*")[^"]*""", "$1***")
    t = F.regexp_replace(t, r"\b(?:sk|pk|ghp|xox[bp])[-_][A-Za-z0-9-]{16,}", "***")
    t = F.regexp_replace(t, r"\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "***")
    t = F.regexp_replace(t, r"(?i)(bearer|basic)\s+[a-z0-9._~+/=-]+", "$1 ***")
    return F.regexp_replace(t, r"://[^/\s:@]+:[^/\s@]+@", "://***:***@")


_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
_PHONE = re.compile(r"(?<!\d)(?:\+33|0033|0)\s?(?:\(0\)\s?)?[1-9](?:[ .-]?\d{2}){4}(?!\d)")


def pii_masker(salt: str):
    """Pandas UDF that replaces e-mails, then phones, by labelled salted hashes of twelve digits."""

    def digest(value: str) -> str:
        return hashlib.sha256((salt + value).encode()).hexdigest()[:12]

    @F.pandas_udf(StringType())
    def mask(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            t = _MAIL.sub(lambda m: f"[email:{digest(m.group(0).lower())}]", t)
            return _PHONE.sub(lambda m: f"[phone:{digest(re.sub(r'[^0-9+]', '', m.group(0)))}]", t)

        return texts.map(one, na_action="ignore")

    return mask


def name_forms(c: Column) -> Column:
    """struct(letters, initial, acronym, core, confidence) of a company name.

    letters: all its letters together; acronym: first letters of two or more tokens; core:
    the longest token (the first of equals); confidence: .9 for one token, less .15 for
    each further one, not below .3. A name without tokens has nulls.
    """
    t = company_tokens(c)
    n = F.size(t)
    letters = F.nullif(F.regexp_replace(normalize_text(c), "[^a-z]", ""), F.lit(""))
    core = F.get(F.filter(t, lambda w: F.length(w) == F.array_max(F.transform(t, lambda x: F.length(x)))), F.lit(0))
    return F.struct(
        letters.alias("letters"), F.substring(letters, 1, 1).alias("initial"), F.when(n > 1, F.upper(F.array_join(F.transform(t, lambda w: F.substring(w, 1, 1)), ""))).alias("acronym"), core.alias("core"),
        F.when(n > 0, F.round(F.greatest(F.lit(0.3), F.lit(1.05) - 0.15 * n), 2)).alias("confidence"),
    )


def word_list(text: str) -> list[str]:
    """Entries of a list file: in small letters, without comments and blanks, each once in order."""
    return list(dict.fromkeys(w for line in text.splitlines() if (w := line.split("#", 1)[0].strip().lower())))
