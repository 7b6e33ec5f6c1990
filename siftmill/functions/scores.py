"""Composite scores as column expressions. Times are given (`as_of`), never read from the clock."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .contact import FREE_MAIL, GENERIC_LOCALS, digits, department, email_check, email_kind, host, phone_check, registrable
from .numbers import employees, recency, revenue
from .text import blank_to_null


def _has(c: Column) -> Column:
    return F.coalesce(F.trim(blank_to_null(c.cast("string"))) != "", F.lit(False))


def _num(b: Column) -> Column:
    return F.coalesce(b, F.lit(False)).cast("double")


def contactability(best_email: Column, phone: Column, domain: Column, address: Column, site: Column, email: Column, raw_phone: Column, linkedin: Column) -> Column:
    parts = [
        (0.30, _has(best_email) & best_email.rlike(r"@.*\.")), (0.20, _has(phone)), (0.15, _has(domain)), (0.10, F.length(F.trim(blank_to_null(address))) > 10),
        (0.10, host(blank_to_null(site)).contains(".")), (0.05, email_check(email)["is_valid"]), (0.05, phone_check(raw_phone)["is_valid"]), (0.05, linkedin.rlike(r"linkedin\.com/company/[^/]+")),
    ]
    return F.least(F.lit(1.0), reduce(lambda a, b: a + b, [F.lit(w) * _num(c) for w, c in parts]))


def completeness(*fields: Column) -> Column:
    return reduce(lambda a, b: a + b, [_num(_has(f)) for f in fields]) / len(fields)


def freshness(day: Column, as_of: Column) -> Column:
    """1 less the age over three years (at most a half), never below .8; .8 without a date."""
    age = F.datediff(as_of, day) / (3 * 365)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.8), F.coalesce(1 - F.greatest(F.lit(0.0), F.least(F.lit(0.5), age)), F.lit(0.8))))


def quality(contact: Column, complete: Column, unique: Column, fresh: Column, weights=(50, 20, 20, 10)) -> Column:
    total = max(sum(weights), 1)
    return (contact * weights[0] + complete * weights[1] + unique * weights[2] + fresh * weights[3]) / total


def enrich(nominative: Column, has_email: Column, has_phone: Column, https_ok: Column, filled: Column, unique: Column, fresh: Column) -> Column:
    """0..100: contact (35 or 20, 20, 10) of 65 to 55, completeness of 30 to 20, unicity 5 each, freshness 10."""
    contact = F.when(nominative, 35).when(has_email, 20).otherwise(0) + F.when(has_phone, 20).otherwise(0) + F.when(https_ok, 10).otherwise(0)
    return contact / 65 * 55 + filled * 10 / 30 * 20 + unique * 5 + F.when(fresh, 10).otherwise(0)


def lead(email: Column, phone: Column, site: Column, address: Column, linkedin: Column, staff: Column, turnover: Column, naf: Column, activity: Column, created: Column, as_of: Column, weights=(0.40, 0.25, 0.15, 0.20)) -> Column:
    contact = F.lit(0.35) * _num(_has(email)) + F.lit(0.25) * _num(_has(phone)) + F.lit(0.20) * _num(_has(site)) + F.lit(0.10) * _num(_has(address)) + F.lit(0.10) * _num(_has(linkedin))
    e, r = employees(staff), revenue(turnover)
    es = F.when(e >= 250, 1.0).when(e >= 100, 0.85).when(e >= 50, 0.7).when(e >= 20, 0.55).when(e >= 10, 0.45).when(e >= 3, 0.30).when(e > 0, 0.15).otherwise(0.0)
    rs = F.when(r >= 5e7, 1.0).when(r >= 1e7, 0.85).when(r >= 2e6, 0.70).when(r >= 5e5, 0.55).when(r >= 1e5, 0.40).when(r > 0, 0.20).otherwise(0.0)
    n = F.upper(F.trim(blank_to_null(naf)))
    act = F.when(n.rlike(r"^\d{4}[A-Z]$"), 1.0).when(n.rlike(r"^\d{3}[A-Z]?$"), 0.75).when(n.rlike(r"^\d{2}$"), 0.55).when(F.length(n) >= 3, 0.35).when(F.length(F.trim(activity)) >= 10, 0.30).otherwise(0.0)
    total = sum(weights) or 1.0
    w = [x / total for x in weights]
    return F.round((contact * w[0] + F.greatest(es, rs) * w[1] + act * w[2] + recency(created, as_of) * w[3]) * 100, 2)


def email_score(email: Column, domain: Column) -> Column:
    local, own = F.lower(F.substring_index(email, "@", 1)), registrable(F.substring_index(email, "@", -1))
    want = registrable(domain)
    base = F.when(want.isNull(), 0.1).when(own == want, 0.45).when(own.endswith(F.concat(F.lit("."), want)), 0.35).when(F.substring_index(own, ".", -2) == F.substring_index(want, ".", -2), 0.25).otherwise(0.1)
    named = F.exists(F.split(local, r"[.\-_]+"), lambda t: (F.length(t) >= 3) & t.rlike("^[a-z]+$") & ~t.isin(GENERIC_LOCALS))
    who = F.when(named, 0.25).when((local != "") & ~local.isin(GENERIC_LOCALS), 0.05).otherwise(0.0)
    num = F.when(F.length(digits(local)) / F.nullif(F.length(local), F.lit(0)) >= 0.4, -0.1).otherwise(0.0)
    s = F.lit(0.2) + base + F.when(own.isin(FREE_MAIL), -0.3).otherwise(0.0) + who + num
    return F.when(email.contains("@"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)), 3)).otherwise(0.0)


def phone_score(phone: Column, area_ok: Column) -> Column:
    n = F.regexp_replace(digits(phone), "^(0033|33)", "0")
    n = F.when(n.startswith("0"), n).otherwise(F.concat(F.lit("0"), n))
    kind = F.when(n.rlike("^0[1-59]|^080|^081|^082|^089"), 0.5).otherwise(0.1)
    s = F.lit(0.25) + kind + F.when(n.rlike(r"^0[1-9]\d{8}$"), 0.05).when(F.length(n) < 9, -0.1).otherwise(0.0) + F.when(area_ok, 0.15).otherwise(0.0)
    return F.when(digits(phone) != "", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)), 3)).otherwise(0.0)


def coherence(email: Column, site: Column, phone: Column, linkedin: Column, country: Column) -> Column:
    """struct(score, flags): 50 and the deltas of the rules that apply, within 0..100."""
    own, want = registrable(F.substring_index(F.lower(email), "@", -1)), registrable(site)
    has = email.contains("@")
    local = F.lower(F.substring_index(email, "@", 1))
    slug = F.lower(F.regexp_extract(linkedin, r"linkedin\.com/(?:company|in)/([^/?#]+)", 1))
    token = F.replace(F.substring_index(want, ".", 1), F.lit("-"), F.lit(""))
    fits = F.exists(F.split(slug, r"[-_]|%20"), lambda t: (t != "") & ((t == token) | t.startswith(token) | token.startswith(t)))
    code = F.when(phone.rlike(r"^\s*(\+33|0033|0[1-9])"), "FR").when(phone.rlike(r"^\s*\+44"), "GB").when(phone.rlike(r"^\s*\+32"), "BE").when(phone.rlike(r"^\s*\+49"), "DE").when(phone.rlike(r"^\s*\+"), "ZZ")
    rule = lambda when, delta, flag: F.when(when, F.struct(F.lit(delta).alias("delta"), F.lit(flag).alias("flag")))
    phone_on = F.trim(phone) != ""
    rules = F.array_compact(
        F.array(
            F.coalesce(rule(has & own.isNotNull() & want.isNotNull() & ((own == want) | own.endswith(F.concat(F.lit("."), want))), 30, "email_domain_match"), rule(has & own.isNotNull() & want.isNotNull(), -20, "email_domain_mismatch")),
            F.coalesce(rule(has & own.isin(FREE_MAIL), -10, "generic_email_domain"), rule(has & F.exists(F.split(local, "[._]"), lambda t: t.isin(GENERIC_LOCALS)), -10, "generic_email_localpart")),
            F.coalesce(rule(phone_on & code.isNull(), -15, "phone_unparseable"), rule(phone_on & (code == F.upper(country)), 20, "phone_country_match"), rule(phone_on, -20, "phone_country_mismatch")),
            F.coalesce(rule(want.isNotNull() & (slug != "") & fits, 20, "linkedin_site_match"), rule(want.isNotNull() & (slug != ""), -15, "linkedin_site_mismatch"), rule(want.isNotNull() & (F.trim(linkedin) != ""), -15, "linkedin_path_unexpected")),
        )
    )
    total = F.aggregate(rules, F.lit(50), lambda s, r: s + r["delta"])
    return F.struct(F.greatest(F.lit(0), F.least(F.lit(100), total)).alias("score"), F.transform(rules, lambda r: r["flag"]).alias("flags"))


__all__ = ["contactability", "completeness", "freshness", "quality", "enrich", "lead", "email_score", "phone_score", "coherence", "department", "email_kind"]
