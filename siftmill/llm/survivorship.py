"""Best representative of each duplicate group, field by field.

Method: Bayesian fusion with copy detection. A claim is weighted by the accuracy of its
source (the kind of page it was found on) and of its age class (against the newest
usable claim of its field); both are estimated from the claims that agree with the
values which win. How far two sources copy each other is estimated from the false values
they share, copied votes are discounted pair by pair, and the value of the greatest
posterior survives. Lists are values as a whole: they survive from one record.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contact import page_kind
from ..operators.packed import split_packed
from ..session import cut

EMAIL = r"^[a-z0-9._%+\-]+@[a-z0-9\-]+(\.[a-z0-9\-]+)*\.[a-z]{2,}$"
AGES = (0, 30, 90, 180, 365)  # days: class k holds claims up to AGES[k] older than the newest


SOURCES = ("contact", "legal", "about", "privacy", "home", "other", "none")


@dataclass(frozen=True)
class FusionConf:
    """accuracy: start of the estimation, by age class (the last is for unreadable dates);
    copied: start of the share of copied claims of every two sources; values: assumed number
    of false values of a field; rounds: rounds of the estimation; shrink: claims that a
    source's own accuracy has to outweigh."""

    accuracy: tuple = (0.85, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)
    copied: float = 0.6
    values: int = 10
    rounds: int = 3
    shrink: float = 20.0


def siren_of(c: Column) -> Column:
    """Nine digits from a SIREN (spaced or not) or a fourteen-digit SIRET, else null."""
    d = F.regexp_replace(c, r"\D", "")
    return F.when(F.length(d).isin(9, 14), F.substring(d, 1, 9))


def host_of(c: Column) -> Column:
    h = F.regexp_replace(F.lower(F.trim(c)), r"^(https?://)?(www\.)?", "")
    return F.nullif(F.regexp_extract(h, r"^([^/?#:\s]+)", 1), F.lit(""))


def french_phone(c: Column) -> Column:
    """+33 and nine digits, or null for what is no full number."""
    d = F.regexp_replace(F.regexp_replace(c, r"\(0\)", ""), r"\D", "")
    d = F.regexp_replace(d, r"^(0033|33(?=\d{9}$)|0(?=\d{9}$))", "")
    return F.when(d.rlike(r"^[1-9]\d{8}$"), F.concat(F.lit("+33"), d))


def moment_of(c: Column) -> Column:
    """Timestamp of the formats delivered (day before month with slashes), else null."""
    t = F.trim(c)
    tries = [("yyyy-MM-dd'T'HH:mm:ssXXX", t), ("yyyy-MM-dd HH:mm:ss", t), ("dd/MM/yyyy HH:mm", t), ("yyyy-MM-dd", t), ("dd/MM/yyyy", t), ("yyyy-MM-dd'T'HH:mm:ss", t)]
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f, x in tries])


def with_company(contacts: DataFrame) -> DataFrame:
    """Adds `company`: the record's own SIREN, or the one its domain has elsewhere (most records; ties: least)."""
    c = contacts.withColumn("_own", siren_of(F.col("siren"))).withColumn("_host", host_of(F.col("domain")))
    by = c.filter("_own is not null and _host is not null").groupBy("_host", "_own").agg(F.count("*").alias("n"))
    known = by.groupBy("_host").agg(F.min_by("_own", F.struct(-F.col("n"), F.col("_own"))).alias("_linked"))
    # Rows that know their company skip the join, so a frequent domain weighs nothing.
    have = c.filter("_own is not null").withColumn("company", F.col("_own"))
    miss = c.filter("_own is null and _host is not null").join(known, "_host").withColumn("company", F.col("_linked")).drop("_linked")
    return have.unionByName(miss).drop("_own", "_host")


def claims_of(contacts: DataFrame) -> DataFrame:
    """(company, field, value array, source, t, confidence, n): usable claims, exact repeats collapsed."""
    items = split_packed(contacts, "contact_id", {"emails": ("email", "emails"), "phones": ("phone", "phones")})
    item = F.when(F.col("field") == "email", F.when(F.lower("item").rlike(EMAIL), F.lower("item"))).otherwise(french_phone(F.col("item")))
    lists = (
        items.withColumn("v", item).filter("v is not null").groupBy(F.col("row_id").alias("contact_id"), "field")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("l"))
        .select("contact_id", "field", F.array_distinct(F.transform("l", lambda x: x["v"])).alias("value"))
    )
    mail = F.lower(F.trim("best_email"))
    best = contacts.filter(mail.rlike(EMAIL)).select("contact_id", F.lit("best_email").alias("field"), F.array(mail).alias("value"))
    who = contacts.select("contact_id", "company", source_of(F.col("best_page"), F.col("top_url")).alias("source"), moment_of(F.col("discovered_at")).alias("t"), F.col("confidence").cast("double").alias("confidence"))
    rows = lists.unionByName(best).join(who, "contact_id")
    return rows.groupBy("company", "field", "value", "source", "t").agg(F.max(F.nanvl("confidence", F.lit(None))).alias("confidence"), F.count("*").alias("n"))


def source_of(page: Column, url: Column) -> Column:
    """Number of the source in SOURCES: the kind of page that a record was taken from."""
    kind = F.when(F.trim(page) != "", page_kind(page)).when(F.trim(url) != "", page_kind(url)).otherwise("none")
    return F.array_position(F.array(*[F.lit(k) for k in SOURCES]), kind).cast("int") - 1


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _table(values: list[float], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), at + 1)


def fuse(claims: DataFrame, conf: FusionConf = FusionConf()) -> DataFrame:
    """(company, field, value): the value of greatest posterior.

    A vote counts (1 - share of copies) for every stronger vote of the same value, by the
    pair of sources. Ties go to the newest, most confident, most complete value, then to
    the least text. A null source counts as none of the known.
    """
    kinds = len(SOURCES)
    newest = claims.groupBy("company", "field").agg(F.max("t").alias("last"))
    days = F.datediff("last", "t")
    age = F.when(F.col("t").isNull(), len(AGES) + 1).when(F.col("t") == F.col("last"), 0)
    for k, most in enumerate(AGES[1:], 1):
        age = age.when(days <= most, k)
    aged = claims.join(newest, ["company", "field"]).withColumn("k", age.otherwise(len(AGES)).cast("int")).withColumn("s", F.coalesce("source", F.lit(kinds - 1)))
    # At most one vote for each source and age class of a value, so its list of votes is short.
    votes = cut(
        aged.groupBy("company", "field", "value", "s", "k").agg(F.max("t").alias("t"), F.max("confidence").alias("confidence"))
        .groupBy("company", "field", "value").agg(F.collect_list(F.struct("s", "k")).alias("votes"), F.max("t").alias("t"), F.max("confidence").alias("confidence"))
    )
    accuracy, offset = list(conf.accuracy), [0.0] * kinds
    copies = [[conf.copied] * kinds for _ in range(kinds)]
    key = ["company", "field"]
    for last in [False] * conf.rounds + [True]:
        ages = [_logit(a) for a in accuracy]
        weigh = lambda v: F.greatest(F.lit(0.01), math.log(conf.values) + _table(ages, v["k"]) + _table(offset, v["s"]))  # noqa: E731, B023
        ranked = F.reverse(F.array_sort(F.transform("votes", lambda v: F.struct(weigh(v).alias("w"), v["s"].alias("s"), v["k"].alias("k")))))
        kept = [1 - c for row in copies for c in row]
        counted = lambda v, i: v["w"] * F.aggregate(F.slice("ranked", F.lit(1), i), F.lit(1.0), lambda acc, u: acc * _table(kept, v["s"] * kinds + u["s"]))  # noqa: E731, B023
        scored = votes.withColumn("ranked", ranked).withColumn("score", F.aggregate(F.transform("ranked", counted), F.lit(0.0), lambda a, x: a + x))
        order = F.struct(F.round("score", 9).alias("score"), "t", "confidence", F.size("value").alias("size"), F.expr("transform(value, x -> -crc32(x))").alias("text"))
        best = scored.groupBy(*key).agg(F.max_by("value", order).alias("top"))
        if last:
            return best.withColumnRenamed("top", "value")
        judged = cut(votes.join(best, key).select(*key, "value", "votes", (F.col("value") == F.col("top")).alias("right")))
        # All that reaches the driver has at most a row for each source and age class, or each pair of sources.
        stats = judged.select("right", F.explode("votes").alias("v")).groupBy("v.s", "v.k").agg(F.count("*").alias("n"), F.sum(F.col("right").cast("int")).alias("right")).collect()
        for k in range(len(accuracy)):
            n, right = sum(r["n"] for r in stats if r["k"] == k), sum(r["right"] for r in stats if r["k"] == k)
            if n:
                accuracy[k] = min(0.99, max(0.02, 0.5 * accuracy[k] + 0.5 * right / n))
        for s in range(kinds):
            mine = [r for r in stats if r["s"] == s]
            n, right = sum(r["n"] for r in mine), sum(r["right"] for r in mine)
            hoped = sum(r["n"] * accuracy[r["k"]] for r in mine)
            if n:
                offset[s] = (_logit((right + 0.5) / (n + 1)) - _logit((hoped + 0.5) / (n + 1))) * n / (n + conf.shrink)
        copies = _copies(judged.filter(~F.col("right")), key, copies, conf)
    return best


def _copies(false: DataFrame, key: list[str], before: list[list[float]], conf: FusionConf) -> list[list[float]]:
    """Share of copied claims of every two sources: how much oftener than by chance they give one false value."""
    kinds = len(SOURCES)
    lone = false.select(*key, F.array_sort(F.array_distinct(F.transform("votes", lambda v: v["s"]))).alias("s"), F.size("votes").alias("n"))
    pair = lambda c: F.explode(F.flatten(F.transform(c, lambda a: F.transform(c, lambda b: F.struct(a.alias("a"), b.alias("b"))))))
    shared = lone.select(pair("s").alias("p"), (F.col("n") > F.size("s")).alias("twice")).groupBy("p.a", "p.b").agg(F.sum(((F.col("p.a") != F.col("p.b")) | F.col("twice")).cast("int")).alias("n"))
    each = lone.select(*key, F.explode("s").alias("s")).groupBy(*key, "s").agg(F.count("*").alias("n")).groupBy(*key).agg(F.collect_list(F.struct("s", "n")).alias("f"))
    # Pairs of false claims: those of two values, and those of one value which both sources give.
    met = each.select(pair("f").alias("p")).groupBy(F.col("p.a.s").alias("a"), F.col("p.b.s").alias("b")).agg(F.sum(F.col("p.a.n") * F.col("p.b.n")).alias("n"))
    out = [row[:] for row in before]
    total = {(r["a"], r["b"]): r["n"] for r in met.collect()}
    chance = 1 / conf.values
    for r in shared.collect():
        n = total.get((r["a"], r["b"]), 0)
        if n:
            share = max(0.0, (r["n"] / n - chance) / (1 - chance))
            out[r["a"]][r["b"]] = min(0.95, max(0.05, (before[r["a"]][r["b"]] * conf.shrink + share * n) / (n + conf.shrink)))
    return out


def survivors(contacts: DataFrame, conf: FusionConf = FusionConf()) -> DataFrame:
    """(siren, field, item): surviving values of each company with two or more records.

    Fields: best_email, email, phone, discovered_on. Placeholders, malformed values,
    nulls and blanks never survive; a field without a usable value has no row; records
    without company are left out; repeated rows count as copies; an empty table gives
    an empty result; extra columns are ignored; without `best_page` and `top_url` all
    records have one source.
    """
    pages = [F.col(c) if c in contacts.columns else F.lit(None).cast("string").alias(c) for c in ("best_page", "top_url")]
    rows = with_company(contacts.select("contact_id", "siren", "domain", "best_email", "emails", "phones", "confidence", "discovered_at", *pages))
    rows = cut(rows)
    groups = rows.groupBy("company").agg(F.count("*").alias("n"), F.max(moment_of(F.col("discovered_at"))).alias("last")).filter("n > 1")
    fused = fuse(claims_of(rows), conf).join(groups.select("company"), "company", "left_semi")
    values = fused.select(F.col("company").alias("siren"), "field", F.explode("value").alias("item"))
    dates = groups.filter("last is not null").select(F.col("company").alias("siren"), F.lit("discovered_on").alias("field"), F.date_format("last", "yyyy-MM-dd").alias("item"))
    return values.unionByName(dates)
