"""Candidates and their choice: best of several, quality levels, features of addresses and texts, guesses of industries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.contact import GENERIC_LOCALS, host, phone_check
from ..functions.dimensions import industry
from ..functions.text import blank_to_null, normalize_text

# Words of names and hosts that tell an industry.
INDUSTRY_WORDS = {
    "Construction": "batiment construction maconnerie plomberie electricite menuiserie couverture", "Restaurants": "restaurant brasserie pizzeria traiteur cafe", "Retail": "boutique magasin librairie fleuriste",
    "Automotive": "garage auto carrosserie", "Health": "pharmacie clinique dentaire optique", "Information Technology & Services": "informatique logiciel digital web", "Legal Services": "avocat notaire juridique",
}
LEVELS = {"low": 0, "medium": 1, "high": 2}


def best_candidate(df: DataFrame, group: str, order: list[Column], take: list[str]) -> DataFrame:
    """(group, ...): the taken columns of the first candidate in the order (a minimum; nothing is gathered)."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *take)
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.min(rank).alias("m")).select(group, *[F.col(f"m.{c}").alias(c) for c in take])


def candidates_json(df: DataFrame, group: str, item: str, score: str, most: int = 10) -> DataFrame:
    """(group, best, best_score, candidates): the best item and the first `most` by score as JSON; ties by item."""
    once = df.filter(F.col(group).isNotNull() & F.col(item).isNotNull()).groupBy(group, item).agg(F.max(score).alias("score"))
    top = once.withColumn("n", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), item))).filter(F.col("n") <= most)
    rows = top.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("n", F.col(item).alias("value"), "score"))).alias("l"))
    plain = F.transform("l", lambda x: F.struct(x["value"].alias("value"), x["score"].alias("score")))
    return rows.select(group, F.get("l", F.lit(0))["value"].alias("best"), F.get("l", F.lit(0))["score"].alias("best_score"), F.to_json(plain).alias("candidates"))


def parsed_candidates(c: Column) -> Column:
    """array(struct(value, score)) of a JSON list of texts or of objects (value, domain or url; score)."""
    objects = F.from_json(c, "array<struct<value:string,domain:string,url:string,score:double>>")
    full = F.transform(objects, lambda x: F.struct(F.lower(F.coalesce(x["value"], x["domain"], host(x["url"]))).alias("value"), x["score"].alias("score")))
    texts = F.transform(F.from_json(c, "array<string>"), lambda x: F.struct(F.lower(F.trim(x)).alias("value"), F.lit(None).cast("double").alias("score")))
    is_object = F.trim(c).rlike(r"^\[\s*\{")
    return F.filter(F.when(is_object, full).otherwise(texts), lambda x: x["value"].isNotNull() & (x["value"] != ""))


def level(score: Column) -> Column:
    """high from .8, medium from .6, else low."""
    return F.when(score >= 0.8, "high").when(score >= 0.6, "medium").otherwise("low")


def quality_filter(df: DataFrame, score: str, least: float | None = None, at_least: str | None = None) -> DataFrame:
    """Rows whose score reaches a bound and whose level reaches another; null scores count 0."""
    s = F.coalesce(F.col(score), F.lit(0.0))
    out = df.filter(s >= least) if least is not None else df
    if at_least is not None:
        out = out.filter(F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])[level(s)] >= LEVELS[at_least])
    return out


def quality_report(df: DataFrame, score: str, fields: list[str]) -> DataFrame:
    """(kind, name, n): rows by level, and rows in which each field is filled."""
    levels = df.groupBy(level(F.coalesce(F.col(score), F.lit(0.0))).alias("name")).agg(F.count("*").alias("n")).select(F.lit("level").alias("kind"), "name", "n")
    one = df.agg(*[F.count_if(blank_to_null(F.col(f).cast("string")).isNotNull()).alias(f) for f in fields])
    rows = one.select(F.inline(F.array(*[F.struct(F.lit("field").alias("kind"), F.lit(f).alias("name"), F.col(f).alias("n")) for f in fields])))
    return levels.unionByName(rows)


def address_features(c: Column) -> Column:
    """struct of nineteen features of an address text (lengths, counts, shares and marks)."""
    t = F.coalesce(F.trim(c), F.lit(""))
    low = F.lower(t)
    words = F.filter(F.split(low, r"\s+"), lambda w: w != "")
    has = lambda rx: low.rlike(rx).cast("int")
    count = lambda rx: F.size(F.regexp_extract_all(t, F.lit(f"({rx})"), F.lit(1)))
    share = lambda rx: F.round(F.coalesce(F.length(F.regexp_replace(t, f"(?!{rx}).", "")) / F.nullif(F.length(t), F.lit(0)), F.lit(0.0)), 6)
    code = F.regexp_extract(t, r"\b(\d{5})\b", 1)
    return F.struct(
        F.length(t).alias("length"), F.size(words).alias("words"), count(",").alias("commas"), count(r"\d+").alias("numbers"), share(r"\d").alias("digit_share"), share("[A-Z]").alias("upper_share"),
        has(r"^\d").alias("starts_with_number"), has(r"\b(bis|ter|quater)\b").alias("suffix"), has(r"\b(rue|avenue|boulevard|place|chemin|impasse|allée|route|square|cours|quai)\b").alias("way"),
        has(r"\b(av|bd|bld|pl|che|imp|all|rte|sq|crs)\b").alias("short_way"), has(r"\b(zone|z\.?a\.?|z\.?i\.?|zac|parc)\b").alias("zone"), has(r"\b(bât|bat|bâtiment|étage|appt|résidence|immeuble)\b").alias("inside"),
        (code != "").cast("int").alias("code"), F.substring(code, 1, 2).alias("department"), has(r"cedex").alias("cedex"), has(r"france").alias("country"), has(r"lieu-?dit").alias("named_place"),
        F.coalesce(F.array_max(F.transform(words, lambda w: F.length(w))), F.lit(0)).alias("longest"), has(r"[^\w\s,.'’()/-]").alias("odd_signs"),
    )


def text_features(c: Column) -> Column:
    """struct of sixteen features of a text."""
    t = F.coalesce(c, F.lit(""))
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    count = lambda rx: F.size(F.regexp_extract_all(t, F.lit(f"({rx})"), F.lit(1)))
    part = lambda n: F.round(F.coalesce(n / F.nullif(F.length(t), F.lit(0)), F.lit(0.0)), 6)
    n = lambda rx: F.length(F.regexp_replace(t, rx, ""))
    return F.struct(
        F.length(t).alias("length"), F.size(words).alias("words"), F.size(F.array_distinct(words)).alias("different"), count(r"\n").alias("lines"), count(r"[.!?]+").alias("sentences"), count(r"\d+").alias("numbers"),
        count(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+").alias("mails"), count(r"https?://").alias("links"), count(r"0[1-9](?:[ .-]?\d{2}){4}").alias("phones"), part(n("[^0-9]")).alias("digit_share"), part(n("[^A-Z]")).alias("upper_share"),
        part(n(r"[^.,;:!?]")).alias("sign_share"), part(n(r"\S")).alias("blank_share"), F.coalesce(F.array_max(F.transform(words, lambda w: F.length(w))), F.lit(0)).alias("longest"),
        F.round(F.coalesce(F.aggregate(words, F.lit(0), lambda s, w: s + F.length(w)) / F.nullif(F.size(words), F.lit(0)), F.lit(0.0)), 6).alias("mean_word"), F.lower(t).rlike(r"\b(contact|adresse|téléphone|mentions)\b").cast("int").alias("contact_words"),
    )


def guessed_industry(naf: Column, label: Column, name: Column, domain: Column) -> Column:
    """Industry by activity code, else by words of the label, of the name, of the domain; null if none tells."""

    def told(c: Column) -> Column:
        t = F.concat(F.lit(" "), normalize_text(c))
        return reduce(lambda out, kv: out.when(t.rlike(" (" + "|".join(kv[1].split()) + ")"), kv[0]), INDUSTRY_WORDS.items(), F.when(F.lit(False), F.lit(None).cast("string")))

    return F.coalesce(industry(naf), told(label), told(name), told(domain))


def contact_confidence(kind: Column, value: Column) -> Column:
    """Phone .7 and .2 if valid, e-mail .6 (.8 where it is nobody's mailbox in particular), site .7 and .1 for https."""
    local = F.lower(F.substring_index(value, "@", 1))
    return F.round(
        F.when(kind == "phone", F.lit(0.7) + F.when(phone_check(value)["is_valid"], 0.2).otherwise(0.0))
        .when(kind == "email", F.when(local.isin(GENERIC_LOCALS), 0.8).otherwise(0.6))
        .when(kind == "site", F.lit(0.7) + F.when(value.startswith("https"), 0.1).otherwise(0.0))
        .otherwise(0.0), 2,
    )


def heuristic_email(existing: Column, valid: Column, listed: Column, first: Column, last: Column, domain: Column) -> Column:
    """A valid known e-mail, else the first listed one, else those a person and a host may have."""
    at = lambda x: F.when((x != "") & domain.isNotNull(), F.concat(x, F.lit("@"), domain))
    f, n = normalize_text(first), normalize_text(last)
    one = F.filter(F.split(F.lower(listed), r"[;,\s]+"), lambda x: x.contains("@"))
    return F.coalesce(F.when(valid, existing), F.get(one, F.lit(0)), at(F.concat(f, F.lit("."), n)), at(F.lit("contact")))
