"""Contacts of companies gathered from records and from pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contact import host, siren_prefix
from ..functions.web import email_of_domain


def _filled(c: str) -> Column:
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


def company_key(siren: str, domain: str) -> Column:
    """Nine digits of the SIREN, else the host of the domain, else null."""
    return F.coalesce(siren_prefix(F.col(siren)), host(F.col(domain)))


def company_contacts(df: DataFrame, order: str, scalars: list[str], lists: list[str], emails: str = "emails") -> DataFrame:
    """One row for each company: first filled scalars in row order, sorted distinct lists, fitting e-mails, best e-mail.

    E-mails count if they belong to the company's first known domain (or none is known);
    the best is the first nominative one, else the first. `emails` holds texts of one or
    more e-mails. Rows without company are left out.
    """
    rows = df.withColumn("key", company_key("siren", "domain")).filter("key is not null")
    first = lambda c, at=None: F.min_by(c, F.when(c.isNotNull(), F.col(order)))
    known = rows.groupBy("key").agg(first(host(F.col("domain"))).alias("own_domain"), *[first(_filled(c)).alias(c) for c in scalars])
    fits = lambda e: F.col("own_domain").isNull() | email_of_domain(e, F.col("own_domain"))
    mail = rows.select("key", F.explode(F.split(F.lower(emails), r"[;,|/\s]+")).alias("item")).filter("item like '%_@_%'").distinct()
    mail = mail.join(known.select("key", "own_domain"), "key").filter(fits(F.col("item"))).select("key", F.lit("emails").alias("list"), "item")
    for c in lists:
        mail = mail.unionByName(rows.select("key", F.lit(c).alias("list"), F.explode(F.col(c).cast("array<string>")).alias("item")).filter("trim(item) <> ''").distinct())
    sets = mail.groupBy("key").pivot("list", ["emails", *lists]).agg(F.array_sort(F.collect_set("item")))
    best = rows.withColumn("mail", F.lower(_filled("best_email"))).join(known.select("key", "own_domain"), "key").filter(F.col("mail").isNotNull() & fits(F.col("mail")))
    rank = F.struct((F.lower(F.trim("email_type")) != "nominative").alias("g"), F.col(order))
    best = best.groupBy("key").agg(F.min_by("mail", F.struct(F.coalesce(rank["g"], F.lit(True)).alias("g"), F.col(order))).alias("best_email"))
    return known.join(sets, "key", "left").join(best, "key", "left")


def split_by_contact(contacts: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a contact, rows without): array columns are looked at."""
    any_ = F.lit(False)
    for c in columns:
        any_ = any_ | (F.coalesce(F.size(c), F.lit(0)) > 0)
    return contacts.filter(any_), contacts.filter(~any_)


def page_contacts(pages: DataFrame, key: str) -> DataFrame:
    """(key, email, best_url, priority): for each e-mail of a key its best page.

    Pages are ordered by priority, failed status, nominative before generic, address;
    the minimum is taken before anything is gathered, so a large site stays small.
    """
    kind = F.coalesce(F.element_at("email_types", F.col("email")), F.lit("generic"))
    flat = pages.filter(F.col(key).isNotNull()).select(key, "url", "priority", "status", "email_types", F.explode("emails").alias("email"))
    rank = F.struct(F.col("priority"), (F.coalesce(F.col("status"), F.lit(0)) >= 400).cast("int").alias("bad"), (kind != "nominative").cast("int").alias("generic"), F.col("url"))
    return flat.groupBy(key, "email").agg(F.min(rank).alias("m")).select(key, "email", F.col("m.priority").alias("priority"), F.col("m.bad").alias("bad"), F.col("m.generic").alias("generic"), F.col("m.url").alias("best_url"))


def best_emails(found: DataFrame, key: str) -> DataFrame:
    """(key, best_email, email_type, n_emails) of page_contacts."""
    order = F.struct("priority", "bad", "generic", "email")
    return found.groupBy(key).agg(F.min(order).alias("m"), F.count("*").alias("n_emails")).select(key, F.col("m.email").alias("best_email"), F.when(F.col("m.generic") == 0, "nominative").otherwise("generic").alias("email_type"), "n_emails")


def crawl_targets(df: DataFrame, key: str, url: str, sets: list[str]) -> DataFrame:
    """(key, urls, ...): the distinct addresses of a key in order of their text, and the sorted values of other columns."""
    items = df.filter(F.col(key).isNotNull()).select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("list"), F.col(c).cast("string").alias("item")) for c in (url, *sets)])).alias("x")).select(key, "x.list", "x.item")
    return items.filter("trim(item) <> ''").distinct().groupBy(key).pivot("list", [url, *sets]).agg(F.array_sort(F.collect_list("item")))
