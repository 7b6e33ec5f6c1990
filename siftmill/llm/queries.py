"""Queries of the text and matching problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import addresses, boilerplate, leakage, names, packing, softlogic, survivorship, toxicity


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    conf = addresses.AddressConf()
    s = table(spark, base, "standardize")
    towns = addresses.commune_dictionary(s, "code_postal", "commune", conf)
    records = addresses.address_records(s, table(spark, base, "maps_scraper"), table(spark, base, "page_extraction"))
    return addresses.same_address(records, towns, conf)


def p1_classes(spark: SparkSession, base: str) -> DataFrame:
    conf = addresses.AddressConf()
    s = table(spark, base, "standardize")
    towns = addresses.commune_dictionary(s, "code_postal", "commune", conf)
    return addresses.address_classes(addresses.address_records(s, table(spark, base, "maps_scraper"), table(spark, base, "page_extraction")), towns, conf)


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return boilerplate.strip_boilerplate(table(spark, base, "page_result"))


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    s = table(spark, base, "standardize")
    towns = addresses.commune_dictionary(s, "code_postal", "commune", addresses.AddressConf())
    records = names.name_records(table(spark, base, "scrape_context"), table(spark, base, "maps_scraper"), s)
    return names.same_names(records, towns)


def p5_classes(spark: SparkSession, base: str) -> DataFrame:
    s = table(spark, base, "standardize")
    towns = addresses.commune_dictionary(s, "code_postal", "commune", addresses.AddressConf())
    return names.name_classes(names.name_records(table(spark, base, "scrape_context"), table(spark, base, "maps_scraper"), s), towns)


def p7_scored(spark: SparkSession, base: str) -> DataFrame:
    towns = addresses.commune_dictionary(table(spark, base, "standardize"), "code_postal", "commune", addresses.AddressConf())
    return softlogic.link(table(spark, base, "maps_scraper"), table(spark, base, "scrape_context"), towns)


def p7_found(spark: SparkSession, base: str) -> DataFrame:
    return p7_scored(spark, base).select("maps_id", "context_id")


def p8_containers(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack(table(spark, base, "documents"))


def p8_usage(spark: SparkSession, base: str) -> DataFrame:
    return packing.usage(p8_containers(spark, base))


def p9_found(spark: SparkSession, base: str) -> DataFrame:
    return leakage.find_leaks(table(spark, base, "documents"), table(spark, base, "eval_items"))


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return survivorship.survivors(table(spark, base, "clean_contacts"))


def _toxic_scores(spark: SparkSession, base: str, conf: toxicity.ToxicConf) -> DataFrame:
    documents = table(spark, base, "documents")
    sample = toxicity.labelled(documents, table(spark, base, "doc_labels"), conf)
    return toxicity.score_documents(documents, toxicity.fit_once(sample, conf))


def p10_found(spark: SparkSession, base: str) -> DataFrame:
    conf = toxicity.ToxicConf()
    return _toxic_scores(spark, base, conf).filter(F.col("score") >= conf.review).select("doc_id")


def p10_scores(spark: SparkSession, base: str) -> DataFrame:
    return _toxic_scores(spark, base, toxicity.ToxicConf())


def p10_rates(spark: SparkSession, base: str) -> DataFrame:
    conf = toxicity.ToxicConf()
    return toxicity.rates_by_source(_toxic_scores(spark, base, conf), conf)


QUERIES = {f.__name__: f for f in (p1_found, p1_classes, p3_found, p4_found, p5_found, p5_classes, p7_found, p7_scored, p8_containers, p8_usage, p9_found, p10_found, p10_scores, p10_rates)}
SQL: dict[str, str] = {}
