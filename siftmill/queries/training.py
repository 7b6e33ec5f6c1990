"""Queries of the general training-data problems (2 and 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import drift, packed
from ..session import cut, table


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    contacts = packed.split_packed(
        table(spark, base, "clean_contacts"), "contact_id", {"emails": ("clean_contacts.emails", "emails"), "phones": ("clean_contacts.phones", "phones")}
    )
    names = packed.split_packed(table(spark, base, "apify_agents"), "agent_row_id", {"apify_business_names": ("apify_agents.apify_business_names", "names")})
    return contacts.unionByName(names)


def _cells(spark: SparkSession, base: str, repeats: bool = False) -> DataFrame:
    return cut(drift.path_values(table(spark, base, "registry_files"), repeats))


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    return drift.schema_changes(_cells(spark, base))


def p6_table(spark: SparkSession, base: str) -> DataFrame:
    return drift.consistent_table(_cells(spark, base, True)).drop("failed_casts")


def p6_failed_casts(spark: SparkSession, base: str) -> DataFrame:
    return drift.failed_casts(drift.consistent_table(_cells(spark, base, True)))


QUERIES = {f.__name__: f for f in (p2_found, p6_found, p6_table, p6_failed_casts)}
