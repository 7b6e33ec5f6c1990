"""Readers: parquet, CSV, JSON logs, HTML folders, feeds, captured payloads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import contact as C
from ..functions import text as T


def read_parquet(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Parquet with the asked-for columns that exist (the others are left out)."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df.select(*[f"`{c}`" for c in columns if c in df.columns]) if columns else df


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, CSV, TSV or JSON lines, by the ending of the path."""
    end = path.rstrip("/*").rsplit(".", 1)[-1].lower()
    if end in ("csv", "tsv", "txt"):
        return spark.read.option("header", True).option("sep", "\t" if end == "tsv" else ",").option("multiLine", True).option("escape", '"').csv(path)
    if end in ("json", "jsonl", "ndjson"):
        return read_log(spark, path)
    return read_parquet(spark, path)


def resolve(spark: SparkSession, candidates: list[str]) -> str | None:
    """First path that exists on its file system."""
    jvm = spark.sparkContext._jvm
    for c in candidates:
        p = jvm.org.apache.hadoop.fs.Path(c)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p):
            return c
    return None


def read_log(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; unreadable lines are dropped. Without a schema: one `v` variant column."""
    if schema:
        return spark.read.schema(schema + ", _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path).filter("_bad is null").drop("_bad")
    return spark.read.text(path).select(F.expr("try_parse_json(value)").alias("v")).filter("v is not null")


def read_html(spark: SparkSession, folder: str) -> DataFrame:
    """(path, domain, html, title, text, links, emails, phones, social) of the HTML files of a folder."""
    raw = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    return html_fields(raw).withColumn("domain", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.html?$", ""))


def html_fields(df: DataFrame, html: str = "html") -> DataFrame:
    h = F.col(html)
    text = T.strip_tags(h)
    mails = F.array_distinct(F.concat(C.mailto_in(h), C.emails_in(C.deobfuscate(text))))
    return df.withColumns({"title": C.title_of(h), "text": text, "links": C.links_in(h), "emails": mails, "phones": C.phones_in(text), "social": C.socials_in(h)})


def feed_entries(df: DataFrame, xml: str = "xml", most: int = 10) -> DataFrame:
    """Entries of RSS 2.0 and Atom texts: (the other columns, pos, title, link, published), the first `most` of each."""
    rest = [c for c in df.columns if c != xml]
    plain = F.regexp_replace(xml, r'\sxmlns(:\w+)?="[^"]*"', "")
    both = lambda rss, atom: F.array_compact(F.concat(F.coalesce(F.xpath(plain, F.lit(rss)), F.array().cast("array<string>")), F.coalesce(F.xpath(plain, F.lit(atom)), F.array().cast("array<string>"))))
    rows = F.slice(F.arrays_zip(both("//item/title/text()", "//entry/title/text()").alias("title"), both("//item/link/text()", "//entry/link/@href").alias("link"), both("//item/pubDate/text()", "//entry/updated/text()").alias("published")), 1, most)
    return df.select(*rest, F.posexplode(rows).alias("pos", "e")).select(*rest, "pos", "e.title", "e.link", "e.published")


def sitemap_urls(df: DataFrame, xml: str = "xml", pattern: str = "/contact|mention") -> DataFrame:
    rest = [c for c in df.columns if c != xml]
    return df.select(*rest, F.explode(F.xpath(F.regexp_replace(xml, r'\sxmlns="[^"]*"', ""), F.lit("//loc/text()"))).alias("url")).filter(F.col("url").rlike(pattern))


def company_payload(json: Column) -> Column:
    """struct(name, siren, address, active, executives) of a captured company payload."""
    g = lambda *paths: F.coalesce(*[F.nullif(F.get_json_object(json, p), F.lit("")) for p in paths])
    people = F.from_json(g("$.representants", "$.dirigeants"), "array<struct<nom_complet:string,nom:string,prenom:string,qualite:string>>")
    return F.struct(
        g("$.nom_entreprise", "$.denomination", "$.nom").alias("name"), g("$.siren").alias("siren"),
        F.nullif(F.concat_ws(", ", g("$.siege.adresse_ligne_1"), g("$.siege.code_postal"), g("$.siege.ville")), F.lit("")).alias("address"),
        (F.lower(g("$.entreprise_cessee", "$.cessee")) == "false").alias("active"),
        F.transform(people, lambda p: F.coalesce(p["nom_complet"], F.concat_ws(" ", p["prenom"], p["nom"]))).alias("executives"),
    )


def ranked_results(df: DataFrame, query: str, url: str, generic: list[str], most: int = 10) -> DataFrame:
    """Search results with cleaned addresses, generic hosts dropped, ranked by position within the query."""
    from pyspark.sql import Window

    unwrapped = F.coalesce(F.try_url_decode(F.nullif(F.regexp_extract(url, r"[?&](?:uddg|u|url|q)=([^&]+)", 1), F.lit(""))), F.col(url))
    out = df.withColumn("url", C.strip_tracking(unwrapped)).withColumn("domain", C.host(F.col("url")))
    bad = F.lit(False)
    for g in generic:
        bad = bad | (F.col("domain") == g) | F.col("domain").endswith("." + g)
    w = Window.partitionBy(query).orderBy("position")
    return out.filter(~F.coalesce(bad, F.lit(True))).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def stream_folder(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A folder of parquet files as a stream."""
    return spark.readStream.schema(schema).parquet(folder)
