"""Queries of candidates and their choice, quality levels, features, text lists and event states, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import contact as C
from ..functions import matching as M
from ..functions import numbers as N
from ..functions import scores as S
from ..functions import text as T
from ..functions import web as W
from ..operators import enrichment as B
from ..operators import quality as Q
from ..operators import relational as R
from ..session import table
from ..streaming import events as E
from .catalogue import _EOK, _GL, _LF, _STEPS, _b, _h, _host, _norm
from .deliveries import _STAFF

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_LVL = lambda c: f"(CASE WHEN {c} >= 0.8 THEN 'high' WHEN {c} >= 0.6 THEN 'medium' ELSE 'low' END)"


@query("SELECT siren, arg_min(best_page, (coalesce(rank, 1e9)::DOUBLE * 1000000000 + contact_id)) AS best_page FROM clean_contacts WHERE siren IS NOT NULL AND best_page IS NOT NULL GROUP BY 1")
def best_result(spark, base):
    df = table(spark, base, "clean_contacts").filter("best_page is not null")
    return B.best_candidate(df, "siren", [F.coalesce(F.col("rank").cast("double"), F.lit(1e9)), F.col("contact_id")], ["best_page"])


@query(f"""WITH o AS (SELECT siren, {_host('domain')} AS d, max(round(confidence, 4)) AS s FROM clean_contacts WHERE siren IS NOT NULL AND {_host('domain')} IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY siren ORDER BY s DESC NULLS LAST, d) AS n FROM o)
SELECT siren, max(d) FILTER (WHERE n = 1) AS best, max(s) FILTER (WHERE n = 1) AS best_score, least(count(*), 10) AS n FROM r GROUP BY 1""")
def domain_candidates_of_company(spark, base):
    df = table(spark, base, "clean_contacts").select("siren", C.host(F.col("domain")).alias("d"), F.round("confidence", 4).alias("s"))
    out = B.candidates_json(df, "siren", "d", "s")
    return out.select("siren", "best", "best_score", F.size(B.parsed_candidates(F.col("candidates"))).cast("long").alias("n"))


@query(f"SELECT {_LVL('coalesce(confidence, 0.0)')} AS level, count(*) AS n FROM clean_contacts WHERE coalesce(confidence, 0.0) >= 0.3 AND {_LVL('coalesce(confidence, 0.0)')} IN ('medium','high') GROUP BY 1")
def quality_levels(spark, base):
    df = B.quality_filter(table(spark, base, "clean_contacts"), "confidence", 0.3, "medium")
    return df.groupBy(B.level(F.col("confidence")).alias("level")).agg(F.count("*").alias("n"))


@query(f"""SELECT 'level' AS kind, {_LVL('coalesce(confidence, 0.0)')} AS name, count(*) AS n FROM clean_contacts GROUP BY 2
UNION ALL SELECT 'field', 'best_email', count({_b('best_email')}) FROM clean_contacts UNION ALL SELECT 'field', 'phones', count({_b('phones')}) FROM clean_contacts UNION ALL SELECT 'field', 'domain', count({_b('domain')}) FROM clean_contacts""")
def quality_report(spark, base):
    return B.quality_report(table(spark, base, "clean_contacts"), "confidence", ["best_email", "phones", "domain"])


_AT = "coalesce(trim(address_complete), '')"
_HAS = lambda rx: f"regexp_matches(lower({_AT}), '{rx}')::INT"


@query(f"""SELECT maps_id, length({_AT})::INT AS length, len(list_filter(string_split_regex(lower({_AT}), '\\s+'), lambda w: w <> ''))::INT AS words, len(regexp_extract_all({_AT}, ','))::INT AS commas, len(regexp_extract_all({_AT}, '[0-9]+'))::INT AS numbers,
{_HAS('^[0-9]')} AS starts_with_number, (regexp_extract({_AT}, '\\b([0-9]{{5}})\\b', 1) <> '')::INT AS code, substr(regexp_extract({_AT}, '\\b([0-9]{{5}})\\b', 1), 1, 2) AS department, {_HAS('cedex')} AS cedex, {_HAS('france')} AS country FROM maps_scraper""")
def address_features(spark, base):
    f = B.address_features(F.col("address_complete"))
    return table(spark, base, "maps_scraper").select("maps_id", *[f[c].alias(c) for c in ("length", "words", "commas", "numbers", "starts_with_number", "code", "department", "cedex", "country")])


@query("""SELECT page_id, length(t)::INT AS length, len(list_filter(string_split_regex(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> ''))::INT AS words, len(regexp_extract_all(t, '\\n'))::INT AS lines, len(regexp_extract_all(t, '[0-9]+'))::INT AS numbers, len(regexp_extract_all(t, 'https?://'))::INT AS links,
round(coalesce(length(regexp_replace(t, '[^0-9]', '', 'g'))::DOUBLE / nullif(length(t), 0), 0.0), 6) AS digit_share FROM (SELECT page_id, coalesce(text, '') AS t FROM page_result)""")
def text_features(spark, base):
    f = B.text_features(F.col("text"))
    return table(spark, base, "page_result").select("page_id", *[f[c].alias(c) for c in ("length", "words", "lines", "numbers", "links", "digit_share")])


def _told(c: str) -> str:
    return "(CASE " + " ".join(f"WHEN regexp_matches(' ' || {c}, ' ({'|'.join(w.split())})') THEN '{k}'" for k, w in B.INDUSTRY_WORDS.items()) + " END)"


@query(f"SELECT context_id, coalesce({_told(_norm('denomination'))}, {_told(_norm('siteweb'))}) AS industry FROM scrape_context")
def guessed_industry(spark, base):
    none = F.lit(None).cast("string")
    return table(spark, base, "scrape_context").select("context_id", B.guessed_industry(none, none, F.col("denomination"), F.col("siteweb")).alias("industry"))


@query(f"""SELECT contact_id, coalesce(CASE WHEN confidence >= 0.5 THEN lower(best_email) END, list_filter(string_split_regex(lower(emails), '[;,\\s]+'), lambda x: contains(x, '@'))[1], 'contact@' || {_host('domain')}) AS email FROM clean_contacts""")
def heuristic_emails(spark, base):
    none = F.lit(None).cast("string")
    e = B.heuristic_email(F.lower("best_email"), F.col("confidence") >= 0.5, F.col("emails"), none, none, C.host(F.col("domain")))
    return table(spark, base, "clean_contacts").select("contact_id", e.alias("email"))


@query("""WITH v AS (SELECT row_id, 'phone' AS kind, telephone AS value FROM standardize UNION ALL SELECT row_id, 'site', siteweb FROM standardize)
SELECT row_id, kind, (CASE WHEN kind = 'site' THEN CASE WHEN starts_with(value, 'https') THEN 0.8 ELSE 0.7 END END)::DOUBLE AS confidence FROM v WHERE value IS NOT NULL AND kind = 'site'""")
def contact_confidences(spark, base):
    rows = table(spark, base, "standardize").select("row_id", F.explode(F.array(F.struct(F.lit("phone").alias("kind"), F.col("telephone").alias("value")), F.struct(F.lit("site").alias("kind"), F.col("siteweb").alias("value")))).alias("x")).select("row_id", "x.kind", "x.value")
    return rows.filter("value is not null and kind = 'site'").select("row_id", "kind", B.contact_confidence(F.col("kind"), F.col("value")).alias("confidence"))


@query("SELECT contact_id, len(list_filter(list_transform(string_split_regex(regexp_replace(emails, '[\\[\\]]', '', 'g'), '[;,]'), lambda x: trim(x)), lambda x: x <> '' AND lower(x) NOT IN ('nan','none','null')))::INT AS n FROM clean_contacts WHERE emails IS NOT NULL AND NOT starts_with(trim(emails), '[') AND NOT starts_with(trim(emails), '{')")
def listed_values(spark, base):
    df = table(spark, base, "clean_contacts").filter("emails is not null and not startswith(trim(emails), '[') and not startswith(trim(emails), '{')")
    return df.select("contact_id", F.size(Q.extract_values(F.col("emails"))).alias("n"))


@query(f"""WITH s AS (SELECT maps_id, round((CASE WHEN regexp_matches(t, '[0-9]+') THEN 0.2 ELSE 0 END) + (CASE WHEN length(t) >= 15 THEN 0.1 ELSE 0 END), 2) AS a, (CASE WHEN denomination IS NOT NULL THEN 1.0 ELSE 0.4 END) AS c FROM (SELECT *, lower(coalesce(address_complete,'')) AS t FROM maps_scraper))
SELECT maps_id, round(a * 0.7 + c * 0.3, 4)::DOUBLE AS rank_score FROM s WHERE a >= 0.3 ORDER BY rank_score DESC, maps_id LIMIT 100""")
def ranked_inputs(spark, base):
    """Inputs whose address and company are good enough, the best first."""
    t = F.lower(F.coalesce("address_complete", F.lit("")))
    a = F.round(F.when(t.rlike(r"\d+"), 0.2).otherwise(0.0) + F.when(F.length(t) >= 15, 0.1).otherwise(0.0), 2)
    c = F.when(F.col("denomination").isNotNull(), 1.0).otherwise(0.4)
    df = table(spark, base, "maps_scraper").select("maps_id", a.alias("a"), c.alias("c")).filter("a >= 0.3")
    return df.select("maps_id", M.combined(F.col("a"), F.col("c")).alias("rank_score")).orderBy(F.desc("rank_score"), "maps_id").limit(100)


@query(f"SELECT row_id, nullif(concat_ws(' | ', {_b('denomination')}, {_b('commune')}, CASE WHEN {_b('naf')} IS NOT NULL THEN 'NAF ' || naf END), '') AS text FROM standardize")
def company_texts(spark, base):
    c = lambda n: T.blank_to_null(F.col(n))
    return table(spark, base, "standardize").select("row_id", F.nullif(F.concat_ws(" | ", c("denomination"), c("commune"), F.concat(F.lit("NAF "), c("naf"))), F.lit("")).alias("text"))


@query("""SELECT CASE WHEN lower(trim(etat_administratif)) = 'a' THEN 'France' END AS country, count(*) AS n FROM standardize GROUP BY 1""")
def countries(spark, base):
    c = M.country_code(F.when(F.lower(F.trim("etat_administratif")) == "a", F.lit("France")))
    return table(spark, base, "standardize").groupBy(F.when(c == "FR", "France").alias("country")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE word_hit) AS hits FROM (SELECT agent_row_id, len(list_filter(list_transform(string_split(lower(company_name), ' ')[1:2], lambda w: contains(lower(adresse), w)), lambda x: x)) > 0 AS word_hit FROM apify_agents WHERE company_name IS NOT NULL AND adresse IS NOT NULL)")
def words_in_address(spark, base):
    df = table(spark, base, "apify_agents").filter("company_name is not null and adresse is not null")
    hit = F.exists(F.slice(F.split(F.lower("company_name"), " "), 1, 2), lambda w: F.contains(F.lower("adresse"), w))
    return df.agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))


@query("""WITH p AS (SELECT domain, list_sort(list_distinct(flatten(list(emails)))) AS e FROM page_result WHERE domain IS NOT NULL AND emails IS NOT NULL GROUP BY 1), c AS (SELECT DISTINCT domain FROM page_extraction WHERE coalesce(len(emails), 0) = 0 AND domain IS NOT NULL)
SELECT c.domain, array_to_string(p.e, ';') AS emails FROM c JOIN p USING (domain) WHERE len(p.e) > 0""")
def group_lookup(spark, base):
    """Sites without an extracted e-mail, with the e-mails that stand on their pages."""
    bare = table(spark, base, "page_extraction").filter("coalesce(size(emails), 0) <= 0 and domain is not null").select("domain").distinct()
    mails = table(spark, base, "page_result").filter("domain is not null").select("domain", F.explode("emails").alias("e")).distinct().join(bare, "domain", "left_semi")
    return mails.groupBy("domain").agg(F.array_join(F.array_sort(F.collect_list("e")), ";").alias("emails"))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAYS")
def retained_events(spark, base):
    return E.retained(table(spark, base, "events"), "2024-01-30 00:00:00", 7).select("event_id")


@query("""WITH RECURSIVE o AS (SELECT user_id, ts, event_id, avg((event_type = 'error')::INT) OVER w AS s, count(*) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)),
e AS (SELECT user_id::VARCHAR AS key, floor(epoch(ts))::BIGINT * 1000000000 + event_id AS x FROM o WHERE s >= 0.5 AND n >= 2), """ + _STEPS)
def breaker_cooldown(spark, base):
    """Circuits of users that open, and stay open for an hour."""
    df = table(spark, base, "events")
    opened = E.breaker(df, "user_id", "event_type = 'error'", 6 * 3600, 0.5, 2).filter("opened").select("event_id")
    return E.alerts(df.join(opened, "event_id", "left_semi"), "user_id", "true", 3600)


_N8 = "list_max(list_transform(regexp_extract_all(effectif, '([0-9]+)', 1), lambda x: x::BIGINT))"


@query(f"SELECT row_id, coalesce({_STAFF}, CASE WHEN {_N8} <= 10 THEN '1-10' WHEN {_N8} <= 50 THEN '11-50' WHEN {_N8} <= 200 THEN '51-200' WHEN {_N8} <= 500 THEN '201-500' WHEN {_N8} <= 1000 THEN '501-1000' WHEN {_N8} <= 5000 THEN '1001-5000' WHEN {_N8} <= 10000 THEN '5001-10000' WHEN {_N8} IS NOT NULL THEN '10000+' END) AS size FROM standardize")
def size_classes(spark, base):
    return table(spark, base, "standardize").select("row_id", N.size_class(F.col("effectif")).alias("size"))


@query("SELECT row_id, coalesce(date_diff('day', try_cast(date_creation AS DATE), DATE '2024-06-30') BETWEEN 0 AND 365, false) AS recent FROM standardize")
def recent_records(spark, base):
    return table(spark, base, "standardize").select("row_id", N.recent(F.col("date_creation"), F.lit("2024-06-30").cast("date"), 365).alias("recent"))


@query("SELECT user_id, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error') AS errors, round(count(*) FILTER (WHERE event_type = 'error') * 100.0 / count(*), 4)::DOUBLE AS error_rate, round(sum(value), 4) AS total FROM events GROUP BY 1")
def request_counters(spark, base):
    return Q.request_counters(table(spark, base, "events"), "user_id", F.col("event_type") == "error", "value")


@query("SELECT 'k' AS key, max(try_cast(json_extract_string(props, '$.k') AS DOUBLE)) AS top FROM events HAVING count(*) > 0")
def greatest_in_json(spark, base):
    return Q.greatest_in_json(table(spark, base, "events"), "props", "k")


_LOCAL = "lower(split_part(email, '@', 1))"
_NOM = f"(contains(email, '@') AND len(list_filter(string_split_regex({_LOCAL}, '[._-]+'), lambda t: length(t) >= 3 AND regexp_full_match(t, '[a-z]+') AND t NOT IN ({_GL}))) > 0 AND {_LOCAL} NOT IN ({_GL}))"


@query(f"""WITH s AS (SELECT *, count(*) OVER (PARTITION BY siret) AS ns FROM standardize)
SELECT row_id, round((CASE WHEN coalesce({_NOM}, false) THEN 35 WHEN {_h('email')} = 1 THEN 20 ELSE 0 END + 20 * {_h('telephone')} + CASE WHEN starts_with(siteweb, 'https') THEN 10 ELSE 0 END) / 65.0 * 55 + ({_h('denomination')} + {_h('adresse')} + {_h('naf')}) * 10 / 30.0 * 20
+ (CASE WHEN trim(siret) <> '' AND ns = 1 THEN 1 ELSE 0 END) * 5 + CASE WHEN coalesce(date_diff('day', try_cast(date_creation AS DATE), DATE '2024-06-30') BETWEEN 0 AND 365, false) THEN 10 ELSE 0 END, 4)::DOUBLE AS score FROM s""")
def enrich_scores(spark, base):
    df = table(spark, base, "standardize")
    one = df.groupBy("siret").agg(F.count("*").alias("n")).filter("trim(siret) <> '' and n = 1").select("siret", F.lit(1).alias("u"))
    has = lambda c: F.coalesce(F.trim(T.blank_to_null(F.col(c))) != "", F.lit(False))
    filled = has("denomination").cast("int") + has("adresse").cast("int") + has("naf").cast("int")
    s = S.enrich(C.email_kind(F.col("email")) == "nominative", has("email"), has("telephone"), F.col("siteweb").startswith("https"), filled, F.coalesce("u", F.lit(0)), N.recent(F.col("date_creation"), F.lit("2024-06-30").cast("date"), 365))
    return df.join(one, "siret", "left").select("row_id", F.round(s, 4).alias("score"))


@query(f"SELECT row_id, email FROM standardize WHERE {_EOK} ORDER BY email NULLS LAST, row_id DESC LIMIT 300")
def sorted_rows(spark, base):
    df = table(spark, base, "standardize")
    found = R.require(df, {"mail": ["EMAIL", "mail"], "id": ["row_id"]})
    ok = df.filter(C.email_check(F.col(found["mail"]))["is_valid"])
    return R.sort_by(ok, [R.resolve(ok, "E-mail"), found["id"]], [True, False]).select("row_id", "email").limit(300)


_TK = f"list_filter(string_split({_norm('denomination')}, ' '), lambda x: x <> '' AND x NOT IN ({_LF}))"
_LT = f"nullif(regexp_replace({_norm('denomination')}, '[^a-z]', '', 'g'), '')"


@query(f"""WITH t AS (SELECT context_id, {_TK} AS t, {_LT} AS letters FROM scrape_context WHERE denomination IS NOT NULL)
SELECT context_id, letters, letters[1:1] AS initial, CASE WHEN len(t) > 1 THEN upper(array_to_string(list_transform(t, lambda w: w[1:1]), '')) END AS acronym, list_filter(t, lambda w: length(w) = list_max(list_transform(t, lambda x: length(x))))[1] AS core,
CASE WHEN len(t) > 0 THEN round(greatest(0.3, 1.05 - 0.15 * len(t)), 2)::DOUBLE END AS confidence FROM t""")
def name_forms(spark, base):
    f = T.name_forms(F.col("denomination"))
    return table(spark, base, "scrape_context").filter("denomination is not null").select("context_id", *[f[c].alias(c) for c in ("letters", "initial", "acronym", "core", "confidence")])


_ADR = "upper(strip_accents(replace(replace(trim(regexp_replace(adresse, '\\s+', ' ', 'g')), 'œ', 'oe'), 'Œ', 'OE')))"
for _short, _full in T.WAYS.items():
    _ADR = f"regexp_replace({_ADR}, '\\b{_short}\\b\\.?', '{_full}', 'g')"


@query(f"SELECT row_id, {_ADR} AS address FROM standardize WHERE adresse IS NOT NULL")
def clean_addresses(spark, base):
    return table(spark, base, "standardize").filter("adresse is not null").select("row_id", T.clean_address(F.col("adresse")).alias("address"))


@query("SELECT event_id, user_id, round(value, 4) AS value FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 10")
def latest_alerts(spark, base):
    return table(spark, base, "events").filter("event_type = 'error'").orderBy(F.desc("ts"), F.desc("event_id")).limit(10).select("event_id", "user_id", F.round("value", 4).alias("value"))


@query(f"SELECT row_id, coalesce({_b('enseigne')}, denomination) AS enseigne FROM standardize")
def filled_blanks(spark, base):
    return R.fill_blanks(table(spark, base, "standardize"), {"enseigne": "denomination"}).select("row_id", "enseigne")


@query("""SELECT page_id, array_to_string(list_distinct([url, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || '/contact', regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || '/mentions-legales']).list_sort(), '|') AS urls FROM page_result WHERE url IS NOT NULL""")
def pages_to_try(spark, base):
    none = F.lit(None).cast("array<string>")
    return table(spark, base, "page_result").filter("url is not null").select("page_id", F.array_join(F.array_sort(W.pages_to_try(F.col("url"), none, ["contact", "mentions-legales"], 20)), "|").alias("urls"))


@query()
def address_success(spark, base):
    from ..ml import address_classes

    return address_classes(table(spark, base, "apify_agents"))


@query()
def hashed_embeddings(spark, base):
    from ..ml import hashed_embedding

    v = hashed_embedding(table(spark, base, "maps_scraper").select("maps_id", "maps_name"), "maps_name")
    return v.select("maps_id", F.size("embedding").alias("size"), F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)), 6).alias("norm"))
