"""Queries of the relational, text and event operators, each beside its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import contact as C
from ..functions import numbers as N
from ..functions import scores as S
from ..functions import text as T
from ..operators import quality as Q
from ..operators import relational as R
from ..session import table
from ..streaming import events as E

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
AS_OF = "2026-01-01"


def query(sql: str | None = None):
    """Register a query under its name, with its SQL twin if SQL can say it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


PH = "'TELEPHONE NON RENSEIGNE','ADRESSE NON RENSEIGNEE','DENOMINATION NON RENSEIGNEE','EMAIL NON RENSEIGNE','NON RENSEIGNE'"


def _b(c: str) -> str:
    """SQL of blank_to_null."""
    return f"(CASE WHEN trim({c}) = '' OR lower(trim({c})) = 'nan' OR upper(trim({c})) IN ({PH}) THEN NULL ELSE {c} END)"


def _norm(c: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(replace(replace({c},'œ','oe'),'Œ','OE'))), '[^a-z0-9]+', ' ', 'g'))"


def _host(c: str) -> str:
    return f"nullif(regexp_replace(regexp_extract(regexp_replace(lower(trim({c})), '^[a-z][a-z0-9+.-]*://', ''), '^([^/?#:]+)', 1), '^www\\.', ''), '')"


def _dig(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '', 'g')"


# ---------------------------------------------------------------- top-k, filters
@query("""SELECT c_custkey, c_name, round(coalesce(c_acctbal, 0.0), 2) AS score FROM customer
WHERE c_acctbal > 0 AND c_mktsegment IN ('BUILDING','MACHINERY') ORDER BY score DESC, c_custkey LIMIT 500""")
def topk_filter_score(spark, base):
    df = R.filter_expr(table(spark, base, "customer"), "c_acctbal > 0 and c_mktsegment in ('BUILDING','MACHINERY')")
    scored = R.default_fill(df.withColumn("score", F.round("c_acctbal", 2)), "score", 0.0)
    return R.top_k(R.reorder(scored, ["c_custkey", "c_name", "score"]).select("c_custkey", "c_name", "score"), [F.desc("score"), F.col("c_custkey")], 500)


@query(f"SELECT row_id, coalesce({_b('enseigne')}, {_b('denomination')}, {_b('commune')}) AS name FROM standardize")
def coalesce_synonyms(spark, base):
    df = table(spark, base, "standardize")
    return R.merge_synonyms(df, {"name": ["enseigne", "denomination", "raison_sociale", "commune"]}).select("row_id", "name")


@query(f"SELECT row_id, {_b('telephone')} AS telephone, {_b('adresse')} AS adresse, {_b('email')} AS email FROM standardize")
def placeholder_null(spark, base):
    return table(spark, base, "standardize").select("row_id", *[T.blank_to_null(F.col(c)).alias(c) for c in ("telephone", "adresse", "email")])


@query("""SELECT row_id, upper(regexp_replace(naf, '[\\s.]', '', 'g')) AS naf FROM standardize
WHERE upper(regexp_replace(naf, '[\\s.]', '', 'g')) LIKE '4332%' OR upper(regexp_replace(naf, '[\\s.]', '', 'g')) LIKE '0130Z%' OR upper(regexp_replace(naf, '[\\s.]', '', 'g')) LIKE '62%'""")
def naf_prefix_filter(spark, base):
    df = table(spark, base, "standardize")
    return df.filter(C.naf_matches(F.col("naf"), ["43.32B", "0130Z", "62"])).select("row_id", C.naf_clean(F.col("naf")).alias("naf"))


@query("SELECT etat_administratif AS state, count(*) AS n FROM standardize WHERE etat_administratif = 'A' GROUP BY 1")
def active_filter(spark, base):
    return table(spark, base, "standardize").filter("etat_administratif = 'A'").groupBy(F.col("etat_administratif").alias("state")).agg(F.count("*").alias("n"))


@query(f"SELECT row_id FROM standardize WHERE {_b('siret')} IS NOT NULL AND {_b('denomination')} IS NOT NULL AND {_b('naf')} IS NOT NULL AND {_b('siteweb')} IS NOT NULL AND ({_b('email')} IS NOT NULL OR {_b('telephone')} IS NOT NULL)")
def vendable_filter(spark, base):
    have = lambda c: T.blank_to_null(F.col(c)).isNotNull()
    df = table(spark, base, "standardize")
    return df.filter(have("siret") & have("denomination") & have("naf") & have("siteweb") & (have("email") | have("telephone"))).select("row_id")


# ---------------------------------------------------------------- joins
_CT = f"""WITH c AS (SELECT contact_id, best_email, CASE WHEN length({_dig('siren')}) >= 9 THEN substr({_dig('siren')},1,9) END AS k, {_host('domain')} AS d FROM clean_contacts WHERE best_email IS NOT NULL),
s1 AS (SELECT k, arg_min(best_email, contact_id) AS e FROM c WHERE k IS NOT NULL GROUP BY k),
s2 AS (SELECT d, arg_min(best_email, contact_id) AS e FROM c WHERE k IS NULL AND d IS NOT NULL GROUP BY d)"""


@query(f"""{_CT} SELECT b.row_id, coalesce(s1.e, s2.e) AS best_email FROM (SELECT row_id, siren, {_host('siteweb')} AS d FROM standardize) b
LEFT JOIN s1 ON b.siren = s1.k LEFT JOIN s2 ON b.d = s2.d""")
def left_join_fallback(spark, base):
    c = table(spark, base, "clean_contacts").filter("best_email is not null").select("contact_id", "best_email", C.siren_prefix(F.col("siren")).alias("siren"), C.host(F.col("domain")).alias("domain"))
    one = c.filter("siren is not null").groupBy("siren").agg(F.min_by("best_email", "contact_id").alias("best_email")).withColumn("domain", F.lit(None).cast("string"))
    two = c.filter("siren is null and domain is not null").groupBy("domain").agg(F.min_by("best_email", "contact_id").alias("best_email")).withColumn("siren", F.lit(None).cast("string"))
    base_df = table(spark, base, "standardize").select("row_id", "siren", C.host(F.col("siteweb")).alias("domain"))
    return R.left_join_fallback(base_df, one.unionByName(two), "siren", "domain", ["best_email"]).select("row_id", "best_email")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def pending_antijoin(spark, base):
    return table(spark, base, "customer").join(table(spark, base, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("""SELECT contact_id FROM clean_contacts WHERE sha256(lower(trim(best_email))) IN (SELECT sha256(lower(trim(email))) FROM standardize WHERE email IS NOT NULL)""")
def opted_out_semi(spark, base):
    out = table(spark, base, "standardize").filter("email is not null").select(F.sha2(F.lower(F.trim("email")), 256).alias("h"))
    return table(spark, base, "clean_contacts").withColumn("h", F.sha2(F.lower(F.trim("best_email")), 256)).join(out, "h", "left_semi").select("contact_id")


@query(f"""WITH t AS (SELECT agent_row_id, unnest(list_distinct(list_filter(string_split({_norm('company_name')}, ' ')[1:2], lambda x: length(x) > 3))) AS w FROM apify_agents WHERE company_name IS NOT NULL),
m AS (SELECT maps_id, unnest(list_distinct(string_split({_norm('maps_name')}, ' '))) AS w FROM maps_scraper WHERE maps_name IS NOT NULL)
SELECT agent_row_id, min(maps_id) AS maps_id FROM t JOIN m USING (w) GROUP BY agent_row_id""")
def token_containment(spark, base):
    a = table(spark, base, "apify_agents").select("agent_row_id", F.explode(F.array_distinct(F.filter(F.slice(F.split(T.normalize_text(F.col("company_name")), " "), 1, 2), lambda x: F.length(x) > 3))).alias("w"))
    # The first match of a word is enough for the first match of a row: aggregate before the join.
    m = table(spark, base, "maps_scraper").select("maps_id", F.explode(F.array_distinct(F.split(T.normalize_text(F.col("maps_name")), " "))).alias("w")).groupBy("w").agg(F.min("maps_id").alias("maps_id"))
    return a.join(m, "w").groupBy("agent_row_id").agg(F.min("maps_id").alias("maps_id"))


@query("SELECT r_name AS region, count(*) AS n_suppliers, round(sum(s_acctbal), 2) AS balance FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def dim_lookup(spark, base):
    # Nations and regions are fixed lists of 25 and 5 rows.
    n, r = F.broadcast(table(spark, base, "nation")), F.broadcast(table(spark, base, "region"))
    s = table(spark, base, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return s.groupBy(F.col("r_name").alias("region")).agg(F.count("*").alias("n_suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance"))


# ---------------------------------------------------------------- dedup
@query("""WITH f AS (SELECT *, coalesce(trim(siret),'') k1, coalesce(trim(code_postal),'') k2 FROM standardize)
SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY k1, k2 ORDER BY row_id) rn FROM f WHERE NOT (k1='' AND k2='')) WHERE rn = 1 UNION ALL SELECT row_id FROM f WHERE k1='' AND k2=''""")
def dedup_multikey(spark, base):
    return R.keep_first(table(spark, base, "standardize"), ["siret", "code_postal"], ["row_id"]).select("row_id")


@query(f"""WITH f AS (SELECT doc_id, siren AS v FROM documents) SELECT doc_id, coalesce(v IS NOT NULL AND count(*) OVER (PARTITION BY v) > 1, false) AS dup FROM f""")
def mark_dups(spark, base):
    return R.mark_duplicates(table(spark, base, "documents"), "siren", "dup").select("doc_id", "dup")


@query("SELECT siret, code_postal, count(*) AS n FROM standardize GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, siret, code_postal LIMIT 10")
def top_dup_keys(spark, base):
    g = table(spark, base, "standardize").groupBy("siret", "code_postal").agg(F.count("*").alias("n")).filter("n > 1")
    return g.orderBy(F.desc("n"), F.asc_nulls_last("siret"), F.asc_nulls_last("code_postal")).limit(10)


@query("SELECT context_id FROM (SELECT context_id, row_number() OVER (PARTITION BY coalesce(lower(trim(siren)),'') ORDER BY context_id) rn FROM scrape_context) WHERE rn = 1")
def dedup_identifier(spark, base):
    df = table(spark, base, "scrape_context").withColumn("k", F.coalesce(F.lower(F.trim("siren")), F.lit("")))
    return df.groupBy("k").agg(F.min("context_id").alias("context_id")).select("context_id")


# ---------------------------------------------------------------- scores
_U = """WITH s AS (SELECT row_id, nullif(trim(siren),'') a, nullif(trim(email),'') b FROM standardize),
x AS (SELECT row_id, count(a) OVER (PARTITION BY a) na, count(b) OVER (PARTITION BY b) nb FROM s)"""


def _h(c):
    return f"coalesce({_b(c)} IS NOT NULL, false)::INT"


_FRESH = f"round(least(1.0, greatest(0.8, coalesce(1 - greatest(0.0, least(0.5, date_diff('day', try_cast(date_creation AS DATE), DATE '{AS_OF}') / 1095.0)), 0.8))), 6)::DOUBLE"


@query(f"SELECT row_id, {_FRESH} AS freshness FROM standardize")
def freshness_score(spark, base):
    day = F.try_to_timestamp("date_creation", F.lit("yyyy-MM-dd")).cast("date")
    return table(spark, base, "standardize").select("row_id", F.round(S.freshness(day, F.lit(AS_OF).cast("date")), 6).alias("freshness"))


_PV = f"regexp_replace(regexp_replace(replace({_b('telephone')},'(0)',''), '[^0-9]', '', 'g'), '^(0033|33)', '0')"
_PN = f"(CASE WHEN length({_PV}) = 9 THEN '0' || {_PV} ELSE {_PV} END)"
_EV = f"lower(trim({_b('email')}))"
_EOK = f"(regexp_full_match({_EV}, '[a-z0-9._%+-]+@[a-z0-9-]+(\\.[a-z0-9-]+)*\\.[a-z]{{2,}}') AND NOT contains({_EV}, '..'))"


@query(f"""SELECT row_id, round(0.30 * coalesce({_b('email')} IS NOT NULL AND regexp_matches(email, '@.*\\.'), false)::INT + 0.20 * coalesce({_b('telephone')} IS NOT NULL, false)::INT
+ 0.15 * coalesce({_b('siteweb')} IS NOT NULL, false)::INT + 0.10 * coalesce(length(trim({_b('adresse')})) > 10, false)::INT + 0.10 * coalesce(contains({_host(_b('siteweb'))}, '.'), false)::INT
+ 0.05 * coalesce({_EOK}, false)::INT + 0.05 * coalesce(regexp_full_match({_PN}, '0[1-9][0-9]{{8}}'), false)::INT, 4)::DOUBLE AS score FROM standardize""")
def contactability_score(spark, base):
    c = F.col
    s = S.contactability(c("email"), c("telephone"), c("siteweb"), c("adresse"), c("siteweb"), c("email"), c("telephone"), F.lit(None).cast("string"))
    return table(spark, base, "standardize").select("row_id", F.round(s, 4).alias("score"))


# ---------------------------------------------------------------- statistics
@query(f"""WITH t AS (SELECT {_EV} e, {_EOK} eo, {_b('email')} eb, regexp_full_match({_PN}, '0[1-9][0-9]{{8}}') po, {_b('telephone')} pb FROM standardize),
u AS (SELECT 'email' field, count(eb) present, count(*) FILTER (WHERE eo) valid, count(*) n FROM t UNION ALL SELECT 'telephone', count(pb), count(*) FILTER (WHERE po), count(*) FROM t)
SELECT field, present, valid, present - valid AS invalid, n - present AS missing, round(CASE WHEN present > 0 THEN valid::DOUBLE / present * 100 ELSE 0 END, 2) AS valid_rate FROM u""")
def field_stats(spark, base):
    return Q.field_stats(table(spark, base, "standardize"), {"email": C.email_check(F.col("email")), "telephone": C.phone_check(F.col("telephone"))})


@query(f"""WITH t AS (SELECT CASE WHEN {_b('telephone')} IS NULL THEN 'missing' WHEN {_PV} = '' THEN 'parse' WHEN regexp_full_match({_PN}, '0[1-9][0-9]{{8}}') THEN 'valid' ELSE 'format' END AS reason FROM standardize)
SELECT reason, count(*) AS n FROM t GROUP BY 1""")
def reason_histogram(spark, base):
    return Q.reason_histogram(table(spark, base, "standardize"), C.phone_check(F.col("telephone")))


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, count({_b(c)}) AS filled, round(count({_b(c)})::DOUBLE / count(*) * 100, 2) AS pct FROM standardize" for c in ("siren", "enseigne", "adresse", "naf", "telephone", "email", "siteweb")) + ")")
def coverage_rates(spark, base):
    return Q.coverage(table(spark, base, "standardize"), ["siren", "enseigne", "adresse", "naf", "telephone", "email", "siteweb"])


@query("SELECT round(avg(l_extendedprice), 4) AS mean, round(quantile_cont(l_extendedprice::DOUBLE, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice::DOUBLE, 0.9), 4) AS p90 FROM lineitem")
def quality_percentiles(spark, base):
    return Q.percentiles(table(spark, base, "lineitem"), "l_extendedprice", {"p50": 0.5, "p90": 0.9})


@query("SELECT event_type, count(value) AS n, round(min(value), 3) AS min_ms, round(max(value), 3) AS max_ms, round(avg(value), 3) AS avg_ms, round(quantile_cont(value::DOUBLE, 0.5), 3) AS p50_ms, round(quantile_cont(value::DOUBLE, 0.9), 3) AS p90_ms, round(quantile_cont(value::DOUBLE, 0.99), 3) AS p99_ms FROM events GROUP BY 1")
def latency_summary(spark, base):
    return Q.latency_summary(table(spark, base, "events"), "event_type", "value")


@query("SELECT event_type, list_sort(list(value))[least(floor(count(value) * 90 / 100)::BIGINT, count(value) - 1) + 1] AS value FROM events WHERE value IS NOT NULL GROUP BY 1")
def index_percentile(spark, base):
    return Q.index_percentile(table(spark, base, "events"), "event_type", "value", 90)


@query("SELECT CASE WHEN p_size < 10 THEN '<10' WHEN p_size < 20 THEN '<20' WHEN p_size < 30 THEN '<30' WHEN p_size < 40 THEN '<40' ELSE '40+' END AS bucket, count(*) AS n FROM part GROUP BY 1")
def score_buckets(spark, base):
    b = Q.buckets(F.col("p_size"), [(10, "<10"), (20, "<20"), (30, "<30"), (40, "<40")], "40+")
    return table(spark, base, "part").groupBy(b.alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT least(9, greatest(0, floor(c_acctbal / 1000)))::INT AS bin, count(*) AS n FROM customer GROUP BY 1")
def histogram10(spark, base):
    return table(spark, base, "customer").groupBy(Q.histogram10(F.col("c_acctbal") / 100).alias("bin")).agg(F.count("*").alias("n"))


@query("SELECT event_type, user_id % 10 AS shard, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def labelled_counters(spark, base):
    return table(spark, base, "events").groupBy("event_type", (F.col("user_id") % 10).alias("shard")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT event_type, round(quantile_cont(value::DOUBLE, 0.9), 3) AS p90_ms FROM events GROUP BY 1 ORDER BY p90_ms DESC, event_type LIMIT 3")
def slowest_groups(spark, base):
    return Q.latency_summary(table(spark, base, "events"), "event_type", "value").select("event_type", "p90_ms").orderBy(F.desc("p90_ms"), "event_type").limit(3)


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier")
def union_by_name(spark, base):
    c = table(spark, base, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, base, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


@query("""WITH g AS (SELECT domain AS k, arg_min(url, extraction_id) AS url, arg_min(discovered_at, extraction_id) FILTER (WHERE discovered_at IS NOT NULL) AS discovered_at FROM page_extraction WHERE domain IS NOT NULL GROUP BY 1),
e AS (SELECT domain AS k, string_agg(x, ';' ORDER BY x) AS emails FROM (SELECT DISTINCT domain, unnest(emails) AS x FROM page_extraction) GROUP BY 1)
SELECT g.k AS domain, g.url, g.discovered_at, coalesce(e.emails, '') AS emails FROM g LEFT JOIN e USING (k)""")
def entity_union(spark, base):
    df = table(spark, base, "page_extraction").filter("domain is not null")
    u = R.entity_union(df, "domain", ["url", "discovered_at"], ["emails"], ["extraction_id"])
    return u.select("domain", "url", "discovered_at", F.array_join("emails", ";").alias("emails"))


@query("""WITH x AS (SELECT DISTINCT domain, lower(e) AS email, priority, status, url FROM (SELECT domain, unnest(emails) AS e, priority, status, url FROM page_extraction))
SELECT email, min(priority * 10 + CASE WHEN status >= 400 THEN 1 ELSE 0 END)::INT AS rank, count(DISTINCT domain) AS domains FROM x GROUP BY 1""")
def page_aggregate(spark, base):
    x = table(spark, base, "page_extraction").select("domain", F.explode("emails").alias("email"), "priority", "status").withColumn("email", F.lower("email"))
    return x.groupBy("email").agg(F.min((F.col("priority") * 10 + F.when(F.col("status") >= 400, 1).otherwise(0)).cast("int")).alias("rank"), F.count_distinct("domain").alias("domains"))


@query("SELECT p_brand, round(sum(p_retailprice * p_size) / sum(p_size), 6) AS weighted_mean FROM part GROUP BY 1")
def weighted_means(spark, base):
    return table(spark, base, "part").groupBy("p_brand").agg(F.round(F.sum(F.col("p_retailprice") * F.col("p_size")) / F.sum("p_size"), 6).alias("weighted_mean"))


@query("""WITH n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL), w AS (SELECT DISTINCT doc_id, unnest(list_distinct(string_split_regex(lower(text), '[^\\p{L}]+'))) AS word FROM documents WHERE text IS NOT NULL)
SELECT word, count(*) AS n FROM w WHERE length(word) > 2 GROUP BY 1 HAVING count(*) >= (SELECT greatest(1, 0.2 * n) FROM n)""")
def frequent_words(spark, base):
    return Q.frequent_words(table(spark, base, "documents"), "text", 0.2)


@query("""WITH k AS (SELECT count(*) AS total, round(count(*) FILTER (WHERE o_orderstatus = 'F')::DOUBLE / count(*) * 100, 4) AS done_pct, round(avg(o_totalprice), 2) AS mean_price FROM orders)
SELECT total, done_pct, mean_price, total >= 1000 AS total_met, done_pct >= 40.0 AS done_pct_met, mean_price >= 1000.0 AS mean_price_met, (total >= 1000 AND done_pct >= 40.0 AND mean_price >= 1000.0) AS all_met FROM k""")
def kpis_against_targets(spark, base):
    k = table(spark, base, "orders").agg(F.count("*").alias("total"), F.round(F.count_if(F.col("o_orderstatus") == "F") / F.count("*") * 100, 4).alias("done_pct"), F.round(F.avg("o_totalprice"), 2).alias("mean_price"))
    return Q.against_targets(k, {"total": 1000, "done_pct": 40.0, "mean_price": 1000.0})


# ---------------------------------------------------------------- text
@query(f"SELECT context_id, {_norm('denomination')} AS norm, replace({_norm('denomination')}, ' ', '-') AS slug FROM scrape_context")
def text_normalize(spark, base):
    c = F.col("denomination")
    return table(spark, base, "scrape_context").select("context_id", T.normalize_text(c).alias("norm"), T.slugify(c).alias("slug"))


_LF = ",".join(f"'{x}'" for x in T.LEGAL_FORMS)


@query(f"SELECT context_id, array_to_string(list_filter(string_split({_norm(chr(39).join(['replace(denomination,', '.', ',', ''])+chr(39)+')')}, ' '), lambda x: x <> '' AND x NOT IN ({_LF})), '-') AS slug FROM scrape_context")
def company_slugs(spark, base):
    return table(spark, base, "scrape_context").select("context_id", T.company_slug(F.col("denomination")).alias("slug"))


@query(f"SELECT row_id, nullif(concat_ws(', ', {_b('adresse')}, {_b('code_postal')}, {_b('commune')}), '') AS address FROM standardize")
def compose_address(spark, base):
    return table(spark, base, "standardize").select("row_id", T.compose_address(F.col("adresse"), F.col("code_postal"), F.col("commune")).alias("address"))


@query()
def pii_mask(spark, base):
    return table(spark, base, "page_result").select("page_id", T.pii_masker("salt")(F.col("text")).alias("text"))


_MAILRX = "[a-z0-9._%+-]+@[a-z0-9-]+(?:\\.[a-z0-9-]+)*\\.[a-z]{2,}"


@query(f"SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '({_MAILRX})', 1))), ';') AS emails FROM page_result WHERE text IS NOT NULL")
def email_extract(spark, base):
    return table(spark, base, "page_result").filter("text is not null").select("page_id", F.array_join(F.array_sort(C.emails_in(F.col("text"))), ";").alias("emails"))


@query("""SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '((?:\\+33 ?(?:\\(0\\) ?)?|0)[1-9](?:[ .-]?[0-9]{2}){4})', 1))), ';') AS phones FROM page_result WHERE text IS NOT NULL""")
def phone_extract(spark, base):
    return table(spark, base, "page_result").filter("text is not null").select("page_id", F.array_join(F.array_sort(C.phones_in(F.col("text"))), ";").alias("phones"))


@query("SELECT page_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, 'SIREN[ :]*([0-9]{3} ?[0-9]{3} ?[0-9]{3})', 1), lambda x: replace(x, ' ', '')))), ';') AS sirens FROM page_result WHERE text IS NOT NULL")
def siren_extract(spark, base):
    return table(spark, base, "page_result").filter("text is not null").select("page_id", F.array_join(F.array_sort(C.sirens_in(F.col("text"))), ";").alias("sirens"))


_GL = ",".join(f"'{x}'" for x in C.GENERIC_LOCALS)


@query(f"""SELECT contact_id, CASE WHEN NOT contains(best_email, '@') OR best_email IS NULL THEN NULL WHEN lower(split_part(best_email,'@',1)) IN ({_GL}) THEN 'generic'
WHEN len(list_filter(string_split_regex(lower(split_part(best_email,'@',1)), '[._-]+'), lambda t: length(t) >= 3 AND regexp_full_match(t, '[a-z]+') AND t NOT IN ({_GL}))) > 0 THEN 'nominative' ELSE 'generic' END AS kind FROM clean_contacts""")
def email_classify(spark, base):
    return table(spark, base, "clean_contacts").select("contact_id", C.email_kind(F.col("best_email")).alias("kind"))


@query(f"SELECT contact_id, {_EOK.replace('email', 'best_email')} IS TRUE AS is_valid FROM clean_contacts")
def email_validate(spark, base):
    return table(spark, base, "clean_contacts").select("contact_id", C.email_check(F.col("best_email"))["is_valid"].alias("is_valid"))


_D = _dig(_b("telephone"))


@query(f"SELECT row_id, nullif(CASE WHEN length({_D}) = 10 AND starts_with({_D}, '0') THEN '+33' || substr({_D}, 2, 9) WHEN length({_D}) = 9 THEN '+33' || {_D} ELSE {_D} END, '') AS phone FROM standardize")
def phone_norm(spark, base):
    return table(spark, base, "standardize").select("row_id", C.fr_phone(F.col("telephone")).alias("phone"))


_SD = _dig("siren")


@query(f"""SELECT contact_id, CASE WHEN length({_SD}) >= 9 THEN substr({_SD},1,9) END AS prefix, nullif(substr({_SD},1,9),'') AS any9, CASE WHEN length({_SD}) IN (9,14) THEN substr({_SD},1,9) END AS strict9 FROM clean_contacts""")
def siren_variants(spark, base):
    c = F.col("siren")
    return table(spark, base, "clean_contacts").select("contact_id", C.siren_prefix(c).alias("prefix"), C.siren_any(c).alias("any9"), C.siren_strict(c).alias("strict9"))


@query("SELECT CASE WHEN regexp_full_match(trim(code_postal), '[1-9][0-9]{3}') THEN '0' || substr(trim(code_postal),1,1) WHEN length(trim(code_postal)) >= 2 THEN substr(trim(code_postal),1,2) END AS department, count(*) AS n FROM standardize GROUP BY 1")
def department_counts(spark, base):
    return table(spark, base, "standardize").groupBy(C.department(F.col("code_postal")).alias("department")).agg(F.count("*").alias("n"))


@query(f"SELECT page_id, {_host('url')} AS host, CASE WHEN array_length(string_split({_host('url')}, '.')) >= 2 THEN array_to_string(string_split({_host('url')}, '.')[-2:], '.') ELSE {_host('url')} END AS registrable FROM page_result")
def url_host(spark, base):
    return table(spark, base, "page_result").select("page_id", C.host(F.col("url")).alias("host"), C.registrable(F.col("url")).alias("registrable"))


@query("""SELECT page_id, CASE WHEN trim(url) <> '' THEN coalesce(nullif(regexp_extract(lower(url), '^([a-z]+)://', 1), ''), 'https') || '://' || regexp_replace(lower(regexp_extract(regexp_replace(url, '^[A-Za-z]+://', ''), '^([^/?#]+)', 1)), ':(80|443)$', '')
|| regexp_replace(regexp_extract(regexp_replace(url, '^[A-Za-z]+://', ''), '^[^/?#]+([^?#]*)', 1), '/+$', '') END AS url FROM page_result""")
def url_canonical(spark, base):
    return table(spark, base, "page_result").select("page_id", C.canonical_url(F.col("url")).alias("url"))


@query("""WITH b AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS u FROM page_result), q AS (SELECT page_id, u, list_filter(string_split(regexp_extract(u, '\\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_')) AS l FROM b)
SELECT page_id, regexp_replace(u, '\\?.*$', '') || CASE WHEN len(l) > 0 THEN '?' || array_to_string(l, '&') ELSE '' END AS url FROM q""")
def strip_tracking(spark, base):
    return table(spark, base, "page_result").select("page_id", C.strip_tracking(F.col("url")).alias("url"))


@query("""SELECT CASE WHEN regexp_matches(lower(url), 'mentions|legal') THEN 0 WHEN contains(lower(url), 'contact') THEN 1 WHEN regexp_matches(lower(url), 'a-propos|about|equipe|qui-sommes') THEN 2 ELSE 5 END AS priority, count(*) AS n FROM page_result GROUP BY 1""")
def page_priority(spark, base):
    return table(spark, base, "page_result").groupBy(C.page_priority(F.col("url")).alias("priority")).agg(F.count("*").alias("n"))


@query("SELECT event_type, sum(try_cast(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_sum, count(json_extract_string(props, '$.k')) AS n FROM events GROUP BY 1")
def json_props(spark, base):
    k = F.get_json_object("props", "$.k")
    return table(spark, base, "events").groupBy("event_type").agg(F.sum(k.try_cast("bigint")).alias("k_sum"), F.count(k).alias("n"))


# ---------------------------------------------------------------- numbers
@query(f"""WITH t AS (SELECT row_id, greatest(0.0, date_diff('day', try_cast(date_creation AS DATE), DATE '{AS_OF}') / 365.25) AS y, try_cast(date_creation AS DATE) AS d FROM standardize)
SELECT row_id, (CASE WHEN d IS NULL THEN 0 WHEN y <= 2 THEN 1.0 WHEN y <= 5 THEN 0.85 WHEN y <= 10 THEN 0.65 WHEN y <= 15 THEN 0.45 WHEN y <= 20 THEN 0.25 ELSE 0.1 END)::DOUBLE AS recency FROM t""")
def recency_steps(spark, base):
    return table(spark, base, "standardize").select("row_id", N.recency(F.col("date_creation"), F.lit(AS_OF).cast("date")).alias("recency"))


@query("""WITH q AS (SELECT vec_id AS q_id, embedding AS q FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT q_id, vec_id, list_cosine_similarity(q::DOUBLE[], embedding::DOUBLE[]) AS c FROM q JOIN embeddings ON vec_id <> q_id)
SELECT q_id, vec_id, round(c, 6) AS cosine FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(c, 9) DESC, vec_id) rn FROM s) WHERE rn <= 5""")
def cosine_topk(spark, base):
    """The stated queries (ids divisible by 20) against all vectors, every two blocks in one task."""
    e = table(spark, base, "embeddings").select("vec_id", "embedding")
    return N.nearest(e.filter("vec_id % 20 = 0"), e, "vec_id", "embedding", 5)


@query()
def fuzzy_names(spark, base):
    df = table(spark, base, "maps_scraper").filter("denomination is not null and maps_name is not null")
    a, b = T.normalize_text(F.col("denomination")), T.normalize_text(F.col("maps_name"))
    return df.select("maps_id", N.fuzzy_ratio(a, b).alias("ratio"), N.fuzzy_token_set(a, b).alias("token_set"), N.fuzzy_token_sort(a, b).alias("token_sort"), N.fuzzy_partial(a, b).alias("partial"))


@query()
def sample_rows(spark, base):
    return R.seeded_sample(table(spark, base, "orders"), 100, "o_orderkey").select("o_orderkey")


# ---------------------------------------------------------------- events
@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 4) AS mean FROM events GROUP BY 1")
def hourly_tumbling(spark, base):
    h = E.hourly(table(spark, base, "events"))
    return h.select(F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), "n", F.round("total", 4).alias("total"), F.round("mean", 4).alias("mean"))


@query("SELECT event_id, user_id, count(*) OVER w AS n, round(sum(value) OVER w, 4) AS total FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)")
def trailing_24h(spark, base):
    return E.trailing(table(spark, base, "events"), "user_id", 86400)


@query("SELECT event_id, event_type, count(*) OVER w AS n, round(avg(value) OVER w, 8) AS mean FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def running_mean(spark, base):
    return E.running_mean(table(spark, base, "events"), "event_type")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS s FROM events),
k AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS begun, count(*) AS n FROM k GROUP BY user_id, id""")
def sessions(spark, base):
    return E.sessions(table(spark, base, "events"), "user_id").select("user_id", F.date_format("begun", "yyyy-MM-dd HH:mm:ss").alias("begun"), "n")


@query("""SELECT event_id, user_id, round(avg((value > 50)::INT) OVER w, 6) AS share, (avg((value > 50)::INT) OVER w >= 0.5 AND count(*) OVER w >= 2) AS opened FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOURS PRECEDING AND CURRENT ROW)""")
def breaker_ratio(spark, base):
    return E.breaker(table(spark, base, "events"), "user_id", "value > 50", 3600, 0.5, 2)


_STEPS = """r AS (SELECT key, min(x) AS x FROM e GROUP BY 1 UNION ALL SELECT e.key, min(e.x) FROM r JOIN e ON e.key = r.key AND e.x >= ((r.x // 1000000000) + 3600) * 1000000000 GROUP BY e.key, r.x)
SELECT x % 1000000000 AS event_id, key, x // 1000000000 AS ts FROM r"""


@query("WITH RECURSIVE e AS (SELECT event_type AS key, floor(epoch(ts))::BIGINT * 1000000000 + event_id AS x FROM events WHERE value > 50), " + _STEPS)
def alert_cooldown(spark, base):
    return E.alerts(table(spark, base, "events"), "event_type", "value > 50", 3600)


# ---------------------------------------------------------------- reports
@query("""WITH d AS (SELECT *, row_number() OVER (PARTITION BY siret ORDER BY row_id) rn FROM standardize WHERE nullif(trim(siret), '') IS NOT NULL)
SELECT row_id, siret, denomination, code_postal FROM d WHERE rn = 1""")
def premium_projection(spark, base):
    df = table(spark, base, "standardize").filter("nullif(trim(siret), '') is not null")
    first = df.groupBy("siret").agg(F.min("row_id").alias("row_id"))
    return df.join(first, ["siret", "row_id"], "left_semi").select("row_id", "siret", "denomination", "code_postal")


@query(f"""SELECT count(*) AS total, count(*) FILTER (WHERE {_EOK} OR regexp_full_match({_PN}, '0[1-9][0-9]{{8}}')) AS contactable, round(count(*) FILTER (WHERE {_EOK})::DOUBLE / count(*) * 100, 2) AS valid_email_rate FROM standardize""")
def marketing_kpis(spark, base):
    e, p = C.email_check(F.col("email"))["is_valid"], C.phone_check(F.col("telephone"))["is_valid"]
    return table(spark, base, "standardize").agg(F.count("*").alias("total"), F.count_if(e | p).alias("contactable"), F.round(F.count_if(e) / F.count("*") * 100, 2).alias("valid_email_rate"))


@query("""SELECT naf, n FROM (SELECT upper(regexp_replace(naf, '[\\s.]', '', 'g')) AS naf, count(*) AS n FROM standardize WHERE naf IS NOT NULL AND trim(naf) <> '' GROUP BY 1) ORDER BY n DESC, naf LIMIT 5""")
def top_naf(spark, base):
    df = table(spark, base, "standardize").withColumn("naf", C.naf_clean(F.col("naf"))).filter("naf is not null")
    return df.groupBy("naf").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "naf").limit(5)
