"""Queries of composite scores, text and number functions, statistics and event reports, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import contact as C
from ..functions import numbers as N
from ..functions import scores as S
from ..functions import text as T
from ..operators import quality as Q
from ..operators import relational as R
from ..session import table
from ..streaming import events as E
from .catalogue import _EOK, _FRESH, _GL, _LF, _PN, AS_OF, _b, _dig, _h, _host, _norm
from .catalogue import SQL as BASE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _reg(c: str) -> str:
    h = _host(c)
    two = ",".join(f"'{x}'" for x in C.TWO_LABELS)
    return f"(CASE WHEN {h} IS NULL THEN NULL WHEN array_to_string(string_split({h}, '.')[-2:], '.') IN ({two}) THEN array_to_string(string_split({h}, '.')[-3:], '.') ELSE array_to_string(string_split({h}, '.')[-2:], '.') END)"


# ---------------------------------------------------------------- scores
_UNI = """WITH s AS (SELECT row_id, nullif(trim(siren),'') a, nullif(trim(siteweb),'') b, nullif(trim(email),'') c, nullif(trim(telephone),'') d FROM standardize),
x AS (SELECT row_id, count(a) OVER (PARTITION BY a) na, count(b) OVER (PARTITION BY b) nb, count(c) OVER (PARTITION BY c) nc, count(d) OVER (PARTITION BY d) nd FROM s),
u AS (SELECT row_id, 1.0 - 0.25 * ((na > 1)::INT + (nb > 1)::INT + (nc > 1)::INT + (nd > 1)::INT) AS unicity FROM x)"""
_FIELDS = ("siren", "denomination", "naf", "adresse", "code_postal", "commune", "effectif", "date_creation")


def _unicity(spark: SparkSession, base: str) -> DataFrame:
    keys = ("siren", "siteweb", "email", "telephone")
    df = table(spark, base, "standardize").select("row_id", *[F.nullif(F.trim(c), F.lit("")).alias(c) for c in keys])
    out = df.select("row_id", *keys)
    for c in keys:
        many = df.groupBy(c).agg(F.count("*").alias("_n")).filter(f"{c} is not null and _n > 1").select(c, F.lit(1).alias(f"{c}_d"))
        out = out.join(many, c, "left")
    lost = sum((F.coalesce(F.col(f"{c}_d"), F.lit(0)) for c in keys), F.lit(0))
    return out.select("row_id", (1.0 - 0.25 * lost).alias("unicity"))


@query(_UNI + " SELECT row_id, unicity::DOUBLE AS unicity FROM u")
def unicity_score(spark, base):
    return _unicity(spark, base)


_COMP = "(" + " + ".join(_h(c) for c in _FIELDS) + ") / 8.0"


@query(f"SELECT row_id, round({_COMP}, 6)::DOUBLE AS completeness FROM standardize")
def completeness_score(spark, base):
    return table(spark, base, "standardize").select("row_id", F.round(S.completeness(*[F.col(c) for c in _FIELDS]), 6).alias("completeness"))


_CONTACT = BASE["contactability_score"].split("round(", 1)[1].split(", 4)::DOUBLE", 1)[0]


@query(f"{_UNI} SELECT s.row_id, round(({_CONTACT}) * 0.5 + ({_COMP}) * 0.2 + u.unicity * 0.2 + ({_FRESH.split('round(', 1)[1].rsplit(', 6)', 1)[0]}) * 0.1, 5)::DOUBLE AS score FROM standardize s JOIN u USING (row_id)")
def quality_score(spark, base):
    c = F.col
    s = S.quality(
        S.contactability(c("email"), c("telephone"), c("siteweb"), c("adresse"), c("siteweb"), c("email"), c("telephone"), F.lit(None).cast("string")),
        S.completeness(*[c(f) for f in _FIELDS]), c("unicity"), S.freshness(F.try_to_timestamp("date_creation", F.lit("yyyy-MM-dd")).cast("date"), F.lit(AS_OF).cast("date")),
    )
    return table(spark, base, "standardize").join(_unicity(spark, base), "row_id").select("row_id", F.round(s, 5).alias("score"))


_MID = "(SELECT avg(m) FROM (SELECT unnest(list_transform(range(len(regexp_extract_all(effectif, '([0-9]+)(?:\\s*[–-]\\s*([0-9]+))?', 1))), lambda i: (try_cast(regexp_extract_all(effectif, '([0-9]+)(?:\\s*[–-]\\s*([0-9]+))?', 1)[i+1] AS DOUBLE) + coalesce(try_cast(nullif(regexp_extract_all(effectif, '([0-9]+)(?:\\s*[–-]\\s*([0-9]+))?', 2)[i+1], '') AS DOUBLE), try_cast(regexp_extract_all(effectif, '([0-9]+)(?:\\s*[–-]\\s*([0-9]+))?', 1)[i+1] AS DOUBLE))) / 2)) AS m))"
_BIG = "list_max(list_transform(regexp_extract_all(effectif, '([0-9]+)', 1), lambda x: x::BIGINT))"


@query(f"SELECT row_id, {_MID} AS employees, CASE WHEN {_BIG} <= 10 THEN '1-10' WHEN {_BIG} <= 50 THEN '11-50' WHEN {_BIG} <= 200 THEN '51-200' WHEN {_BIG} <= 500 THEN '201-500' WHEN {_BIG} IS NOT NULL THEN '500+' END AS bucket FROM standardize")
def employees_revenue(spark, base):
    return table(spark, base, "standardize").select("row_id", N.employees(F.col("effectif")).alias("employees"), N.size_bucket(F.col("effectif")).alias("bucket"))


_NAFU = f"upper(trim({_b('nullif(upper(regexp_replace(naf, $$[ .]$$, $$$$, $$g$$)), $$$$)')}))"
_REC = BASE["recency_steps"]


@query(f"""WITH r AS ({_REC}), t AS (SELECT s.*, r.recency, {_MID} AS e, nullif(upper(regexp_replace(naf, '[\\s.]', '', 'g')), '') AS n FROM standardize s JOIN r USING (row_id))
SELECT row_id, round(((0.35::DOUBLE * {_h('email')} + 0.25::DOUBLE * {_h('telephone')} + 0.20::DOUBLE * {_h('siteweb')} + 0.10::DOUBLE * {_h('adresse')}) * 0.4::DOUBLE
+ (CASE WHEN e >= 250 THEN 1.0::DOUBLE WHEN e >= 100 THEN 0.85::DOUBLE WHEN e >= 50 THEN 0.7::DOUBLE WHEN e >= 20 THEN 0.55::DOUBLE WHEN e >= 10 THEN 0.45::DOUBLE WHEN e >= 3 THEN 0.3::DOUBLE WHEN e > 0 THEN 0.15::DOUBLE ELSE 0 END) * 0.25::DOUBLE
+ (CASE WHEN regexp_full_match(n, '[0-9]{{4}}[A-Z]') THEN 1.0::DOUBLE WHEN regexp_full_match(n, '[0-9]{{3}}[A-Z]?') THEN 0.75::DOUBLE WHEN regexp_full_match(n, '[0-9]{{2}}') THEN 0.55::DOUBLE WHEN length(n) >= 3 THEN 0.35::DOUBLE WHEN length(trim(forme_juridique)) >= 10 THEN 0.3::DOUBLE ELSE 0 END) * 0.15::DOUBLE + recency * 0.2::DOUBLE) * 100, 2)::DOUBLE AS score FROM t""")
def lead_score(spark, base):
    c, none = F.col, F.lit(None).cast("string")
    s = S.lead(c("email"), c("telephone"), c("siteweb"), c("adresse"), none, c("effectif"), none, C.naf_clean(c("naf")), c("forme_juridique"), c("date_creation"), F.lit(AS_OF).cast("date"))
    return table(spark, base, "standardize").select("row_id", s.alias("score"))


_LOC = "lower(split_part(lower(best_email),'@',1))"
_OWN, _WANT = _reg("split_part(lower(best_email),'@',-1)"), _reg("domain")
_FREE = ",".join(f"'{x}'" for x in C.FREE_MAIL)


@query(f"""WITH t AS (SELECT contact_id, best_email, {_LOC} AS l, {_OWN} AS own, {_WANT} AS want FROM clean_contacts)
SELECT contact_id, CASE WHEN contains(best_email,'@') THEN round(greatest(0.0, least(1.0, 0.2 + (CASE WHEN want IS NULL THEN 0.1 WHEN own = want THEN 0.45 WHEN ends_with(own, '.' || want) THEN 0.35 WHEN array_to_string(string_split(own,'.')[-2:],'.') = array_to_string(string_split(want,'.')[-2:],'.') THEN 0.25 ELSE 0.1 END)
+ (CASE WHEN own IN ({_FREE}) THEN -0.3 ELSE 0 END) + (CASE WHEN len(list_filter(string_split_regex(l, '[._-]+'), lambda t: length(t) >= 3 AND regexp_full_match(t, '[a-z]+') AND t NOT IN ({_GL}))) > 0 THEN 0.25 WHEN l <> '' AND l NOT IN ({_GL}) THEN 0.05 ELSE 0 END)
+ (CASE WHEN length({_dig('l')})::DOUBLE / nullif(length(l), 0) >= 0.4 THEN -0.1 ELSE 0 END))), 3)::DOUBLE ELSE 0.0 END AS score FROM t""")
def email_scores(spark, base):
    return table(spark, base, "clean_contacts").select("contact_id", S.email_score(F.lower("best_email"), F.col("domain")).alias("score"))


_PH1 = "string_split_regex(phones, '[;,|/\\n]')[1]"
_COD = f"(CASE WHEN regexp_matches({_PH1}, '^\\s*(\\+33|0033|0[1-9])') THEN 'FR' WHEN regexp_matches({_PH1}, '^\\s*\\+44') THEN 'GB' WHEN regexp_matches({_PH1}, '^\\s*\\+32') THEN 'BE' WHEN regexp_matches({_PH1}, '^\\s*\\+49') THEN 'DE' WHEN regexp_matches({_PH1}, '^\\s*\\+') THEN 'ZZ' END)"
_OWNC, _WANTC = _reg("split_part(lower(best_email),'@',-1)"), _reg("top_url")


@query(f"""WITH t AS (SELECT contact_id, contains(best_email,'@') AS has, {_LOC} AS l, {_OWNC} AS own, {_WANTC} AS want, {_PH1} AS p, {_COD} AS code FROM clean_contacts),
f AS (SELECT contact_id, list_filter([CASE WHEN has AND own IS NOT NULL AND want IS NOT NULL AND (own = want OR ends_with(own, '.' || want)) THEN 'email_domain_match' WHEN has AND own IS NOT NULL AND want IS NOT NULL THEN 'email_domain_mismatch' END,
CASE WHEN has AND own IN ({_FREE}) THEN 'generic_email_domain' WHEN has AND len(list_filter(string_split_regex(l, '[._]'), lambda x: x IN ({_GL}))) > 0 THEN 'generic_email_localpart' END,
CASE WHEN trim(p) <> '' AND code IS NULL THEN 'phone_unparseable' WHEN trim(p) <> '' AND code = 'FR' THEN 'phone_country_match' WHEN trim(p) <> '' THEN 'phone_country_mismatch' END], lambda x: x IS NOT NULL) AS flags FROM t)
SELECT contact_id, array_to_string(flags, ',') AS flags, greatest(0, least(100, 50 + coalesce(list_sum(list_transform(flags, lambda x: CASE x WHEN 'email_domain_match' THEN 30 WHEN 'email_domain_mismatch' THEN -20 WHEN 'phone_unparseable' THEN -15 WHEN 'phone_country_match' THEN 20 WHEN 'phone_country_mismatch' THEN -20 ELSE -10 END)), 0)))::INT AS score FROM f""")
def coherence_rules(spark, base):
    r = S.coherence(F.col("best_email"), F.col("top_url"), F.split("phones", "[;,|/\n]")[0], F.lit(None).cast("string"), F.lit("FR"))
    return table(spark, base, "clean_contacts").select("contact_id", r["score"].alias("score"), F.array_join(r["flags"], ",").alias("flags"))


@query(f"""WITH f AS ({SQL['coherence_rules']}), x AS (SELECT unnest(string_split(flags, ',')) AS flag FROM f)
SELECT flag, count(*) AS n FROM x WHERE flag IN ('email_domain_mismatch','phone_unparseable','phone_country_mismatch','generic_email_domain','generic_email_localpart') GROUP BY 1""")
def flag_counts(spark, base):
    rows = coherence_rules(spark, base).select(F.split("flags", ",").alias("flags"))
    return Q.flag_counts(rows, "flags", ["email_domain_mismatch", "phone_unparseable", "phone_country_mismatch", "generic_email_domain", "generic_email_localpart"])


@query(f"SELECT contact_id, score FROM ({SQL['coherence_rules']}) WHERE score < 50 ORDER BY score, contact_id LIMIT 20")
def least_coherent(spark, base):
    return coherence_rules(spark, base).filter("score < 50").select("contact_id", "score").orderBy("score", "contact_id").limit(20)


# ---------------------------------------------------------------- text
_TOK = f"list_filter(string_split({_norm('denomination')}, ' '), lambda x: x <> '' AND x NOT IN ({_LF}))"
_VAR = f"list_filter([array_to_string({_TOK}, ''), array_to_string({_TOK}[1:2], ''), {_TOK}[1], array_to_string({_TOK}[-2:], '')], lambda x: x IS NOT NULL AND x <> '')"


@query(f"SELECT DISTINCT context_id, v || '.' || t AS candidate FROM (SELECT context_id, unnest({_VAR}) AS v FROM scrape_context WHERE denomination IS NOT NULL), (VALUES ('fr'),('com'),('eu')) AS z(t)")
def domain_candidates(spark, base):
    return table(spark, base, "scrape_context").select("context_id", F.explode(T.domain_candidates(F.col("denomination"), ["fr", "com", "eu"])).alias("candidate"))


_FN, _LN, _DM = f"string_split({_norm('denomination')}, ' ')[1]", f"string_split({_norm('denomination')}, ' ')[-1]", _host("domain")


@query(f"""WITH t AS (SELECT contact_id, {_FN} AS f, {_LN} AS n, {_DM} AS d FROM clean_contacts WHERE contains({_norm('denomination')}, ' ') AND {_DM} IS NOT NULL)
SELECT DISTINCT contact_id, p || '@' || d AS email FROM (SELECT contact_id, d, unnest([f||'.'||n, f||n, f[1:1]||n, f[1:1]||'.'||n, n||'.'||f, f||'-'||n, f||'_'||n, f, n, f||'.'||n[1:1], f||n[1:1], f[1:1]||'-'||n, f[1:1]||'_'||n, n||f, n||'-'||f, n||'_'||f, n||f[1:1], n||'.'||f[1:1], n||'-'||f[1:1], n||'_'||f[1:1], f[1:1]||n[1:1]]) AS p FROM t) WHERE p IS NOT NULL""")
def email_patterns(spark, base):
    w = F.split(T.normalize_text(F.col("denomination")), " ")
    df = table(spark, base, "clean_contacts").select("contact_id", F.element_at(w, 1).alias("f"), F.element_at(w, -1).alias("n"), C.host(F.col("domain")).alias("d"), F.size(w).alias("k"))
    return df.filter("k > 1 and d is not null").select("contact_id", F.explode(C.email_patterns(F.col("f"), F.col("n"), F.col("d"))).alias("email"))


@query("SELECT agent_row_id, coalesce((SELECT string_agg(v, ', ' ORDER BY i) FROM (SELECT i, v, row_number() OVER (ORDER BY i) AS rn FROM (SELECT min(i) AS i, arg_min(v, i) AS v FROM (SELECT generate_subscripts(string_split_regex(a.apify_categories, '[;,]'), 1) AS i, trim(unnest(string_split_regex(a.apify_categories, '[;,]'))) AS v) WHERE v <> '' GROUP BY lower(v))) WHERE rn <= 8), '') AS categories FROM apify_agents a WHERE apify_categories IS NOT NULL")
def distinct_join(spark, base):
    return table(spark, base, "apify_agents").filter("apify_categories is not null").select("agent_row_id", T.distinct_join(F.col("apify_categories")).alias("categories"))


@query("SELECT page_id, (SELECT string_agg(x, ';' ORDER BY x) FROM (SELECT DISTINCT lower(trim(unnest(emails))) AS x) WHERE x <> '') AS emails FROM page_result WHERE emails IS NOT NULL AND len(emails) > 0")
def mailto_links(spark, base):
    """The e-mails of a page written as links and read back."""
    html = F.array_join(F.transform("emails", lambda e: F.concat(F.lit('<a href="mailto: '), e, F.lit(' ?subject=x">x</a>'))), "")
    df = table(spark, base, "page_result").filter("size(emails) > 0")
    return df.select("page_id", F.nullif(F.array_join(F.array_sort(C.mailto_in(html)), ";"), F.lit("")).alias("emails"))


@query(f"SELECT context_id, array_to_string(list_transform(list_sort(list_transform(list_distinct({_TOK}), lambda x: printf('%05d', 99999 - length(x)) || x)), lambda x: x[6:])[1:3], ' ') AS terms FROM scrape_context WHERE denomination IS NOT NULL")
def search_terms(spark, base):
    return table(spark, base, "scrape_context").filter("denomination is not null").select("context_id", F.array_join(T.search_terms(F.col("denomination")), " ").alias("terms"))


@query("""SELECT row_id, sha1('{"denomination": ' || coalesce('"' || replace(replace(denomination,'\\','\\\\'),'"','\\"') || '"', 'null') || ', "siren": ' || coalesce('"' || siren || '"', 'null') || ', "siret": ' || coalesce('"' || siret || '"', 'null') || '}') AS record_id FROM standardize""")
def record_id_hash(spark, base):
    return table(spark, base, "standardize").select("row_id", T.json_id({"siren": F.col("siren"), "siret": F.col("siret"), "denomination": F.col("denomination")}).alias("record_id"))


# ---------------------------------------------------------------- statistics
@query(f"""SELECT bucket, count(k) AS n FROM (VALUES ('<20'),('<40'),('<60'),('<80'),('80+'),('100+')) AS b(bucket) LEFT JOIN (SELECT p_partkey AS k, CASE WHEN p_size < 20 THEN '<20' WHEN p_size < 40 THEN '<40' WHEN p_size < 60 THEN '<60' WHEN p_size < 80 THEN '<80' WHEN p_size < 100 THEN '80+' ELSE '100+' END AS bucket FROM part) USING (bucket) GROUP BY 1""")
def full_buckets(spark, base):
    return Q.full_buckets(table(spark, base, "part"), "p_size", [(20, "<20"), (40, "<40"), (60, "<60"), (80, "<80"), (100, "80+")], "100+")


@query("""WITH b AS (SELECT nullif(trim(siren),'') a, nullif(trim(siret),'') b, nullif(trim(email),'') c FROM (SELECT CASE WHEN lower(trim(siren))='nan' THEN NULL ELSE siren END siren, CASE WHEN lower(trim(siret))='nan' THEN NULL ELSE siret END siret, CASE WHEN lower(trim(email))='nan' OR upper(trim(email)) LIKE '%NON RENSEIGNE%' THEN NULL ELSE email END email FROM standardize)), c AS (
SELECT 'siren' combo, count(a) n, count(DISTINCT a) u FROM b UNION ALL SELECT 'siret', count(b), count(DISTINCT b) FROM b UNION ALL SELECT 'email', count(c), count(DISTINCT c) FROM b
UNION ALL SELECT 'siren+siret', count(*), count(DISTINCT a || '|' || b) FROM b WHERE a IS NOT NULL AND b IS NOT NULL UNION ALL SELECT 'siren+email', count(*), count(DISTINCT a || '|' || c) FROM b WHERE a IS NOT NULL AND c IS NOT NULL
UNION ALL SELECT 'siret+email', count(*), count(DISTINCT b || '|' || c) FROM b WHERE b IS NOT NULL AND c IS NOT NULL UNION ALL SELECT 'siren+siret+email', count(*), count(DISTINCT a || '|' || b || '|' || c) FROM b WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL)
SELECT combo, n AS applicable, u AS n_unique, n - u AS duplicates, round(CASE WHEN n > 0 THEN (n - u)::DOUBLE / n ELSE 0 END, 6) AS rate FROM c""")
def dup_powerset(spark, base):
    return R.duplicate_combinations(table(spark, base, "standardize"), ["siren", "siret", "email"])


@query(f"""WITH t AS (SELECT row_id, email, CASE WHEN {_b('email')} IS NULL THEN 'missing' WHEN NOT contains(lower(trim({_b('email')})), '@') THEN 'parse' WHEN {_EOK} THEN 'valid' ELSE 'format' END AS reason FROM standardize),
r AS (SELECT *, row_number() OVER (PARTITION BY reason, email IS NULL ORDER BY row_id) AS rn FROM t WHERE reason <> 'valid')
SELECT 'email' AS field, reason, count(*) AS n, (SELECT string_agg(email, '|' ORDER BY row_id) FROM r r2 WHERE r2.reason = r.reason AND rn <= 5 AND email IS NOT NULL) AS examples FROM r GROUP BY 2""")
def reason_examples(spark, base):
    out = Q.field_report(table(spark, base, "standardize"), "email", C.email_check(F.col("email")), F.col("email"), "row_id")
    return out.select("field", "reason", "n", F.nullif(F.array_join("examples", "|"), F.lit("")).alias("examples"))


@query("SELECT naf, count(*) AS n FROM standardize WHERE regexp_matches(trim(naf), '^[0-9]') GROUP BY 1 HAVING count(*) > 1")
def reference_codes(spark, base):
    """Rows of a reference list: those that begin with a digit."""
    return table(spark, base, "standardize").filter(F.trim("naf").rlike("^[0-9]")).groupBy("naf").agg(F.count("*").alias("n")).filter("n > 1")


@query("SELECT siren_n, count(*) AS companies FROM (SELECT siren, count(*) AS siren_n FROM clean_contacts WHERE siren IS NOT NULL GROUP BY 1) GROUP BY 1")
def records_per_company(spark, base):
    return table(spark, base, "clean_contacts").filter("siren is not null").groupBy("siren").agg(F.count("*").alias("siren_n")).groupBy("siren_n").agg(F.count("*").alias("companies"))


@query("SELECT domain, round(avg(confidence), 6) AS score, count(*) AS n FROM clean_contacts WHERE domain IS NOT NULL GROUP BY 1 ORDER BY score DESC, domain LIMIT 10")
def top_domains(spark, base):
    return table(spark, base, "clean_contacts").filter("domain is not null").groupBy("domain").agg(F.round(F.avg("confidence"), 6).alias("score"), F.count("*").alias("n")).orderBy(F.desc("score"), "domain").limit(10)


@query("SELECT email_type, arg_max(domain, confidence) IS NOT NULL AS has_best, round(max(confidence), 6) AS top, round(min(confidence), 6) AS low, count(*) AS n FROM clean_contacts WHERE domain IS NOT NULL GROUP BY 1")
def group_extremes(spark, base):
    return table(spark, base, "clean_contacts").filter("domain is not null").groupBy("email_type").agg(F.max_by("domain", "confidence").isNotNull().alias("has_best"), F.round(F.max("confidence"), 6).alias("top"), F.round(F.min("confidence"), 6).alias("low"), F.count("*").alias("n"))


@query("SELECT count(*) FILTER (WHERE status BETWEEN 200 AND 399) * 100.0 / count(*) AS ok_pct, count(*) FILTER (WHERE status BETWEEN 400 AND 499) * 100.0 / count(*) AS client_pct, count(*) FILTER (WHERE status BETWEEN 500 AND 599) * 100.0 / count(*) AS server_pct, round(avg(len(emails)), 6) AS mean_emails FROM page_extraction")
def scrape_summary(spark, base):
    s = F.col("status")
    share = lambda a, b: F.count_if(s.between(a, b)) * 100.0 / F.count("*")
    return table(spark, base, "page_extraction").agg(share(200, 399).alias("ok_pct"), share(400, 499).alias("client_pct"), share(500, 599).alias("server_pct"), F.round(F.avg(F.size("emails")), 6).alias("mean_emails"))


# ---------------------------------------------------------------- events
@query("""WITH m AS (SELECT event_id, user_id, ts, event_type = 'view' AS s FROM events WHERE event_type IN ('view','purchase')),
n AS (SELECT *, min(CASE WHEN s THEN ts END) OVER w AS nx, min(CASE WHEN NOT s THEN ts END) OVER w AS en FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT event_id, user_id, CASE WHEN nx IS NULL OR en <= nx THEN floor(epoch(en))::BIGINT - floor(epoch(ts))::BIGINT END AS seconds FROM n WHERE s""")
def paired_events(spark, base):
    return E.paired(table(spark, base, "events"), "user_id", "event_type = 'view'", "event_type = 'purchase'").select("event_id", "user_id", "seconds")


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 4) AS mean, round(max(value), 4) AS top FROM events WHERE ts > TIMESTAMP '2024-01-02 00:00:00' - INTERVAL 24 HOURS AND ts <= TIMESTAMP '2024-01-02 00:00:00' GROUP BY 1")
def recent_summary(spark, base):
    return E.trailing_summary(table(spark, base, "events"), "event_type", "2024-01-02 00:00:00", 24)


@query("SELECT count(*) AS n, round((floor(epoch(max(ts)))::BIGINT - floor(epoch(min(ts)))::BIGINT) / 3600.0, 4)::DOUBLE AS hours, round(count(*) * 3600.0 / (floor(epoch(max(ts)))::BIGINT - floor(epoch(min(ts)))::BIGINT), 4)::DOUBLE AS per_hour FROM events")
def event_rate(spark, base):
    return E.hourly_rate(table(spark, base, "events"))


@query()
def domain_predictor(spark, base):
    from ..ml import domain_predictor as fit

    return fit(table(spark, base, "clean_contacts"))


_GRAMS = "(" + " || ".join(f"flatten(list_transform(list_filter(string_split({{c}}, ' '), lambda w: w <> ''), lambda w: list_transform(range(greatest(length(w) + 2 - {n} + 1, 1)), lambda i: (' ' || w || ' ')[i+1:i+{n}])))" for n in (3, 4, 5)) + ")"


@query(f"""WITH p AS (SELECT maps_id AS id, {_norm('denomination')} AS a, {_norm('maps_name')} AS b FROM maps_scraper WHERE denomination IS NOT NULL AND maps_name IS NOT NULL),
l AS (SELECT id, 'a' AS side, unnest({_GRAMS.format(c='a')}) AS g FROM p UNION ALL SELECT id, 'b', unnest({_GRAMS.format(c='b')}) FROM p), t AS (SELECT id, side, g, count(*) AS n FROM l GROUP BY 1, 2, 3),
f AS (SELECT g, count(*) AS df FROM t GROUP BY 1), w AS (SELECT id, side, t.g, n * (ln((1.0 + 2 * (SELECT count(*) FROM p)) / (1.0 + df)) + 1) AS w FROM t JOIN f USING (g)), m AS (SELECT id, side, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1, 2),
d AS (SELECT x.id, sum(x.w * y.w) AS dot FROM w x JOIN w y ON x.id = y.id AND x.g = y.g AND x.side = 'a' AND y.side = 'b' GROUP BY 1)
SELECT p.id, round(round(coalesce(dot / (ma.norm * mb.norm), 0.0), 6), 4)::DOUBLE AS cosine FROM p LEFT JOIN d USING (id) LEFT JOIN m ma ON ma.id = p.id AND ma.side = 'a' LEFT JOIN m mb ON mb.id = p.id AND mb.side = 'b'""")
def text_similarity(spark, base):
    from ..ml import tfidf_cosine

    df = table(spark, base, "maps_scraper").filter("denomination is not null and maps_name is not null")
    return tfidf_cosine(df.select(F.col("maps_id").alias("id"), T.normalize_text(F.col("denomination")).alias("a"), T.normalize_text(F.col("maps_name")).alias("b"))).select("id", F.round("cosine", 4).alias("cosine"))
