"""Queries of projections, lookups, contact aggregation, web functions and candidate scores, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import contact as C
from ..functions import dimensions as D
from ..functions import matching as M
from ..functions import scores as S
from ..functions import text as T
from ..functions import web as W
from ..operators import contacts as K
from ..operators import exports as X
from ..operators import lookups as L
from ..session import table
from .catalogue import _EOK, _PN, _b, _dig, _host, _norm

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(c: str) -> str:
    """SQL of a filled, trimmed text."""
    return f"trim({_b(c)})"


# ---------------------------------------------------------------- dimensions
_DEPT = "(VALUES " + ",".join("('" + "','".join(x.replace("'", "''") for x in line.split("; ")) + "')" for line in D.DEPARTMENTS.strip().splitlines()) + ") AS d(code, region, department)"
_CODE = "CASE WHEN starts_with(trim(code_postal),'97') AND length(trim(code_postal)) >= 3 THEN substr(trim(code_postal),1,3) ELSE substr(trim(code_postal),1,2) END"


@query(f"SELECT d.region, count(*) AS n FROM (SELECT {_CODE} AS code FROM standardize WHERE trim(code_postal) <> '') s JOIN {_DEPT} USING (code) GROUP BY 1")
def region_counts(spark, base):
    code = F.when(F.trim("code_postal").startswith("97") & (F.length(F.trim("code_postal")) >= 3), F.substring(F.trim("code_postal"), 1, 3)).otherwise(F.substring(F.trim("code_postal"), 1, 2))
    s = table(spark, base, "standardize").filter("trim(code_postal) <> ''").select(code.alias("code"))
    return s.join(F.broadcast(D.departments(spark)), "code").groupBy("region").agg(F.count("*").alias("n"))  # a fixed list of 109 rows


_IND = "CASE substr(regexp_replace(naf,'[\\s.]','','g'),1,2) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in (x.split(" ", 1) for x in D.INDUSTRIES.strip().splitlines())) + " END"
_SEC = "CASE upper(regexp_replace(naf,'[\\s.]','','g')) " + " ".join(f"WHEN '{c}' THEN '{n}'" for n, *cs in (x.split() for x in D.SECTORS.strip().splitlines()) for c in cs) + " END"


@query(f"SELECT row_id, {_IND} AS industry, {_SEC} AS sector FROM standardize")
def industry_lookup(spark, base):
    return table(spark, base, "standardize").select("row_id", D.industry(F.col("naf")).alias("industry"), D.sector(F.col("naf")).alias("sector"))


_STAFF = "CASE trim(effectif) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in (x.split() for x in D.STAFF_CODES.replace("\n", " ").split(",") if x.strip())) + " END"


@query(f"SELECT row_id, {_STAFF} AS staff_class FROM standardize")
def staff_classes(spark, base):
    return table(spark, base, "standardize").select("row_id", D.staff_class(F.col("effectif")).alias("staff_class"))


_SAN = f"regexp_replace(regexp_replace({_dig('telephone')}, '^0033', ''), '^33', '')"
_NUM = f"(CASE WHEN starts_with({_SAN}, '0') THEN {_SAN} ELSE '0' || {_SAN} END)"
_AREA = "(VALUES " + ",".join(f"('{c}','{a}')" for a, *cs in (x.split() for x in D.AREAS.strip().splitlines()) for c in cs) + "," + ",".join(f"('{c}','{a}')" for c, *as_ in (x.split() for x in D.OVERSEAS.split(", ")) for a in as_) + ") AS a(k, area)"
_KEY = "(CASE WHEN regexp_matches(regexp_extract(code_postal, '([0-9]+)', 1), '^9[78]') THEN substr(regexp_extract(code_postal, '([0-9]+)', 1),1,3) ELSE substr(regexp_extract(code_postal, '([0-9]+)', 1),1,2) END)"


@query(f"""WITH s AS (SELECT row_id, {_SAN} AS d, {_NUM} AS n, {_KEY} AS k FROM standardize), m AS (SELECT DISTINCT row_id FROM s JOIN {_AREA} USING (k) WHERE d <> '' AND starts_with(n, area))
SELECT s.row_id, m.row_id IS NOT NULL AS fits FROM s LEFT JOIN m USING (row_id)""")
def phone_area(spark, base):
    return table(spark, base, "standardize").select("row_id", D.area_fits(F.col("telephone"), F.col("code_postal")).alias("fits"))


_KIND = "(CASE WHEN regexp_matches(n, '^0[1-59]|^080|^081|^082|^089') THEN 0.5 ELSE 0.1 END)"


@query(f"""WITH s AS (SELECT row_id, {_dig('telephone')} AS raw, regexp_replace({_dig('telephone')}, '^(0033|33)', '0') AS d, {_SAN} AS d0, {_NUM} AS n0, {_KEY} AS k FROM standardize),
m AS (SELECT DISTINCT row_id FROM s JOIN {_AREA} USING (k) WHERE d0 <> '' AND starts_with(n0, area)), t AS (SELECT *, CASE WHEN starts_with(d,'0') THEN d ELSE '0' || d END AS n FROM s)
SELECT t.row_id, CASE WHEN raw <> '' THEN round(greatest(0.0, least(1.0, 0.25 + {_KIND} + CASE WHEN regexp_full_match(n, '0[1-9][0-9]{{8}}') THEN 0.05 WHEN length(n) < 9 THEN -0.1 ELSE 0 END + CASE WHEN m.row_id IS NOT NULL THEN 0.15 ELSE 0 END)), 3)::DOUBLE ELSE 0.0 END AS score
FROM t LEFT JOIN m USING (row_id)""")
def phone_scores(spark, base):
    return table(spark, base, "standardize").select("row_id", S.phone_score(F.col("telephone"), D.area_fits(F.col("telephone"), F.col("code_postal"))).alias("score"))


# ---------------------------------------------------------------- projections
_TITLE = lambda c: f"array_to_string(list_transform(string_split({c}, ' '), lambda x: upper(x[1:1]) || lower(x[2:])), ' ')"
_EMP = f"list_max(list_transform(regexp_extract_all({_t('effectif')}, '([0-9]+)', 1), lambda x: x::BIGINT))"
_FIRSTTOK = lambda c: f"nullif(trim(string_split_regex({_t(c)}, '[;,|\\s]+')[1]), '')"
_URL = lambda c: f"""(CASE WHEN trim({c}) <> '' THEN coalesce(nullif(regexp_extract(lower({c}), '^([a-z]+)://', 1), ''), 'https') || '://' || regexp_replace(lower(regexp_extract(regexp_replace({c}, '^[A-Za-z]+://', ''), '^([^/?#]+)', 1)), ':(80|443)$', '') || regexp_replace(regexp_extract(regexp_replace({c}, '^[A-Za-z]+://', ''), '^[^/?#]+([^?#]*)', 1), '/+$', '') END)"""


@query(f"""WITH d AS (SELECT *, row_number() OVER (PARTITION BY {_t('siret')} ORDER BY row_id) rn FROM standardize)
SELECT {_TITLE(f"coalesce({_t('enseigne')}, {_t('denomination')})")} AS company_name, {_host(_t('siteweb'))} AS domain, coalesce({_URL(_t('siteweb'))}, 'https://' || {_host(_t('siteweb'))}) AS site_web, {_t('siren')} AS siren, {_t('siret')} AS siret,
nullif(trim(regexp_replace(concat_ws(' ', {_t('code_postal')}, {_t('commune')}), '\\s+', ' ', 'g')), '') AS adresse_complete, {_t('code_postal')} AS code_postal, {_t('commune')} AS ville, NULL::VARCHAR AS departement, 'France' AS pays,
{_t('naf')} AS naf_code, {_t('naf')} AS naf, CASE WHEN {_EMP} <= 10 THEN '1-10' WHEN {_EMP} <= 50 THEN '11-50' WHEN {_EMP} <= 200 THEN '51-200' WHEN {_EMP} <= 1000 THEN '201-1000' WHEN {_EMP} IS NOT NULL THEN '1000+'
 WHEN regexp_matches(lower({_t('effectif')}), 'aut|n/a') THEN NULL WHEN contains(lower({_t('effectif')}), 'micro') THEN '1-10' WHEN contains(lower({_t('effectif')}), 'petite') THEN '11-50' WHEN contains(lower({_t('effectif')}), 'moyenne') THEN '51-200' WHEN contains(lower({_t('effectif')}), 'grande') THEN '201-1000' END AS employee_count,
NULL::VARCHAR AS revenue_range, {_t('date_creation')} AS date_creation, NULL::VARCHAR AS linkedin_company_url, NULL::VARCHAR AS tech_stack, {_FIRSTTOK('email')} AS email, {_FIRSTTOK('telephone')} AS telephone, {_t('etat_administratif')} AS etat_administratif, NULL::VARCHAR AS score_quality FROM d WHERE rn = 1""")
def premium_table(spark, base):
    return X.premium(table(spark, base, "standardize"), "row_id")


@query(f"""WITH p AS (SELECT * FROM ({SQL['premium_table']}))
SELECT round(count(*) FILTER (WHERE siret IS NOT NULL OR domain IS NOT NULL) * 100.0 / count(*), 2)::DOUBLE AS key_coverage_pct, round(count(company_name) * 100.0 / count(*), 2)::DOUBLE AS company_name_pct,
round(count(adresse_complete) * 100.0 / count(*), 2)::DOUBLE AS adresse_complete_pct, round(count(*) FILTER (WHERE email IS NOT NULL OR telephone IS NOT NULL) * 100.0 / count(*), 2)::DOUBLE AS contact_pct FROM p""")
def premium_coverage(spark, base):
    return X.premium_coverage(X.premium(table(spark, base, "standardize"), "row_id"))


_REG = "CASE " + " ".join(f"WHEN c = '{line.split('; ')[0]}' THEN '" + " / ".join(line.split("; ")[1:]).replace("'", "''") + "'" for line in D.DEPARTMENTS.strip().splitlines()) + " ELSE 'Département ' || c END"


@query(f"""WITH s AS (SELECT *, CASE WHEN starts_with({_t('code_postal')},'97') AND length({_t('code_postal')}) >= 3 THEN substr({_t('code_postal')},1,3) ELSE substr({_t('code_postal')},1,2) END AS c FROM standardize)
SELECT row_id, coalesce({_t('denomination')}, {_t('enseigne')}) AS name, coalesce({_t('siret')}, {_t('siren')}) AS identifier, {_t('forme_juridique')} AS form, {_t('naf')} AS sector,
nullif(concat_ws(' ', {_t('code_postal')}, {_t('commune')}), '') AS address, {_REG} AS region, {_t('telephone')} AS phone, {_t('email')} AS email, {_t('siteweb')} AS site, {_t('effectif')} AS staff FROM s""")
def structured_columns(spark, base):
    df = table(spark, base, "standardize")
    cols = X.structured(df)
    names = {"Nom entreprise": "name", "Identifiant (SIREN/SIRET/DUNS)": "identifier", "Forme juridique": "form", "Secteur (NAF/APE)": "sector", "Adresse complète": "address", "Région / Département": "region", "Téléphone standard": "phone", "Email générique": "email", "Site web": "site", "Effectif": "staff"}
    return df.select("row_id", *[cols[n].alias(a) for n, a in names.items()])


@query("SELECT denomination AS company_name, siren, NULL::VARCHAR AS siret, NULL::VARCHAR AS naf, NULL::VARCHAR AS region, best_email AS email, phones AS telephone, domain AS site_web, confidence AS score_business, NULL::VARCHAR AS email_valid, NULL::VARCHAR AS telephone_valid FROM clean_contacts".replace("confidence AS", "coalesce(CASE WHEN isnan(confidence) THEN 0 ELSE confidence END, 0.0) AS"))
def export_columns(spark, base):
    df = table(spark, base, "clean_contacts").withColumnsRenamed({"denomination": "name", "phones": "phone", "confidence": "score_business"})
    return X.export_frame(df)


@query(f"""WITH t AS (SELECT lower(trim(siren)) AS k, coalesce({_EOK}, false) AS e, coalesce(regexp_full_match({_PN}, '0[1-9][0-9]{{8}}'), false) AS p FROM standardize), c AS (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM t)
SELECT count(*) AS total, count(*) FILTER (WHERE e OR p) AS contactable, round(count(*) FILTER (WHERE e) * 100.0 / count(*), 2)::DOUBLE AS valid_email_rate, round(count(*) FILTER (WHERE k <> '' AND n > 1) * 100.0 / count(*), 2)::DOUBLE AS duplicate_rate FROM c""")
def export_kpis(spark, base):
    df = table(spark, base, "standardize")
    return X.export_kpis(df, X.identifier(df), C.email_check(F.col("email"))["is_valid"], C.phone_check(F.col("telephone"))["is_valid"])


@query(f"SELECT row_id, code_postal AS cp, naf AS naf_code, denomination AS raison_sociale, commune AS ville, adresse AS adresse_complete FROM standardize")
def old_names(spark, base):
    return X.with_aliases(X.lower_names(table(spark, base, "standardize"))).select("row_id", "cp", "naf_code", "raison_sociale", "ville", "adresse_complete")


@query(f"SELECT coalesce({_t('enseigne')}, {_t('denomination')}) AS name, {_t('commune')} AS town, {_b('row_id::VARCHAR')} AS row_id, {_b('naf')} AS naf, {_b('siren')} AS siren FROM standardize")
def extracted_columns(spark, base):
    out = X.extract_all(table(spark, base, "standardize"), {"name": ["nom", "enseigne", "denomination"], "town": ["ville", "commune"]})
    return out.select("name", "town", "row_id", "naf", "siren")


@query(f"""SELECT row_id, {_EOK} IS TRUE AS email_valid, regexp_full_match({_PN}, '0[1-9][0-9]{{8}}') IS TRUE AS phone_valid FROM standardize WHERE {_EOK} OR regexp_full_match({_PN}, '0[1-9][0-9]{{8}}') ORDER BY email_valid DESC, phone_valid DESC, row_id LIMIT 200""")
def top_contactable(spark, base):
    e, p = C.email_check(F.col("email"))["is_valid"], C.phone_check(F.col("telephone"))["is_valid"]
    df = table(spark, base, "standardize").select("row_id", e.alias("email_valid"), p.alias("phone_valid")).filter("email_valid or phone_valid")
    return df.orderBy(F.desc("email_valid"), F.desc("phone_valid"), "row_id").limit(200)


# ---------------------------------------------------------------- lookups
@query(f"""WITH r AS (SELECT {_host('domain')} AS d, CASE WHEN length({_dig('siren')}) >= 9 THEN substr({_dig('siren')},1,9) END AS k, top_url AS u, best_page AS p FROM clean_contacts WHERE top_url IS NOT NULL AND best_page IS NOT NULL),
a AS (SELECT k, min({{'u': u, 'p': p}}) AS x FROM r WHERE k IS NOT NULL GROUP BY 1), b AS (SELECT d, min({{'u': u, 'p': p}}) AS x FROM r WHERE d IS NOT NULL GROUP BY 1)
SELECT row_id, coalesce(a.x, b.x).u AS top_url, coalesce(a.x, b.x).p AS best_page FROM (SELECT row_id, siren, {_host('siteweb')} AS d FROM standardize) s LEFT JOIN a ON s.siren = a.k LEFT JOIN b ON s.d = b.d""")
def lookup_siren_then_domain(spark, base):
    s = table(spark, base, "standardize").select("row_id", "siren", C.host(F.col("siteweb")).alias("d"))
    r = table(spark, base, "clean_contacts").filter("top_url is not null and best_page is not null").select(C.siren_prefix(F.col("siren")).alias("rs"), C.host(F.col("domain")).alias("rd"), "top_url", "best_page")
    return L.lookup_in_turn(s, r, [("siren", "rs"), ("d", "rd")], ["top_url", "best_page"]).select("row_id", "top_url", "best_page")


_QK = lambda *cs: f"nullif(lower(trim(concat_ws(' ', {', '.join(cs)}))), '')"


@query(f"""WITH m AS (SELECT lower(trim(denomination)) AS k, max(maps_confidence_score) AS score, min(maps_id) AS first_id FROM maps_scraper WHERE trim(denomination) <> '' GROUP BY 1)
SELECT context_id, coalesce(m.score, 0.0) AS score, CASE WHEN m.k IS NULL THEN 'not_searched' ELSE 'found' END AS status FROM scrape_context c LEFT JOIN m ON lower(trim(c.denomination)) = m.k""")
def lookup_or_default(spark, base):
    m = table(spark, base, "maps_scraper").filter("trim(denomination) <> ''").groupBy(F.lower(F.trim("denomination")).alias("k")).agg(F.max("maps_confidence_score").alias("score")).withColumn("status", F.lit("found"))
    c = table(spark, base, "scrape_context").select("context_id", F.lower(F.trim("denomination")).alias("k"))
    return L.lookup_or(c, m, "k", {"score": 0.0, "status": "not_searched"}).select("context_id", F.coalesce("score", F.lit(0.0)).alias("score"), "status")


@query(f"""WITH v AS (SELECT lower(trim(denomination)) AS k, phone AS v, min(maps_id) AS o FROM maps_scraper WHERE denomination IS NOT NULL AND phone IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o, v) AS n FROM v)
SELECT k, string_agg(v, '; ' ORDER BY n) AS phone FROM r WHERE n <= 3 GROUP BY 1""")
def first_three_phones(spark, base):
    m = table(spark, base, "maps_scraper").select(F.lower(F.trim("denomination")).alias("k"), "phone", "maps_id")
    return L.first_joined(m, "k", "phone", ["maps_id"], 3)


@query("""WITH g AS (SELECT 'siren:' || trim(siren) AS k, min(domain) AS domain FROM clean_contacts WHERE trim(siren) <> '' GROUP BY 1)
SELECT row_id, domain FROM standardize s LEFT JOIN g ON g.k = coalesce(CASE WHEN trim(s.siren) <> '' THEN 'siren:' || trim(s.siren) END, CASE WHEN trim(s.siret) <> '' THEN 'siret:' || trim(s.siret) END)""")
def lookup_first_key(spark, base):
    g = table(spark, base, "clean_contacts").withColumn("key", L.first_key(["siren"])).filter("key is not null").groupBy("key").agg(F.min("domain").alias("domain"))
    s = table(spark, base, "standardize").withColumn("key", L.first_key(["siren", "siret"])).select("row_id", "key")
    return s.join(g, "key", "left").select("row_id", "domain")


@query(f"SELECT row_id FROM standardize WHERE NOT (coalesce(trim(siteweb) <> '', false))")
def needs_domain(spark, base):
    df = table(spark, base, "standardize")
    return df.filter(L.needs(df, ["domain", "siteweb", "site_web"])).select("row_id")


@query("SELECT count(*) FILTER (WHERE siren IS NULL) AS siren_null, count(*) FILTER (WHERE NOT regexp_full_match(coalesce(code_postal, ''), '[0-9]{2,5}')) AS bad_postal FROM standardize")
def format_violations(spark, base):
    return table(spark, base, "standardize").agg(F.count_if(F.col("siren").isNull()).alias("siren_null"), F.count_if(~F.coalesce("code_postal", F.lit("")).rlike(r"^\d{2,5}$")).alias("bad_postal"))


@query("SELECT DISTINCT maps_id FROM maps_scraper WHERE length(trim(address_complete)) >= 10 AND NOT (coalesce(trim(website) <> '', false) AND coalesce(trim(phone) <> '', false))")
def addresses_to_search(spark, base):
    have = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    return table(spark, base, "maps_scraper").filter((F.length(F.trim("address_complete")) >= 10) & ~(have("website") & have("phone"))).select("maps_id").distinct()


@query("SELECT CASE WHEN best_status BETWEEN 200 AND 399 THEN 'ok' WHEN best_status BETWEEN 400 AND 499 THEN 'client' WHEN best_status BETWEEN 500 AND 599 THEN 'server' END AS class, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4)::DOUBLE AS pct FROM clean_contacts GROUP BY 1")
def status_classes(spark, base):
    s = F.col("best_status")
    df = table(spark, base, "clean_contacts").groupBy(F.when(s.between(200, 399), "ok").when(s.between(400, 499), "client").when(s.between(500, 599), "server").alias("class")).agg(F.count("*").alias("n"))
    total = df.agg(F.sum("n").alias("t"))
    return df.join(total, how="left").select("class", "n", F.round(F.col("n") * 100.0 / F.col("t"), 4).alias("pct"))  # one row on the right


# ---------------------------------------------------------------- contacts
_REGD = lambda c: f"(CASE WHEN array_length(string_split({c}, '.')) >= 2 THEN array_to_string(string_split({c}, '.')[-2:], '.') ELSE {c} END)"
_CC = f"""r AS (SELECT *, coalesce(CASE WHEN length({_dig('siren')}) >= 9 THEN substr({_dig('siren')},1,9) END, {_host('domain')}) AS key, {_host('domain')} AS h FROM clean_contacts),
o AS (SELECT key, arg_min(h, contact_id) FILTER (WHERE h IS NOT NULL) AS own_domain, arg_min(nullif(trim(top_url),''), contact_id) FILTER (WHERE nullif(trim(top_url),'') IS NOT NULL) AS top_url FROM r WHERE key IS NOT NULL GROUP BY 1)"""
_FIT = lambda e: f"(o.own_domain IS NULL OR split_part({e},'@',-1) = o.own_domain OR ends_with(split_part({e},'@',-1), '.' || o.own_domain) OR {_REGD(_host(f'''split_part({e},'@',-1)'''))} = {_REGD('o.own_domain')})"


@query(f"""WITH {_CC}, m AS (SELECT DISTINCT r.key, e FROM (SELECT key, unnest(string_split_regex(lower(emails), '[;,|/\\s]+')) AS e FROM r WHERE key IS NOT NULL) r JOIN o USING (key) WHERE e LIKE '%_@_%' AND {_FIT('e')}),
b AS (SELECT r.key, arg_min(lower(trim(best_email)), (CASE WHEN lower(trim(email_type)) = 'nominative' THEN 0 ELSE 1 END) * 1000000000000 + contact_id) AS best_email FROM r JOIN o USING (key) WHERE nullif(trim(best_email),'') IS NOT NULL AND {_FIT('lower(trim(best_email))')} GROUP BY 1)
SELECT o.key, o.top_url, b.best_email, (SELECT string_agg(e, ';' ORDER BY e) FROM m WHERE m.key = o.key) AS emails FROM o LEFT JOIN b USING (key)""")
def company_contacts(spark, base):
    out = K.company_contacts(table(spark, base, "clean_contacts"), "contact_id", ["denomination", "top_url", "best_page", "query", "discovered_at"], ["addresses", "legal_managers", "sirets"])
    return out.select("key", "top_url", "best_email", F.nullif(F.array_join("emails", ";"), F.lit("")).alias("emails"))


@query("""WITH f AS (SELECT domain, url, priority, status, email_types, unnest(emails) AS email FROM page_extraction WHERE domain IS NOT NULL)
SELECT domain, email, m.a AS priority, m.b AS bad, m.c AS generic, m.d AS best_url FROM (SELECT domain, email, min({'a': priority, 'b': (coalesce(status,0) >= 400)::INT, 'c': (coalesce(email_types[email], 'generic') <> 'nominative')::INT, 'd': url}) AS m FROM f GROUP BY 1, 2)""")
def page_contacts(spark, base):
    return K.page_contacts(table(spark, base, "page_extraction"), "domain")


@query("""WITH f AS (SELECT domain, url, priority, status, email_types, unnest(emails) AS email FROM page_extraction WHERE domain IS NOT NULL),
g AS (SELECT domain, email, min({'a': priority, 'b': (coalesce(status,0) >= 400)::INT, 'c': (coalesce(email_types[email], 'generic') <> 'nominative')::INT, 'd': url}) AS m FROM f GROUP BY 1, 2),
h AS (SELECT domain, min({'a': m.a, 'b': m.b, 'c': m.c, 'e': email}) AS x, count(*) AS n_emails FROM g GROUP BY 1)
SELECT domain, x.e AS best_email, CASE WHEN x.c = 0 THEN 'nominative' ELSE 'generic' END AS email_type, n_emails FROM h""")
def best_email_of_site(spark, base):
    return K.best_emails(K.page_contacts(table(spark, base, "page_extraction"), "domain"), "domain")


@query("""SELECT domain, (SELECT string_agg(u, '|' ORDER BY u) FROM (SELECT DISTINCT url AS u FROM page_result p WHERE p.domain = k.domain AND trim(url) <> '')) AS urls FROM (SELECT DISTINCT domain FROM page_result WHERE domain IS NOT NULL AND trim(url) <> '') k""")
def crawl_targets(spark, base):
    return K.crawl_targets(table(spark, base, "page_result"), "domain", "url", []).select("domain", F.array_join("url", "|").alias("urls"))


@query("SELECT extraction_id FROM page_extraction WHERE coalesce(len(emails), 0) + coalesce(len(phones), 0) = 0")
def pages_without_contact(spark, base):
    return K.split_by_contact(table(spark, base, "page_extraction"), ["emails", "phones"])[1].select("extraction_id")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT url, text FROM page_result)")
def page_dedup(spark, base):
    return table(spark, base, "page_result").dropDuplicates(["url", "text"]).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- web
_SITE = f"trim({_b('siteweb')})"
_SCH = f"lower(regexp_extract({_SITE}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
_PLC = f"lower(regexp_extract({_SITE}, '^[A-Za-z]+://([^/?#]*)', 1))"


@query(f"""SELECT row_id, CASE WHEN {_SITE} IS NULL THEN 'missing' WHEN {_SCH} NOT IN ('http','https') THEN 'scheme' WHEN {_PLC} = '' THEN 'netloc' WHEN NOT regexp_full_match(regexp_replace({_PLC}, ':[0-9]+$', ''), '([a-z0-9_-]+\\.)+[a-z]{{2,}}') THEN 'domain' ELSE 'valid' END AS reason FROM standardize""")
def site_check(spark, base):
    return table(spark, base, "standardize").select("row_id", W.site_check(F.col("siteweb"))["reason"].alias("reason"))


@query("""WITH u AS (SELECT contact_id, unnest(map_values(social_links)) AS l FROM clean_contacts), x AS (SELECT contact_id, unnest(l) AS url FROM u)
SELECT contact_id, url, CASE WHEN NOT starts_with(url, 'https:') THEN 'scheme' WHEN lower(regexp_extract(url, '^https://([^/?#]*)', 1)) NOT IN ('www.linkedin.com','linkedin.com') THEN 'host' WHEN lower(regexp_extract(url, '^https://[^/?#]*/company/([^/?#]+)/?([?#].*)?$', 1)) = '' THEN 'path' ELSE 'valid' END AS reason FROM x WHERE trim(url) <> ''""")
def linkedin_check(spark, base):
    links = table(spark, base, "clean_contacts").select("contact_id", F.explode(F.flatten(F.map_values("social_links"))).alias("url")).filter("trim(url) <> ''")
    return links.select("contact_id", "url", W.linkedin_check(F.col("url"))["reason"].alias("reason"))


@query(f"SELECT row_id, CASE WHEN x = '' THEN x WHEN starts_with(x, '//') THEN 'https:' || x WHEN NOT contains(x, '//') THEN 'https://' || x ELSE x END AS url FROM (SELECT row_id, trim(regexp_replace(siteweb, '\\s+', ' ', 'g')) AS x FROM standardize)")
def ensured_scheme(spark, base):
    return table(spark, base, "standardize").select("row_id", W.with_scheme(F.col("siteweb")).alias("url"))


@query("SELECT page_id, regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') IN ('', '/index', '/index.html') AS home FROM page_result")
def home_pages(spark, base):
    return table(spark, base, "page_result").select("page_id", W.is_home(F.col("url")).alias("home"))


@query(f"SELECT page_id, (CASE WHEN NOT regexp_matches(lower(url), '^https?://') THEN true ELSE false END) OR ({_host('url')} IS NOT NULL AND {_host('url')} <> regexp_replace(lower(domain), '^www\\.', '')) OR regexp_matches(lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)), '\\.({'|'.join(W.FILES)})$') AS skip FROM page_result")
def skipped_urls(spark, base):
    return table(spark, base, "page_result").select("page_id", W.skipped(F.col("url"), F.col("domain")).alias("skip"))


@query(f"SELECT page_id, {_host('url')} AS host, {_REGD(_host('url'))} AS registered, regexp_extract({_REGD(_host('url'))}, '\\.(.+)$', 1) AS suffix, (len(string_split({_host('url')}, '.')) - len(string_split({_REGD(_host('url'))}, '.')))::INT AS depth FROM page_result")
def host_parts(spark, base):
    p = W.host_parts(F.col("url"))
    return table(spark, base, "page_result").select("page_id", *[p[c].alias(c) for c in ("host", "registered", "suffix", "depth")])


@query(f"""SELECT contact_id, coalesce(contains(best_email,'@') AND (lower(split_part(best_email,'@',-1)) = {_host('domain')} OR ends_with(lower(split_part(best_email,'@',-1)), '.' || {_host('domain')}) OR {_REGD(_host("split_part(best_email,'@',-1)"))} = {_REGD(_host('domain'))}), false) AS fits FROM clean_contacts""")
def email_fits_domain(spark, base):
    return table(spark, base, "clean_contacts").select("contact_id", W.email_of_domain(F.col("best_email"), C.host(F.col("domain"))).alias("fits"))


_SE0 = "regexp_replace(trim(best_email), '^[.,;:<>\\[\\](){}]+|[.,;:<>\\[\\](){}]+$', '', 'g')"
_SE = f"regexp_replace(regexp_replace({_SE0}, '\\s*@\\s*', '@', 'g'), '\\s*\\.\\s*', '.', 'g')"
_SL = f"regexp_replace(regexp_replace(regexp_replace(trim(split_part({_SE},'@',1)), '\\s+', '.', 'g'), '\\.+', '.', 'g'), '^\\.|\\.$', '', 'g')"
_SX = f"lower(CASE WHEN contains({_SE},'@') THEN {_SL} || '@' || regexp_replace(regexp_extract({_SE}, '^[^@]*@(.*)$', 1), '\\s+', '', 'g') ELSE {_SE} END)"


@query(f"""WITH s AS (SELECT contact_id, {_SX} AS email FROM clean_contacts)
SELECT contact_id, email, coalesce(contains(email,'@') AND split_part(email,'@',1) <> '' AND contains(regexp_extract(email,'^[^@]*@(.*)$',1), '.') AND regexp_extract(email, '\\.([^.]*)$', 1) NOT IN ({','.join(f"'{x}'" for x in W.BANNED)}) AND NOT regexp_matches(regexp_extract(email,'^[^@]*@(.*)$',1), '\\.(png|jpg|jpeg|gif|svg|webp)') AND length(split_part(email,'@',1)) <= 64 AND length(regexp_extract(email,'^[^@]*@(.*)$',1)) <= 255, false) AS plausible FROM s""")
def sanitised_emails(spark, base):
    e = W.sanitised_email(F.col("best_email"))
    return table(spark, base, "clean_contacts").select("contact_id", e.alias("email"), W.plausible_email(e).alias("plausible"))


@query("""SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\\b([0-9]{14})\\b', 1))), ';') AS sirets FROM page_result WHERE text IS NOT NULL""")
def ids_in_text(spark, base):
    return table(spark, base, "page_result").filter("text is not null").select("page_id", F.array_join(W.ids_in(F.col("text"))["sirets"], ";").alias("sirets"))


@query(f"""SELECT maps_id, (SELECT x FROM (SELECT unnest(list_transform(string_split(phone, ';'), lambda x: regexp_replace(regexp_replace(replace(x, '(0)', ''), '[^0-9]', '', 'g'), '^(0033|33)', '0'))) AS y, generate_subscripts(string_split(phone, ';'), 1) AS i) z, LATERAL (SELECT CASE WHEN length(y) = 9 THEN '+33' || y WHEN regexp_full_match(y, '0[1-9][0-9]{{8}}') THEN '+33' || substr(y, 2) END AS x) WHERE x IS NOT NULL AND regexp_full_match(x, '\\+33[1-9][0-9]{{8}}') ORDER BY i LIMIT 1) AS phone FROM maps_scraper""")
def first_maps_phone(spark, base):
    return table(spark, base, "maps_scraper").select("maps_id", W.first_french_phone(F.col("phone")).alias("phone"))


# ---------------------------------------------------------------- scores
_NT, _NN = _norm("maps_name"), _norm("denomination")


@query(f"SELECT maps_id, (CASE WHEN {_NT} = '' OR {_NN} = '' OR maps_name IS NULL OR denomination IS NULL THEN 0.0 WHEN {_NT} = {_NN} THEN 1.0 WHEN contains({_NT}, {_NN}) OR contains({_NN}, {_NT}) THEN 0.8 ELSE 0.0 END)::DOUBLE AS score FROM maps_scraper")
def title_scores(spark, base):
    return table(spark, base, "maps_scraper").select("maps_id", M.title_score(F.col("maps_name"), F.col("denomination")).alias("score"))


@query("""SELECT maps_id, round((CASE WHEN regexp_matches(t, '[0-9]+') THEN 0.2 ELSE 0 END) + (CASE WHEN regexp_matches(' ' || t || ' ', '[^a-z0-9_à-ÿ](rue|avenue|av|boulevard|bd|place|pl|chemin|impasse|allée|route|square|cours|quai)[^a-z0-9_à-ÿ]') THEN 0.3 ELSE 0 END) + (CASE WHEN regexp_matches(t, '\\b[0-9]{5}\\b') THEN 0.2 ELSE 0 END) + (CASE WHEN regexp_matches(t, '[0-9]{5}\\s+\\p{L}{2,}') THEN 0.2 ELSE 0 END) + (CASE WHEN length(t) >= 15 THEN 0.1 ELSE 0 END), 2)::DOUBLE AS quality
FROM (SELECT maps_id, lower(coalesce(address_complete, '')) AS t FROM maps_scraper)""")
def address_quality(spark, base):
    return table(spark, base, "maps_scraper").select("maps_id", M.address_quality(F.col("address_complete")).alias("quality"))


@query("""SELECT page_id, round(greatest(0.0, least(1.0, 0.35 + (CASE WHEN contains(lower(url), 'contact') THEN 0.2 WHEN regexp_matches(lower(url), 'mentions|legal') THEN 0.1 ELSE 0.05 END) + (CASE WHEN regexp_matches(lower(coalesce(text,'')), 'tél|tel|phone|appel|contact|standard') THEN 0.1 ELSE 0 END) - (CASE WHEN contains(lower(coalesce(text,'')), 'fax') THEN 0.1 ELSE 0 END)
+ (CASE WHEN regexp_matches(regexp_extract(text, '(0[1-9][0-9]{8})', 1), '^0[67]') THEN 0.05 ELSE 0 END))), 4)::DOUBLE AS score FROM page_result WHERE regexp_extract(text, '(0[1-9][0-9]{8})', 1) <> ''""")
def phone_on_site(spark, base):
    p = F.regexp_extract("text", r"(0[1-9]\d{8})", 1)
    return table(spark, base, "page_result").withColumn("p", p).filter("p <> ''").select("page_id", M.phone_on_site_score(F.col("p"), F.col("url"), F.col("text")).alias("score"))


@query()
def place_scores(spark, base):
    """Maps rows that name a company, against that company's place in its own address."""
    df = table(spark, base, "maps_scraper").filter("denomination is not null")
    town, code = F.regexp_extract("address_complete", r"\d{5}\s+(.+)$", 1), F.regexp_extract("address_complete", r"(\d{5})", 1)
    return df.select("maps_id", M.place_score(F.col("denomination"), F.col("maps_name"), town, code, F.col("address_complete")).alias("confidence"))


@query()
def domain_scores(spark, base):
    df = table(spark, base, "clean_contacts").filter("domain is not null and denomination is not null")
    return df.select("contact_id", M.domain_score(F.col("domain"), F.col("denomination"), F.lit(None).cast("string"), F.col("query"), ["annuaire", "directory", "pagesjaunes"]).alias("score"))


@query()
def serp_scores(spark, base):
    df = table(spark, base, "clean_contacts").filter("domain is not null and denomination is not null")
    g = C.host(F.col("domain")).rlike("annuaire|directory")
    return df.select("contact_id", M.serp_score(F.col("denomination"), C.host(F.col("domain")), F.col("query"), F.col("query"), F.lit("x"), g).alias("score"), M.serp_rank_score(T.normalize_text(F.col("denomination")), C.host(F.col("domain")), F.col("query"), F.lit(""), F.lit("")).alias("rank_score"))
