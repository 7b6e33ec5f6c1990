"""Schemas that drift between the files of a feed.

Rows are loaded as path-value maps with their raw types (Spark's variant type, so
parsing stays inside the JVM), path-type statistics are aggregated by file, files
are compared with their predecessor, and typed columns are projected with a
report of the casts that failed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

# Names under which registry exports deliver known columns of the
# consistent table, and their types; all other columns come from the data.
TARGETS = {
    "siret": ("string", ["siret", "id_etablissement"]),
    "denomination": ("string", ["denomination", "denominationUniteLegale", "raison_sociale", "nom_societe", "company_name", "lib_entreprise"]),
    "enseigne": ("string", ["enseigne", "enseigne1Etablissement", "nom_commercial"]),
    "adresse": ("string", ["adresse", "adresseEtablissement"]),
    "code_postal": ("string", ["code_postal", "codePostalEtablissement", "postcode", "zip", "cp"]),
    "commune": ("string", ["commune", "ville", "localite", "libelleCommuneEtablissement"]),
    "naf": ("string", ["naf", "ape", "code_naf", "code_activite", "activitePrincipaleEtablissement"]),
    "date_creation": ("date", ["date_creation", "dateCreationEtablissement"]),
    "etat_administratif": ("string", ["etat_administratif", "etatAdministratifEtablissement", "etat"]),
    "effectif": ("long", ["effectif", "trancheEffectifsEtablissement", "effectif_salarie"]),
    "capital_social": ("double", ["capital_social"]),
    "telephone": ("string", ["telephone", "phone", "tel"]),
    "email": ("string", ["email", "e_mail"]),
    "siteweb": ("string", ["siteweb", "site_web"]),
}


@dataclass(frozen=True)
class DriftConf:
    """agree: share of linked lines that must hold the same value under the new name."""

    agree: float = 0.5
    anchor_length: int = 8
    targets: dict = field(default_factory=lambda: TARGETS)


def _kind(type_text: Column, raw: Column) -> Column:
    whole = ~raw.rlike("[.eE]")
    return (
        F.when(type_text == "BOOLEAN", "boolean")
        .when(type_text == "STRING", "string")
        .when(type_text.startswith("ARRAY"), "array")
        .when(type_text.startswith("OBJECT"), "object")
        .when(type_text.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
        .when(type_text.startswith("DECIMAL") & whole, "integer")
        .when(type_text.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "decimal")
    )


def _canon(raw: Column) -> Column:
    """Letters and digits (case kept), leading zeros dropped: equal across retyping."""
    return F.regexp_replace(F.regexp_replace(raw, r"[^\p{L}\p{N}]+", ""), "^0+(?=.)", "")


def path_values(df: DataFrame, repeats: bool = False) -> DataFrame:
    """One row per (line, field): feed_id, file_seq, raw_id, line_no, field, kind, raw, canon.

    Unreadable lines (cut, not an object, null, repeated key) give no row; a field
    whose value is null has kind null; a line without fields has one row of field null.
    Exact repeats of a line within one file are counted once (the lowest raw_id stands for
    them) unless `repeats` asks for all of them.
    """
    rows = df.filter(F.col("payload").isNotNull()).select("feed_id", "file_seq", "payload", "raw_id", "line_no")
    if not repeats:
        rows = rows.groupBy("feed_id", "file_seq", "payload").agg(F.min("raw_id").alias("raw_id"), F.min("line_no").alias("line_no"))
    lines = (
        rows.withColumn("v", F.expr("try_parse_json(payload)"))
        .withColumn("m", F.from_json("payload", "map<string,string>"))
        .filter(F.col("v").isNotNull() & F.col("m").isNotNull())
    )
    keep = ["raw_id", "line_no", "feed_id", "file_seq", "m", "v"]
    out = lines.select(*keep, F.explode_outer(F.map_keys("m")).alias("field"))
    # The value is addressed by its key; dots and quotes in keys are kept apart.
    out = out.withColumn("raw", F.element_at("m", F.col("field")))
    typed = out.withColumn("t", F.expr("schema_of_variant(try_variant_get(v, concat('$[\"', replace(field, '\"', ''), '\"]'), 'variant'))"))
    return typed.select(
        "feed_id", "file_seq", "raw_id", "line_no", "field",
        F.when(F.col("raw").isNotNull(), _kind(F.col("t"), F.col("raw"))).alias("kind"), "raw", _canon(F.col("raw")).alias("canon"),
    )


def path_stats(cells: DataFrame) -> DataFrame:
    """Statistics by file and field: lines, non-null values, ruling type (most values; ties by name)."""
    by = cells.filter("field is not null").groupBy("feed_id", "file_seq", "field", "kind").agg(F.count("*").alias("n"))
    return by.groupBy("feed_id", "file_seq", "field").agg(
        F.sum("n").alias("n_lines"),
        F.sum(F.when(F.col("kind").isNotNull(), F.col("n")).otherwise(0)).alias("n_values"),
        F.max_by("kind", F.when(F.col("kind").isNotNull(), F.struct("n", "kind"))).alias("kind"),
    )


def _same(a: Column, ka: Column, b: Column, kb: Column) -> Column:
    """Do two canonical values say the same, whatever their types?"""
    digits = lambda c: F.regexp_replace(c, r"\D+", "")
    truth = lambda c: F.when(F.upper(c).isin("TRUE", "A", "1", "O", "OUI", "ACTIF"), "T").when(F.upper(c).isin("FALSE", "F", "C", "0", "N", "NON", "FERME"), "F")
    long = (F.length(a) >= 3) & (F.length(b) >= 3)
    nested = ka.isin("array", "object") | kb.isin("array", "object")
    number = (ka.isin("integer", "decimal") | kb.isin("integer", "decimal")) & (F.length(digits(a)) >= 2)
    strip0 = lambda c: F.regexp_replace(c, "0+$", "")
    return (
        (a == b)
        | (nested & long & (F.contains(a, b) | F.contains(b, a)))
        | (number & (digits(a) == digits(b)))
        | ((ka == "decimal") != (kb == "decimal")) & number & (strip0(digits(a)) == strip0(digits(b)))
        | (((ka == "boolean") != (kb == "boolean")) & (truth(a) == truth(b)))
    )


def _files(stats: DataFrame) -> DataFrame:
    return stats.select("feed_id", "file_seq").distinct().withColumn("prev_seq", F.lag("file_seq").over(Window.partitionBy("feed_id").orderBy("file_seq")))


def schema_changes(cells: DataFrame, conf: DriftConf = DriftConf()) -> DataFrame:
    """(feed_id, file_seq, change, field, previous): each change against the file before.

    Lines of neighbouring files are linked through long values unique in both files
    under the same name; a removed and an added field are one renamed field if the
    linked lines hold the same value under both names. The first file of a feed,
    files with no readable line and fields without any value give no `retyped` row.
    """
    stats = path_stats(cells)
    files = _files(stats)
    now = stats.join(files, ["feed_id", "file_seq"]).filter(F.col("prev_seq").isNotNull())
    step = files.filter(F.col("prev_seq").isNotNull())
    old = stats.select("feed_id", F.col("file_seq").alias("prev_seq"), "field", F.col("kind").alias("old_kind")).join(step, ["feed_id", "prev_seq"])
    both = now.select("feed_id", "file_seq", "field", "kind", F.lit(True).alias("is_new")).join(
        old.select("feed_id", "file_seq", "field", "old_kind", F.lit(True).alias("is_old")), ["feed_id", "file_seq", "field"], "full"
    )
    both = cut(both)
    added = both.filter("is_old is null").select("feed_id", "file_seq", F.col("field").alias("g"), F.col("kind").alias("g_kind"))
    removed = both.filter("is_new is null").select("feed_id", "file_seq", F.col("field").alias("f"), F.col("old_kind").alias("f_kind"))
    pairs = removed.join(added, ["feed_id", "file_seq"]).join(step, ["feed_id", "file_seq"])

    anchors = cells.filter((F.length("canon") >= conf.anchor_length) & F.col("kind").isin("string", "integer")).groupBy("feed_id", "file_seq", "field", "canon").agg(F.count("*").alias("n"), F.min("raw_id").alias("raw_id")).filter("n = 1").drop("n")
    steps = pairs.select("feed_id", "file_seq", "prev_seq").distinct()
    later = anchors.join(steps, ["feed_id", "file_seq"]).withColumnRenamed("raw_id", "id_b")
    links = later.join(anchors.withColumnRenamed("file_seq", "prev_seq").withColumnRenamed("raw_id", "id_a"), ["feed_id", "prev_seq", "field", "canon"]).select("feed_id", "file_seq", "id_a", "id_b").distinct()
    val = cells.filter("kind is not null").select("raw_id", "field", "kind", "canon")
    seen = (
        pairs.join(links, ["feed_id", "file_seq"])
        .join(val.select(F.col("raw_id").alias("id_a"), F.col("field").alias("f"), F.col("kind").alias("ka"), F.col("canon").alias("a")), ["id_a", "f"])
        .join(val.select(F.col("raw_id").alias("id_b"), F.col("field").alias("g"), F.col("kind").alias("kb"), F.col("canon").alias("b")), ["id_b", "g"])
        .groupBy("feed_id", "file_seq", "f", "g", "f_kind", "g_kind")
        .agg(F.count("*").alias("n"), F.avg(_same(F.col("a"), F.col("ka"), F.col("b"), F.col("kb")).cast("int")).alias("agree"))
    )
    best = lambda k: F.row_number().over(Window.partitionBy("feed_id", "file_seq", k).orderBy(F.desc("agree"), F.desc("n"), "f", "g"))
    renamed = cut(seen.filter((F.col("agree") >= conf.agree) & (F.col("n") >= 2)).withColumn("rf", best("f")).withColumn("rg", best("g")).filter("rf = 1 and rg = 1"))
    row = lambda d, change, name, previous: d.select("feed_id", "file_seq", F.lit(change).alias("change"), F.col(name).alias("field"), previous.alias("previous"))
    return (
        row(added.join(renamed, ["feed_id", "file_seq", "g"], "left_anti"), "added", "g", F.lit(""))
        .unionByName(row(removed.join(renamed, ["feed_id", "file_seq", "f"], "left_anti"), "removed", "f", F.lit("")))
        .unionByName(row(renamed, "renamed", "g", F.col("f")))
        .unionByName(row(renamed.filter("f_kind <> g_kind"), "retyped", "g", F.col("f_kind")))
        .unionByName(row(both.filter("kind <> old_kind"), "retyped", "field", F.col("old_kind")))
    )


def _columns(cells: DataFrame, conf: DriftConf) -> tuple[dict[str, str], dict[str, str]]:
    """(column of every field name in small letters, type of every column).

    Names are one column where the targets say so or a rename was found, the most
    frequent rename first. A rename joins neither two targets nor names that stand
    beside each other in one file. A column that is no target bears its commonest name
    and the type of most of its values. Only names and counts reach the driver.
    """
    stats = path_stats(cells)
    low = F.lower("field").alias("field")
    values = stats.groupBy(low, "kind").agg(F.sum("n_values").alias("n"), F.collect_set(F.struct("feed_id", "file_seq")).alias("files")).collect()
    count: dict[str, dict[str | None, int]] = {}
    files: dict[str, set] = {}
    for r in values:
        count.setdefault(r.field, {})[r.kind] = r.n
        files.setdefault(r.field, set()).update(tuple(f) for f in r.files)
    total = {f: sum(k.values()) for f, k in count.items()}
    group = {f: f for f in count}
    members = {f: [f] for f in count}
    target: dict[str, str] = {}

    def unite(a: str, b: str) -> None:
        for f in members[b]:
            group[f] = a
        members[a] += members.pop(b)
        files[a] = files[a] | files[b]

    for name, (_, names) in conf.targets.items():
        have = [n for n in dict.fromkeys(x.lower() for x in names) if n in group]
        for other in have[1:]:
            unite(have[0], other)
        if have:
            target[have[0]] = name
    found = schema_changes(cells, conf).filter("change = 'renamed'").groupBy(F.lower("previous").alias("f"), F.lower("field").alias("g")).count().collect()
    for r in sorted(found, key=lambda r: (-r["count"], r.f, r.g)):
        a, b = group[r.f], group[r.g]
        if a == b or a in target and b in target or files[a] & files[b]:
            continue
        unite(*((b, a) if b in target else (a, b)))
    column, kinds = {}, {n: k for n, (k, _) in conf.targets.items()}
    taken = {"feed_id", "file_seq", "raw_id", "line_no", "failed_casts", *conf.targets}
    for a in sorted(members):
        name = target.get(a)
        if name is None:
            name = max(members[a], key=lambda f: (total[f], f))
            while name in taken:
                name += "_"
            taken.add(name)
            n: dict[str | None, int] = {}
            for f in members[a]:
                for k, v in count[f].items():
                    n[k] = n.get(k, 0) + v
            whole, real = n.get("integer", 0), n.get("decimal", 0)
            most = sum(v for k, v in n.items() if k) / 2
            kinds[name] = "boolean" if n.get("boolean", 0) > most else "string" if whole + real <= most else "double" if real else "long"
        for f in members[a]:
            column[f] = name
    return column, kinds


def _plain(raw: Column, kind: Column) -> Column:
    """Scalar text of a value: the first entry of an array, the `code` or first member of an object."""
    first = F.coalesce(F.get_json_object(raw, "$[0]"), raw)
    member = F.coalesce(F.get_json_object(raw, "$.code"), F.element_at(F.map_values(F.from_json(raw, "map<string,string>")), 1))
    return F.when(kind == "array", first).when(kind == "object", member).otherwise(raw)


def consistent_table(cells: DataFrame, conf: DriftConf = DriftConf()) -> DataFrame:
    """One row per readable line with typed columns for all fields and `failed_casts`.

    `failed_casts` maps a column to the raw text that could not be cast. Where a line
    fills a column under two names, the target's first name goes first. A postal
    code that lost its leading zero gets it back, a NAF code loses its dots. Lists and
    objects under other names than the targets' keep their JSON text.
    """
    cells = cut(cells)
    column, kinds = _columns(cells, conf)
    place = {name: f"c{i}" for i, name in enumerate(kinds)}
    order = {f.lower(): i for _, names in conf.targets.values() for i, f in enumerate(names)}
    known = [x for f, name in column.items() for x in (F.lit(f), F.struct(F.lit(place[name]).alias("name"), F.lit(order.get(f, len(order))).alias("rank")))]
    named = cells.withColumn("at", F.create_map(*known)[F.lower("field")] if known else F.lit(None).cast("struct<name:string,rank:int>")).withColumns({"name": F.col("at.name"), "rank": F.col("at.rank")})
    scalar = F.col("name").isin([place[n] for n in conf.targets])
    named = named.withColumn("plain", F.trim(F.when(scalar, _plain(F.col("raw"), F.col("kind"))).otherwise(F.col("raw"))))
    wide = named.groupBy("feed_id", "file_seq", "raw_id", "line_no").pivot("name", list(place.values())).agg(F.min_by("plain", F.when(F.col("plain") != "", F.struct("rank", "field"))))
    cast = {}
    for name, kind in kinds.items():
        at = place[name]
        c = F.when(F.trim(at) != "", F.col(at))
        if name == "code_postal":
            cast[name] = F.when(c.rlike(r"^\d{4,5}$"), F.lpad(c, 5, "0"))
        elif name == "naf":
            cast[name] = F.nullif(F.upper(F.regexp_replace(c, r"[\s.]", "")), F.lit(""))
        elif kind == "date":
            cast[name] = F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")), F.try_to_timestamp(c, F.lit("yyyyMMdd"))).cast("date")
        elif kind == "string":
            cast[name] = c
        else:
            cast[name] = F.expr(f"try_cast({at} as {kind})")
    failed = F.filter(F.array(*[F.when(F.col(place[n]).isNotNull() & (F.trim(place[n]) != "") & v.isNull(), F.struct(F.lit(n).alias("key"), F.col(place[n]).alias("value"))) for n, v in cast.items()]), lambda x: x.isNotNull())
    return wide.select("feed_id", "file_seq", "raw_id", "line_no", *[v.alias(n) for n, v in cast.items()], F.map_from_entries(failed).alias("failed_casts"))


def failed_casts(typed: DataFrame) -> DataFrame:
    """Per feed, file and column: values that could not be cast, and one example (the smallest)."""
    return typed.select("feed_id", "file_seq", F.explode("failed_casts").alias("field", "raw")).groupBy("feed_id", "file_seq", "field").agg(F.count("*").alias("n"), F.min("raw").alias("example"))
