"""Models on pyspark.ml: classifiers, n-gram TF-IDF similarity, hashed embeddings."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, Normalizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def balanced(df: DataFrame, label: str) -> DataFrame:
    """Adds `weight`: the classes weigh alike."""
    n = df.groupBy(label).agg(F.count("*").alias("_n"))
    total, classes = df.count(), n.count()
    return df.join(F.broadcast(n), label).withColumn("weight", F.lit(float(total)) / (F.lit(classes) * F.col("_n"))).drop("_n")


def logistic(features: list[str], label: str = "label") -> Pipeline:
    """Assemble, standardise, balanced logistic regression."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=True),
        LogisticRegression(featuresCol="_features", labelCol=label, weightCol="weight", regParam=0.01),
    ])


def forest(features: list[str], label: str = "label", trees: int = 50) -> Pipeline:
    """Random forest for several classes."""
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="_label", handleInvalid="skip"), VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep"),
        RandomForestClassifier(featuresCol="_features", labelCol="_label", numTrees=trees, seed=7),
    ])


def best_of(scored: DataFrame, group: str, item: str, score: str) -> DataFrame:
    """The item of greatest score of each group; ties go to the smaller item."""
    return scored.groupBy(group).agg(F.min_by(item, F.struct(-F.col(score), F.col(item))).alias(item), F.max(score).alias(score))


FEATURES = (
    "overlap back_overlap same_head holds_head starts ends near length_name length_host length_gap n_tokens n_labels depth digits hyphens vowels short_end known_end "
    "first_token last_token initials token_hits longest_hit joined_equal sorted_equal town_hit prefix_share trade_hit"
).split()


def domain_features(df: DataFrame, name: str = "name", host: str = "host") -> DataFrame:
    """Adds the features of a company name against a candidate host (JVM expressions only)."""
    from .functions.contact import registrable
    from .functions.text import company_tokens

    c = F.col
    t = df.withColumn("_t", company_tokens(c(name))).withColumn("_r", registrable(c(host)))
    t = t.withColumns({"_s": F.regexp_replace(F.regexp_replace("_r", r"\.[^.]+$", ""), "[^a-z0-9]", ""), "_h": F.filter(F.split(F.regexp_replace("_r", r"\.[^.]+$", ""), "[-_.]"), lambda x: x != ""), "_j": F.array_join("_t", "")})
    one = lambda b: F.coalesce(b, F.lit(False)).cast("double")
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)).cast("double")
    both = F.size(F.array_intersect("_t", "_h"))
    hits = F.filter("_t", lambda w: (F.length(w) > 2) & F.contains(c("_s"), w))
    first, last = F.get("_t", F.lit(0)), F.try_element_at("_t", F.lit(-1))
    length = lambda x: F.coalesce(F.length(x), F.lit(0)).cast("double")
    same = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(F.length("_j"), F.length("_s")), F.lit(1))), F.lit(0), lambda n, i: n + (F.substr(c("_j"), F.lit(1), i) == F.substr(c("_s"), F.lit(1), i)).cast("int"))
    values = {
        "overlap": share(both, F.size("_t")), "back_overlap": share(both, F.size("_h")), "same_head": one(first == F.get("_h", F.lit(0))), "holds_head": one(F.contains(c("_s"), first)),
        "starts": one(F.startswith(c("_s"), first)), "ends": one(F.endswith(c("_s"), last)), "near": 1 - share(F.levenshtein("_j", "_s"), F.greatest(F.length("_j"), F.length("_s"))),
        "length_name": length(c("_j")), "length_host": length(c("_s")), "length_gap": F.abs(length(c("_j")) - length(c("_s"))), "n_tokens": F.size("_t").cast("double"), "n_labels": F.size("_h").cast("double"),
        "depth": (F.size(F.split(host, r"\.")) - F.size(F.split("_r", r"\."))).cast("double"), "digits": share(F.length(F.regexp_replace("_s", "[^0-9]", "")), F.length("_s")),
        "hyphens": (F.size(F.split("_r", "-")) - 1).cast("double"), "vowels": share(F.length(F.regexp_replace("_s", "[^aeiouy]", "")), F.length("_s")),
        "short_end": one(F.length(F.regexp_extract("_r", r"\.([^.]+)$", 1)) <= 3), "known_end": one(c("_r").rlike(r"\.(fr|com|eu|net|org)$")),
        "first_token": length(first), "last_token": length(last), "initials": one(F.contains(c("_s"), F.array_join(F.transform("_t", lambda w: F.substr(w, F.lit(1), F.lit(1))), ""))),
        "token_hits": share(F.size(hits), F.size("_t")), "longest_hit": F.coalesce(F.array_max(F.transform(hits, lambda w: F.length(w))), F.lit(0)).cast("double"),
        "joined_equal": one(c("_j") == c("_s")), "sorted_equal": one(F.array_join(F.array_sort("_t"), "") == F.array_join(F.array_sort("_h"), "")),
        "town_hit": one((F.size("_t") > 1) & F.contains(c("_s"), last)), "prefix_share": share(same, F.length("_s")), "trade_hit": one((F.size("_t") > 1) & F.startswith(c("_s"), F.get("_t", F.lit(1)))),
    }
    return t.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in values.items()}).drop("_t", "_r", "_s", "_h", "_j")


def domain_predictor(contacts: DataFrame, others: int = 4) -> DataFrame:
    """One row: companies held out, share whose own host is ranked first among the candidates, ROC.

    Candidates of a company are its own host and hosts of companies whose names begin
    with the same word, at most `others` in the order of a hash. Fitted on three of four
    companies. Companies without name or host are left out.
    """
    from .functions.contact import host, siren_prefix
    from .functions.text import company_tokens

    rows = contacts.select(siren_prefix(F.col("siren")).alias("siren"), F.col("denomination").alias("name"), host(F.col("domain")).alias("host")).filter("siren is not null and name is not null and host is not null")
    own = rows.groupBy("siren").agg(F.min("name").alias("name"), F.min("host").alias("host")).withColumn("word", F.get(company_tokens(F.col("name")), F.lit(0))).filter("word is not null")
    # Hosts of a word stand in a ring by hash: a company takes the ones that follow its own, so no word is joined with itself.
    from pyspark.sql import Window

    ring = Window.partitionBy("word").orderBy(F.xxhash64("host"), "siren")
    near = own
    for k in range(1, others + 1):
        near = near.withColumn(f"h{k}", F.lead("host", k).over(ring))
    cand = near.select("siren", "name", F.col("host").alias("own"), F.explode(F.array_distinct(F.array_compact(F.array("host", *[f"h{k}" for k in range(1, others + 1)])))).alias("host"))
    data = domain_features(cand.withColumn("label", (F.col("host") == F.col("own")).cast("double")))
    part = F.pmod(F.xxhash64("siren"), F.lit(4))
    model = logistic(list(FEATURES)).fit(balanced(data.filter(part != 0), "label"))
    out = model.transform(data.filter(part == 0)).withColumn("score", vector_to_array("probability")[1])
    roc = BinaryClassificationEvaluator(labelCol="label").evaluate(out)
    picked = best_of(out, "siren", "host", "score").join(own.select("siren", F.col("host").alias("own")), "siren")
    return picked.agg(F.count("*").alias("n"), F.round(F.avg((F.col("host") == F.col("own")).cast("double")), 6).alias("first")).withColumn("roc", F.lit(round(roc, 6)))


def char_grams(text, low: int = 3, high: int = 5):
    """Character n-grams of the words of a text, padded by blanks; a word shorter than n gives itself."""

    def sized(w, n):
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1))), lambda i: F.substring(w, i, F.lit(n)))

    words = F.transform(F.split(text, " "), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    return F.flatten(F.transform(words, lambda w: F.concat(*[sized(w, n) for n in range(low, high + 1)])))


def tfidf_cosine(pairs: DataFrame) -> DataFrame:
    """(id, cosine) of the TF-IDF vectors of two texts a and b: character n-grams, smooth inverse
    document frequency over both sides, all of it joins and sums. Texts without words have cosine 0."""
    words = lambda t: F.array_join(F.filter(F.split(t, " "), lambda w: w != ""), " ")
    side = lambda s: pairs.select("id", F.lit(s).alias("side"), F.explode(char_grams(words(F.col(s)))).alias("g")).filter("trim(g) <> ''")
    tf = side("a").unionByName(side("b")).groupBy("id", "side", "g").agg(F.count("*").alias("n"))
    total = 2.0 * pairs.count()
    df = tf.groupBy("g").agg(F.count("*").alias("df"))
    w = tf.join(df, "g").withColumn("w", F.col("n") * (F.log((1.0 + total) / (1.0 + F.col("df"))) + 1))
    both = w.groupBy("id", "g").agg(F.sum(F.when(F.col("side") == "a", F.col("w"))).alias("wa"), F.sum(F.when(F.col("side") == "b", F.col("w"))).alias("wb"))
    sums = both.groupBy("id").agg(F.sum(F.col("wa") * F.col("wb")).alias("dot"), F.sqrt(F.sum(F.col("wa") * F.col("wa"))).alias("na"), F.sqrt(F.sum(F.col("wb") * F.col("wb"))).alias("nb"))
    cosine = F.when((F.col("na") > 0) & (F.col("nb") > 0), F.col("dot") / (F.col("na") * F.col("nb")))
    return pairs.select("id").join(sums, "id", "left").select("id", F.round(F.coalesce(cosine, F.lit(0.0)), 6).alias("cosine"))


def hashed_embedding(df: DataFrame, text: str, size: int = 512) -> DataFrame:
    """Adds `embedding`: hashed word counts, unit length."""
    t = df.withColumn("_w", F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\W+"))
    m = Pipeline(stages=[HashingTF(inputCol="_w", outputCol="_tf", numFeatures=size), Normalizer(inputCol="_tf", outputCol="_v")]).fit(t)
    return m.transform(t).withColumn("embedding", vector_to_array("_v")).drop("_w", "_tf", "_v")


def address_classes(agents: DataFrame) -> DataFrame:
    """One row: held-out rows and accuracy of a forest that tells from an address how much a search for it finds.

    Classes: high from three places, medium for one or two, low for none. Fitted on three
    of four rows; rows without a count are left out.
    """
    from .operators.enrichment import address_features

    f = address_features(F.col("adresse"))
    marks = [n for n in "length words commas numbers digit_share upper_share starts_with_number suffix way short_way zone inside code cedex country named_place longest odd_signs".split()]
    n = F.col("apify_places_found")
    df = agents.filter(n.isNotNull()).select("agent_row_id", F.when(n >= 3, "high").when(n >= 1, "medium").otherwise("low").alias("label"), *[f[m].cast("double").alias(m) for m in marks])
    part = F.pmod(F.xxhash64("agent_row_id"), F.lit(4))
    model = forest(marks, trees=20).fit(df.filter(part != 0))
    return model.transform(df.filter(part == 0)).agg(F.count("*").alias("n"), F.round(F.avg((F.col("prediction") == F.col("_label")).cast("double")), 6).alias("accuracy"))
