"""Named steps on data frames, run in the order of their dependencies, with profiles and resume."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Step = Callable[[dict[str, DataFrame], dict], DataFrame]


@dataclass
class Pipeline:
    """Steps with dependencies. Frames are lazy: nothing runs until a result is written or read."""

    steps: dict[str, Step] = field(default_factory=dict)
    needs: dict[str, list[str]] = field(default_factory=dict)
    profiles: dict[str, list[str]] = field(default_factory=dict)

    def step(self, name: str, needs: list[str] | None = None):
        def add(f: Step) -> Step:
            self.steps[name], self.needs[name] = f, list(needs or [])
            return f

        return add

    def batches(self, names: list[str]) -> list[list[str]]:
        """Names and what they need, in levels that depend on earlier levels only."""
        want, todo = set(), list(names)
        while todo:
            n = todo.pop()
            if n not in self.steps:
                raise KeyError(n)
            if n not in want:
                want.add(n)
                todo += self.needs[n]
        sorter = TopologicalSorter({n: self.needs[n] for n in want})
        sorter.prepare()
        out = []
        while sorter.is_active():
            ready = sorted(sorter.get_ready())
            out.append(ready)
            sorter.done(*ready)
        return out

    def run(self, profile: str | list[str], conf: dict | None = None, done: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
        """Frames of all steps of a profile; steps in `done` are taken over (resume)."""
        frames = dict(done or {})
        names = self.profiles[profile] if isinstance(profile, str) else profile
        for level in self.batches(names):
            for n in level:
                if n not in frames:
                    frames[n] = self.steps[n]({k: frames[k] for k in self.needs[n]}, conf or {})
        return frames


def pending(items: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    """Items that are not completed."""
    return items.join(completed.select(key), key, "left_anti")


def progress(items: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    done = completed.select(key).distinct().withColumn("_d", F.lit(1))
    return items.join(done, key, "left").agg(F.count("*").alias("total"), F.count("_d").alias("done")).withColumn("pct", F.round(F.when(F.col("total") > 0, F.col("done") / F.col("total") * 100).otherwise(100.0), 2))


def parse_codes(text: str) -> list[str]:
    """Codes of a list by `;` or `,`, each once, in order."""
    return list(dict.fromkeys(x.strip() for x in text.replace(";", ",").split(",") if x.strip()))


def company_pipeline() -> Pipeline:
    """Normalise, deduplicate, score and export a company table."""
    from ..functions import contact as C
    from ..functions import numbers as N
    from ..functions import scores as S
    from ..functions import text as T
    from ..operators import relational as R

    p = Pipeline(profiles={"quick": ["export"], "full": ["export", "duplicates"]})

    @p.step("normalize")
    def normalize(_, conf):
        df = conf["source"]
        prefixes = conf.get("naf", [])
        if prefixes:
            df = df.filter(C.naf_matches(F.col("naf"), prefixes))
        if conf.get("active_only"):
            df = df.filter("etat_administratif = 'A'")
        return df.withColumns({"phone": C.fr_phone(F.col("telephone")), "naf_code": C.naf_clean(F.col("naf")), "department": C.department(F.col("code_postal")), "name": T.first_filled(F.col("enseigne"), F.col("denomination")), "domain": C.registrable(F.col("siteweb"))})

    @p.step("dedup", ["normalize"])
    def dedup(f, conf):
        return R.keep_first(f["normalize"], conf.get("keys", ["siret"]), ["row_id"])

    @p.step("duplicates", ["normalize"])
    def duplicates(f, conf):
        return R.duplicate_combinations(f["normalize"], conf.get("keys", ["siret", "phone"]))

    @p.step("score", ["dedup"])
    def score(f, conf):
        none, c = F.lit(None).cast("string"), F.col
        s = S.lead(c("email"), c("phone"), c("domain"), c("adresse"), none, c("effectif"), none, c("naf_code"), none, c("date_creation"), F.lit(conf.get("as_of", "2026-01-01")).cast("date"))
        return f["dedup"].withColumn("score", s).withColumn("age_known", N.parse_date(c("date_creation")).isNotNull())

    @p.step("export", ["score"])
    def export(f, conf):
        return R.top_k(f["score"].select("row_id", "siren", "name", "phone", "email", "department", "score"), [F.desc("score"), F.col("row_id")], conf.get("limit", 500))

    return p


def run_company(spark: SparkSession, source: DataFrame, profile: str = "quick", **conf) -> dict[str, DataFrame]:
    return company_pipeline().run(profile, {"source": source, **conf})
