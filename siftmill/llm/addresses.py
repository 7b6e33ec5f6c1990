"""Same postal address written differently.

Method: addresses are parsed into components; multi-pass sorted neighbourhoods
order the distinct component tuples by differing component orders, windows are
compared by edit distance with a transposition-tolerant score, and commune,
house number and suffix must agree strictly.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, spread

# Way types and their abbreviations.
WAYS = {
    "RUE": "R RUE", "AVENUE": "AV AVE AVENUE", "BOULEVARD": "BD BVD BLD BOUL BOULEVARD", "PLACE": "PL PLACE", "CHEMIN": "CH CHE CHEM CHEMIN",
    "IMPASSE": "IMP IMPASSE", "ALLEE": "ALL ALLEE", "SQUARE": "SQ SQUARE", "COURS": "CRS COURS", "FAUBOURG": "FG FBG FAUBOURG", "QUAI": "Q QU QUAI",
    "ROUTE": "RTE ROUTE", "PASSAGE": "PSGE PASS PAS PASSAGE", "VOIE": "VOIE", "SENTIER": "SEN SENTE SENTIER", "RUELLE": "RLE RUELLE", "ESPLANADE": "ESP ESPLANADE",
}
# Kinds of named places.
PLACES = {
    "LIEUDIT": r"LIEU ?DIT|LDT|L ?D", "ZAC": r"Z ?A ?C|ZONE D AMENAGEMENT CONCERTE", "ZC": r"Z ?C|ZONE COMMERCIALE", "ZA": r"Z ?A|ZONE ARTISANALE|ZONE D ACTIVITES?",
    "ZI": r"Z ?I|ZONE INDUSTRIELLE", "PARC": r"PARC D ACTIVITES?|PARC D ACT|P ?A", "HAMEAU": r"HAMEAU|HAM", "CCIAL": r"CENTRE COMMERCIAL|C CIAL",
}
# Abbreviations inside way names, and words that carry no meaning there.
WORDS = {
    "DR": "DOCTEUR", "PR": "PROFESSEUR", "PROF": "PROFESSEUR", "MAL": "MARECHAL", "GAL": "GENERAL", "GEN": "GENERAL", "CNE": "CAPITAINE", "CAPT": "CAPITAINE", "CAP": "CAPITAINE",
    "PDT": "PRESIDENT", "PRES": "PRESIDENT", "CDT": "COMMANDANT", "COL": "COLONEL", "LT": "LIEUTENANT", "ST": "SAINT", "STE": "SAINTE", "GD": "GRAND", "GDS": "GRANDS", "GDE": "GRANDE",
    "PT": "PETIT", "PTS": "PETITS", "PTE": "PETITE", "VX": "VIEUX", "2": "DEUX", "3": "TROIS", "4": "QUATRE", "5": "CINQ", "6": "SIX", "7": "SEPT", "8": "HUIT", "9": "NEUF", "FME": "FERME",
}
ARTICLES = {"DE", "DU", "DES", "LA", "LE", "LES", "L", "D", "A", "AU", "AUX", "EN"}
SUFFIXES = {"BIS": "BIS", "TER": "TER", "QUATER": "QUATER", "B": "BIS", "T": "TER"}

_WAY_WORDS = "|".join(sorted({a for v in WAYS.values() for a in v.split()}))
_UNIT = re.compile(
    r"\b(?:BP|CS|TSA) ?\d+|\bCEDEX\b(?: \d{1,2}\b(?! ?,? ?(?:BIS|TER|QUATER|%s)\b))?|\b(?:\d+ ?E(?:R|ME)?|REZ DE CHAUSSEE|RDC) ?(?:ETAGE|ETG)\b|\b(?:ETAGE|ETG) ?\d+|\bRDC\b"
    r"|\b(?:BAT|BATIMENT|ESC|ESCALIER|APPT|APT|APPARTEMENT|HALL|PORTE|BOITE|LOT|ENTREE) (?:[A-Z]|\d{1,4})\b"
    r"|\b(?:ADRESSE POSTALE|ADRESSE|SIEGE SOCIAL|SIEGE|SITE)\b ?:?".replace("%s", _WAY_WORDS)
)
_COUNTRY = re.compile(r"\(?\b(?:FRANCE|FR)\b\)?\s*$")
_CP = re.compile(r"\b(\d{2}) ?(\d{3})\b(?!\s*(?:BIS|TER)\b)")
_NUM = re.compile(r"(?:\bN ?° ?|\bNO? )?\b(\d{1,4}) ?(BIS|TER|QUATER|[BT](?= (?:%s)\b))?\b" % _WAY_WORDS)
_WAY_OF = {a: k for k, v in WAYS.items() for a in v.split()}
_PLACE = {k: re.compile(rf"^(?:{v})\b ?") for k, v in PLACES.items()}
# Building names are known words; without a separator they end there.
_HOUSE_WORDS = re.compile(r"\b(?:RES|RESIDENCE|IMM|IMMEUBLE)\b\.? (?:LES|LE|LA|L|DES|DU|DE LA)? ?\w+")


def plain(text: str) -> str:
    """Upper case without accents; hyphens inside words and points become blanks."""
    t = unicodedata.normalize("NFKD", text.replace("œ", "oe").replace("Œ", "OE")).upper()
    t = "".join(c for c in t if not unicodedata.combining(c))
    return re.sub(r"[.'’`\"]", " ", t)


def within(a: str, b: str, most: int = 1) -> bool:
    """Edit distance with adjacent transpositions of at most `most` (1 or 2)?"""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    i = 0
    while i < len(a) and i < len(b) and a[i] == b[i]:
        i += 1
    j = 0
    while j < len(a) - i and j < len(b) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    x, y = a[i : len(a) - j], b[i : len(b) - j]
    if len(x) <= 1 and len(y) <= 1:
        return True
    if len(x) == 2 and len(y) == 2 and x == y[::-1]:
        return True
    if most == 1:
        return False
    rows = [list(range(len(y) + 1))]
    for p, c in enumerate(x, 1):
        row = [p]
        for q, d in enumerate(y, 1):
            v = min(rows[-1][q] + 1, row[-1] + 1, rows[-1][q - 1] + (c != d))
            if p > 1 and q > 1 and c == y[q - 2] and x[p - 2] == d:
                v = min(v, rows[-2][q - 2] + 1)
            row.append(v)
        rows.append(row)
    return rows[-1][-1] <= most


class Communes:
    """Commune names by postal code; finds a commune at the edge of an address."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.of_code: dict[str, str] = {}
        self.names: dict[str, str] = {}
        for code, name in rows:
            key = commune_key(name)
            if not key:
                continue
            if code:
                self.of_code.setdefault(code, key)
            self.names[key] = key
        for key in list(self.names):
            short = key.split(" SUR ")[0].split(" SOUS ")[0].split(" LES ")[0]
            if short != key:
                self.names.setdefault(short, key)
        self.longest = max((len(k.split()) for k in self.names), default=1)
        # Names by what is left when one letter is dropped: any name one typo away shares an entry.
        self.less: dict[str, list[str]] = {}
        for k in self.names:
            for x in _dropped(k):
                self.less.setdefault(x, []).append(k)
        self.tight: dict[str, str] = {}
        for k in self.names:
            self.tight.setdefault(k.replace(" ", ""), k)
        self.memo: dict[str, str] = {}

    def match(self, text: str) -> str:
        """The commune that `text` (upper case words) names, one typo allowed, or ''."""
        got = self.memo.get(text)
        if got is None:
            got = self.names.get(text, "")
            if not got and len(text) >= 5:
                near = {k for x in _dropped(text) for k in self.less.get(x, ()) if within(text, k)}
                got = self.names[min(near, key=lambda k: (len(k), k))] if near else ""
            if len(self.memo) < 200_000:
                self.memo[text] = got
        return got


def _dropped(text: str) -> set[str]:
    """The text, and the text without any one of its letters."""
    return {text, *(text[:i] + text[i + 1 :] for i in range(len(text)))}


def commune_key(name: str | None) -> str:
    t = re.sub(r"[^A-Z0-9/ ]+", " ", plain(name or ""))
    t = re.sub(r"\bS/ ?", "SUR ", t)
    t = re.sub(r"\bST\b", "SAINT", re.sub(r"\bSTE\b", "SAINTE", t))
    t = re.sub(r"\bCEDEX\b.*", "", t.replace("/", " "))
    return " ".join(t.split())


def parse(text: str | None, code: str | None, commune: str | None, towns: Communes) -> tuple | None:
    """(commune, number, suffix, type, name) of one address, or None where it is no address.

    Named places have number ''. `code` and `commune` are the record's own columns,
    if it has any; what the text says itself goes first.
    """
    if not text or not text.strip() or "RENSEIGNE" in text.upper() or text.strip().lower() in ("nan", "none", "null"):
        return None
    t = plain(text)
    t = re.sub(r"\bS/ ?", "SUR ", t)
    t = re.sub(r"[–—·|;]", ",", t).replace(" - ", " , ").replace("\n", " , ")
    t = re.sub(r"\b[NA]°", "N°", t).replace("º", "°")
    t = re.sub(r"-", " ", t)
    t = re.sub(r"[ \t\xa0]+", " ", t)
    t = _COUNTRY.sub("", t.strip(" ,"))
    t = re.sub(r"\(\s*FR(?:ANCE)?\s*\)", "", t)
    t = _UNIT.sub(" ", t)
    t = _HOUSE_WORDS.sub(" ", t)
    t = re.sub(r"[()]", " ", t)
    found = None
    m = _CP.search(t)
    if m:
        found = m.group(1) + m.group(2)
        t = t[: m.start()] + " , " + t[m.end() :]
    else:
        m = re.search(r"(?<![\w°] )(?<!\w)\b(\d{4})\b(?= [A-Z])", t)
        if m and "0" + m.group(1) in towns.of_code and towns.match(" ".join(t[m.end() :].replace(",", " ").split()[:1])) + "x" != "x":
            found = "0" + m.group(1)
            t = t[: m.start()] + " , " + t[m.end() :]
    code = re.sub(r"\D", "", code or "")
    code = code.zfill(5) if len(code) == 4 else code
    town = towns.of_code.get(found or "", "")
    own = commune_key(commune)
    parts = [" ".join(p.split()) for p in t.split(",")]
    parts = [p for p in parts if p]
    # A part that is a commune goes; else a commune may end (or begin) a part.
    named = ""
    rest = []
    for p in parts:
        hit = towns.match(commune_key(p))
        if hit and (not named or hit == named) and p.split()[0] not in _WAY_OF:
            named = named or hit
        else:
            rest.append(p)
    if not named and rest:
        expect = town or towns.of_code.get(code, "") or towns.names.get(own, "")
        for where in (-1, 0) if len(rest) > 1 else (-1,):
            words = rest[where].split()
            for n in range(min(towns.longest, len(words) - 1), 0, -1):
                tail = words[-n:]
                hit = towns.match(commune_key(" ".join(tail)))
                if hit and (hit == expect or not expect or found):
                    named = hit
                    rest[where] = " ".join(words[:-n])
                    break
            if named:
                break
        if not named and rest:
            words = rest[0].split()
            for n in range(min(towns.longest, len(words) - 1), 0, -1):
                hit = towns.match(commune_key(" ".join(words[:n])))
                if hit and (hit == expect or not expect):
                    named, rest[0] = hit, " ".join(words[n:])
                    break
    place = town or named or towns.of_code.get(code, "") or towns.names.get(own, own) or found or code
    if not place:
        return None
    rest = [p for p in rest if p]
    # Free text without any commune or code is no address.
    named_here = bool(named or found or code or own)
    body = " , ".join(rest)
    for kind, rx in _PLACE.items():
        for p in rest:
            m = rx.match(p)
            if m:
                name = _name(p[m.end() :])
                if name:
                    return place, "", "", kind, name
    number = suffix = ""
    best = None
    for m in _NUM.finditer(body):
        explicit = "°" in m.group(0) or m.start() == 0 or body[: m.start()].rstrip().endswith(",")
        alone = body[m.end() :].lstrip()[:1] in (",", "")
        nxt = body[m.end() :].lstrip(" ,").split(" ")[0]
        before = body[: m.start()].split()
        inner = before and before[-1] in ARTICLES | set(_WAY_OF)
        score = 2 * explicit + alone + 3 * (nxt in _WAY_OF) - 3 * bool(inner and not alone) + ("°" in m.group(0)) * 3
        if best is None or score > best[0]:
            best = (score, m)
    if best and best[0] > -2:
        m = best[1]
        number, suffix = m.group(1).lstrip("0") or "0", SUFFIXES.get(m.group(2) or "", "")
        body = body[: m.start()] + " , " + body[m.end() :]
    kind = ""
    words = body.replace("°", " ").split()
    for i, w in enumerate(words):
        if w in _WAY_OF and (i == 0 or words[i - 1] == "," or kind == ""):
            kind = _WAY_OF[w]
            words = words[i + 1 :]
            break
    chunk: list[str] = []
    for w in words:
        if w == ",":
            if chunk:
                break
        else:
            chunk.append(w)
    name = _name(" ".join(chunk))
    if not number and not kind and name and named_here and not re.search(r"\d", name):
        return place, "", "", "LIEUDIT", name
    if not name or not number:
        return None
    return place, number, suffix, kind, name


def _name(text: str) -> str:
    words = re.sub(r"[^A-Z0-9 ]+", " ", text).split()
    return " ".join(WORDS.get(w, w) for w in words if w not in ARTICLES or len(words) == 1)


_KNOWN = set(WORDS.values())


def same_name(a: str, b: str, typo: bool = True) -> bool:
    """Same way name: word order free, initials for first names, one typo in all.

    Titles and known words (SAINT and SAINTE, GRAND and GRANDS) never pass as typos
    of each other.
    """
    x, y = a.split(), b.split()
    if sorted(x) == sorted(y):
        return True
    if len(x) != len(y):
        return typo and within("".join(x), "".join(y)) and not (set(x) ^ set(y)) & _KNOWN
    x, y = list(x), list(y)
    for w in list(x):
        if w in y:
            x.remove(w)
            y.remove(w)
    edits = 0
    for w in sorted(x, key=len, reverse=True):
        near = [v for v in y if typo and len(w) > 3 and len(v) > 3 and within(w, v) and not (w in _KNOWN and v in _KNOWN)]
        if near:
            edits += 1
            y.remove(near[0])
            continue
        short = [v for v in y if (len(v) == 1 or len(w) == 1) and v[0] == w[0]]
        if not short:
            return False
        y.remove(short[0])
    return edits <= 1


@dataclass(frozen=True)
class AddressConf:
    """window: neighbours compared on each side of a pass. max_communes: bound of the
    commune dictionary that is sent to every task (a country has below 40,000). dirty:
    how many times rarer a commune's misspelling is. rarer: how many times fewer places
    a name's misspelling has, where the two do not mostly stand side by side."""

    window: int = 10
    max_communes: int = 100_000
    dirty: int = 20
    rarer: int = 5
    chunk: int = 500


def commune_dictionary(df: DataFrame, code: str, commune: str, conf: AddressConf) -> list[tuple[str, str]]:
    """(postal code, commune) pairs, most frequent first; its size is checked.

    A spelling goes where its code has one with `conf.dirty` times as many rows: a
    ratio, so the answer does not change when the same rows come more often.
    """
    c = F.regexp_replace(F.col(code), r"\s", "")
    pairs = df.filter(F.trim(commune) != "").select(F.when(c.rlike(r"^\d{4,5}$"), F.lpad(c, 5, "0")).alias("c"), F.upper(F.trim(commune)).alias("t")).groupBy("c", "t").agg(F.count("*").alias("n"))
    most = pairs.groupBy("c").agg(F.max("n").alias("m"))
    kept = pairs.join(most, "c", "left").filter(F.col("c").isNull() | (F.col("n") * conf.dirty >= F.col("m"))).select("c", "t", "n")
    rows = kept.orderBy(F.desc("n"), "c", "t").limit(conf.max_communes + 1).collect()
    if len(rows) > conf.max_communes:
        raise ValueError("more communes than a country has; clean the commune column first")
    return [(r["c"], r["t"]) for r in rows]


def parse_addresses(records: DataFrame, towns: list[tuple[str, str]]) -> DataFrame:
    """records (id, text, code, commune) -> (id, commune, number, suffix, kind, name).

    Null, blank and placeholder texts and entries that are no address give no row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = Communes(towns)
        for b in batches:
            memo: dict[tuple, tuple | None] = {}
            out = []
            for i, key in zip(b["id"], zip(b["text"], b["code"], b["commune"])):
                if key not in memo:
                    memo[key] = parse(*key, book)
                if memo[key]:
                    out.append((i, *memo[key]))
            yield pd.DataFrame(out, columns=["id", "commune", "number", "suffix", "kind", "name"], dtype=str)

    return records.select("id", "text", "code", "commune").mapInPandas(run, "id string, commune string, number string, suffix string, kind string, name string")


def _tokens(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, " ")), " ")


def neighbour_pairs(keys: DataFrame, conf: AddressConf) -> DataFrame:
    """Candidate pairs of distinct component tuples from sorted neighbourhoods.

    Five passes order the tuples by differing component orders. Commune, number and
    suffix must agree in any match, so every pass sorts within them and a window
    never spans two house numbers. Where a house number has more tuples than a window
    holds, those that share a spelling with one letter dropped, or with one word cut to
    its initial, meet as well, so that no typo is out of reach.
    """
    orders = {
        "forward": ["name", "kind"],
        "backward": [F.reverse("name"), "kind"],
        "words": [_tokens(F.col("name")), "kind"],
        "last": [F.element_at(F.split("name", " "), -1), "name", "kind"],
        "way": ["kind", F.reverse("name")],
    }
    at = ["commune", "number", "suffix"]
    me = F.struct("kind", "name", "n")
    out = None
    for order in orders.values():
        w = Window.partitionBy(*at).orderBy(*order, "kind", "name").rowsBetween(-conf.window, -1)
        pairs = keys.select(*at, me.alias("a"), F.collect_list(me).over(w).alias("near")).select(*at, "a", F.explode("near").alias("b"))
        out = pairs if out is None else out.unionByName(pairs)
    crowded = keys.groupBy(*at).agg(F.count("*").alias("_n")).filter(F.col("_n") > conf.window + 1).drop("_n")
    spelt = keys.join(crowded, at, "left_semi").select(*at, me.alias("a"), F.explode(F.array_distinct(F.concat(_shortened("name"), _shortened(_tokens(F.col("name"))), _initialled("name")))).alias("v"))
    out = out.unionByName(spelt.join(spelt.withColumnRenamed("a", "b"), [*at, "v"]).filter(F.col("a") < F.col("b")).select(*at, "a", "b"))
    a, b = F.col("a.name"), F.col("b.name")
    ok = (F.col("a.kind") == F.col("b.kind")) | (F.col("a.kind") == "") | (F.col("b.kind") == "")
    near = (F.levenshtein(a, b, 2) >= 0) | (F.levenshtein(_tokens(a), _tokens(b), 2) >= 0) | F.concat_ws(" ", a, b).rlike(r"(^| )[A-Z]( |$)")
    ordered = F.col("a") < F.col("b")
    return out.filter(ok & near).select(*at, F.when(ordered, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(ordered, F.col("b")).otherwise(F.col("a")).alias("b")).distinct()


def _shortened(c) -> Column:
    """A text and the texts with one of its letters dropped."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda i: F.concat(F.substr(c, F.lit(1), i - 1), F.substr(c, i + 1))))


def _initialled(name: str) -> Column:
    """The texts in which one word is cut to its first letter."""
    words = F.split(name, " ")
    return F.transform(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_join(F.transform(words, lambda w, k: F.when(k == i, F.substr(w, F.lit(1), F.lit(1))).otherwise(w)), " "))


def same_locations(parsed: DataFrame, conf: AddressConf = AddressConf()) -> DataFrame:
    """(id, location): one row per parsed address with the class it belongs to.

    Exact copies share a tuple and are never compared. A tuple with a typo joins the
    best supported neighbour; a tuple without a way type joins the one that has it. A
    name's support is the number of its places (commune, number, suffix), not of its
    rows. Two names one typo apart are one if the rarer has `conf.rarer` times fewer
    places, or if at half of its places at least the other stands beside it; copies of
    rows change neither.
    """
    at = ["commune", "number", "suffix"]
    keys = parsed.select(*at, "kind", "name").distinct()
    popular = keys.select(*at, "name").distinct().groupBy("name").agg(F.count("*").alias("n"))
    keys = cut(keys.join(popular, "name"))

    @F.pandas_udf("int")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([2 if same_name(x, y, False) else 1 if same_name(x, y) else 0 for x, y in zip(a, b)], dtype="int32")

    pairs = cut(neighbour_pairs(keys, conf).withColumn("like", alike(F.col("a.name"), F.col("b.name"))).filter("like > 0"))
    few, many = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    lo, hi = F.least("a.name", "b.name").alias("lo"), F.greatest("a.name", "b.name").alias("hi")
    beside = pairs.filter("like = 1").select(*at, lo, hi).distinct().groupBy("lo", "hi").agg(F.count("*").alias("together"))
    typos = pairs.filter("like = 1").withColumns({"lo": lo, "hi": hi}).join(beside, ["lo", "hi"]).filter((few * conf.rarer <= many) | (2 * F.col("together") >= few))
    pairs = pairs.filter("like = 2").select(*at, "a", "b").unionByName(typos.select(*at, "a", "b"))
    both = pairs.unionByName(pairs.select(*at, F.col("b").alias("a"), F.col("a").alias("b")))
    rank = lambda p: F.struct(F.col(f"{p}.kind") != "", F.col(f"{p}.n"), F.col(f"{p}.kind"), F.col(f"{p}.name"))
    best = both.groupBy(*at, "a").agg(F.max(F.struct(rank("b").alias("r"), F.col("b"))).alias("m"))
    best = best.filter(F.col("m.r") > rank("a")).select(*at, F.col("a.kind").alias("kind"), F.col("a.name").alias("name"), F.col("m.b.kind").alias("k1"), F.col("m.b.name").alias("n1"))
    best = cut(best)
    while True:  # ranks rise along a chain: pointers are followed upwards until none moves
        up = best.select(*at, F.col("kind").alias("k1"), F.col("name").alias("n1"), F.col("k1").alias("k2"), F.col("n1").alias("n2"))
        moved = cut(best.join(up, [*at, "k1", "n1"], "left").select(*at, "kind", "name", F.coalesce("k2", "k1").alias("k1"), F.coalesce("n2", "n1").alias("n1"), F.col("n2").isNotNull().alias("moved")))
        best = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            break
    located = parsed.join(best, [*at, "kind", "name"], "left")
    return located.select("id", F.concat_ws("|", *at, F.coalesce("k1", "kind"), F.coalesce("n1", "name")).alias("location"))


def address_classes(records: DataFrame, towns: list[tuple[str, str]], conf: AddressConf = AddressConf()) -> DataFrame:
    """(id, location, links): one row per address record with its class and the number of its other members."""
    located = cut(same_locations(cut(parse_addresses(spread(records, "id"), towns)), conf))
    sizes = located.groupBy("location").agg((F.count("*") - 1).alias("links"))
    return located.join(sizes, "location").select("id", "location", "links")


def pairs_within(members: DataFrame, group: str, left: str, right: str, chunk: int = 500, keep: Column | None = None) -> DataFrame:
    """All pairs left < right of ids within a group; large groups are salted in chunks."""
    sized = members.join(members.groupBy(group).agg(F.count("*").alias("_n")).filter("_n > 1"), group)
    salts = F.greatest(F.lit(1), F.ceil(F.col("_n") / chunk)).cast("int")
    a = sized.select(group, F.col("id").alias(left), F.pmod(F.xxhash64("id"), salts).cast("int").alias("_s"), *[F.col(c).alias(f"a_{c}") for c in members.columns if c not in (group, "id")])
    b = sized.select(group, F.col("id").alias(right), F.explode(F.sequence(F.lit(0), salts - 1)).alias("_s"), *[F.col(c).alias(f"b_{c}") for c in members.columns if c not in (group, "id")])
    joined = a.join(b, [group, "_s"]).filter(F.col(left) < F.col(right))
    if keep is not None:
        joined = joined.filter(keep)
    return joined.select(left, right)


def address_records(standardize: DataFrame, maps: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, text, code, commune) of the three tables' address records."""
    none = F.lit(None).cast("string")
    s = standardize.select(F.concat(F.lit("standardize:"), F.col("row_id"), F.lit(":1")).alias("id"), F.col("adresse").alias("text"), F.col("code_postal").alias("code"), F.col("commune").alias("commune"))
    m = maps.select(F.concat(F.lit("maps_scraper:"), F.col("maps_id"), F.lit(":1")).alias("id"), F.col("address_complete").alias("text"), none.alias("code"), none.alias("commune"))
    p = pages.select("extraction_id", F.posexplode("addresses").alias("pos", "text")).select(
        F.concat(F.lit("page_extraction:"), F.col("extraction_id"), F.lit(":"), (F.col("pos") + 1)).alias("id"), "text", none.alias("code"), none.alias("commune")
    )
    return s.unionByName(m).unionByName(p)


def same_address(records: DataFrame, towns: list[tuple[str, str]], conf: AddressConf = AddressConf()) -> DataFrame:
    """(addr_a, addr_b): all pairs of address records of the same location, addr_a < addr_b.

    An empty table gives no pair; repeated rows pair with each other; ties between
    equally supported spellings go to the greater spelling; extra columns are ignored.
    """
    parsed = cut(parse_addresses(spread(records, "id"), towns))
    return pairs_within(same_locations(parsed, conf), "location", "addr_a", "addr_b", conf.chunk)
