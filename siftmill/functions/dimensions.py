"""Small fixed dimensions: departments and regions, industries, classes of staff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Department code, region, department.
DEPARTMENTS = """
01; Auvergne-Rhône-Alpes; Ain
02; Hauts-de-France; Aisne
03; Auvergne-Rhône-Alpes; Allier
04; Provence-Alpes-Côte d'Azur; Alpes-de-Haute-Provence
05; Provence-Alpes-Côte d'Azur; Hautes-Alpes
06; Provence-Alpes-Côte d'Azur; Alpes-Maritimes
07; Auvergne-Rhône-Alpes; Ardèche
08; Grand Est; Ardennes
09; Occitanie; Ariège
10; Grand Est; Aube
11; Occitanie; Aude
12; Occitanie; Aveyron
13; Provence-Alpes-Côte d'Azur; Bouches-du-Rhône
14; Normandie; Calvados
15; Auvergne-Rhône-Alpes; Cantal
16; Nouvelle-Aquitaine; Charente
17; Nouvelle-Aquitaine; Charente-Maritime
18; Centre-Val de Loire; Cher
19; Nouvelle-Aquitaine; Corrèze
2A; Corse; Corse-du-Sud
2B; Corse; Haute-Corse
21; Bourgogne-Franche-Comté; Côte-d'Or
22; Bretagne; Côtes-d'Armor
23; Nouvelle-Aquitaine; Creuse
24; Nouvelle-Aquitaine; Dordogne
25; Bourgogne-Franche-Comté; Doubs
26; Auvergne-Rhône-Alpes; Drôme
27; Normandie; Eure
28; Centre-Val de Loire; Eure-et-Loir
29; Bretagne; Finistère
30; Occitanie; Gard
31; Occitanie; Haute-Garonne
32; Occitanie; Gers
33; Nouvelle-Aquitaine; Gironde
34; Occitanie; Hérault
35; Bretagne; Ille-et-Vilaine
36; Centre-Val de Loire; Indre
37; Centre-Val de Loire; Indre-et-Loire
38; Auvergne-Rhône-Alpes; Isère
39; Bourgogne-Franche-Comté; Jura
40; Nouvelle-Aquitaine; Landes
41; Centre-Val de Loire; Loir-et-Cher
42; Auvergne-Rhône-Alpes; Loire
43; Auvergne-Rhône-Alpes; Haute-Loire
44; Pays de la Loire; Loire-Atlantique
45; Centre-Val de Loire; Loiret
46; Occitanie; Lot
47; Nouvelle-Aquitaine; Lot-et-Garonne
48; Occitanie; Lozère
49; Pays de la Loire; Maine-et-Loire
50; Normandie; Manche
51; Grand Est; Marne
52; Grand Est; Haute-Marne
53; Pays de la Loire; Mayenne
54; Grand Est; Meurthe-et-Moselle
55; Grand Est; Meuse
56; Bretagne; Morbihan
57; Grand Est; Moselle
58; Bourgogne-Franche-Comté; Nièvre
59; Hauts-de-France; Nord
60; Hauts-de-France; Oise
61; Normandie; Orne
62; Hauts-de-France; Pas-de-Calais
63; Auvergne-Rhône-Alpes; Puy-de-Dôme
64; Nouvelle-Aquitaine; Pyrénées-Atlantiques
65; Occitanie; Hautes-Pyrénées
66; Occitanie; Pyrénées-Orientales
67; Grand Est; Bas-Rhin
68; Grand Est; Haut-Rhin
69; Auvergne-Rhône-Alpes; Rhône
70; Bourgogne-Franche-Comté; Haute-Saône
71; Bourgogne-Franche-Comté; Saône-et-Loire
72; Pays de la Loire; Sarthe
73; Auvergne-Rhône-Alpes; Savoie
74; Auvergne-Rhône-Alpes; Haute-Savoie
75; Île-de-France; Paris
76; Normandie; Seine-Maritime
77; Île-de-France; Seine-et-Marne
78; Île-de-France; Yvelines
79; Nouvelle-Aquitaine; Deux-Sèvres
80; Hauts-de-France; Somme
81; Occitanie; Tarn
82; Occitanie; Tarn-et-Garonne
83; Provence-Alpes-Côte d'Azur; Var
84; Provence-Alpes-Côte d'Azur; Vaucluse
85; Pays de la Loire; Vendée
86; Nouvelle-Aquitaine; Vienne
87; Nouvelle-Aquitaine; Haute-Vienne
88; Grand Est; Vosges
89; Bourgogne-Franche-Comté; Yonne
90; Bourgogne-Franche-Comté; Territoire de Belfort
91; Île-de-France; Essonne
92; Île-de-France; Hauts-de-Seine
93; Île-de-France; Seine-Saint-Denis
94; Île-de-France; Val-de-Marne
95; Île-de-France; Val-d'Oise
971; Guadeloupe; Guadeloupe
972; Martinique; Martinique
973; Guyane; Guyane
974; La Réunion; La Réunion
975; Saint-Pierre-et-Miquelon; Saint-Pierre-et-Miquelon
976; Mayotte; Mayotte
977; Saint-Barthélemy; Saint-Barthélemy
978; Saint-Martin; Saint-Martin
984; Terres australes et antarctiques françaises; Terres australes et antarctiques françaises
986; Wallis-et-Futuna; Wallis-et-Futuna
987; Polynésie française; Polynésie française
988; Nouvelle-Calédonie; Nouvelle-Calédonie
989; Îles Éparses; Îles Éparses
"""
# Industry of a two-digit activity code.
INDUSTRIES = """
01 Farming
02 Farming
10 Food & Beverage
11 Food & Beverage
14 Textiles
16 Consumer Goods
17 Paper & Forest Products
20 Chemicals
23 Building Materials
24 Metals & Mining
25 Industrial Machinery
26 Information Technology & Services
27 Electrical & Electronic Manufacturing
28 Industrial Machinery
29 Automotive
30 Transportation & Logistics
31 Consumer Goods
32 Medical Devices
33 Industrial Services
35 Utilities
36 Utilities
38 Environmental Services
41 Construction
42 Construction
43 Construction
45 Automotive
46 Wholesale
47 Retail
49 Transportation & Logistics
52 Transportation & Logistics
55 Hospitality
56 Food & Beverage
58 Media & Publishing
59 Media & Entertainment
60 Media & Broadcasting
61 Telecommunications
62 Information Technology & Services
63 Information Technology & Services
64 Financial Services
65 Financial Services
66 Financial Services
68 Real Estate
69 Legal Services
70 Management Consulting
71 Architecture & Planning
72 Research
73 Marketing & Advertising
74 Professional Services
75 Veterinary
77 Leisure, Travel & Tourism
78 Staffing & Recruiting
79 Leisure, Travel & Tourism
80 Security & Investigations
81 Facilities Services
82 Business Supplies & Equipment
84 Government Administration
85 Education Management
86 Hospital & Health Care
87 Hospital & Health Care
88 Nonprofit Organization Management
90 Entertainment
91 Museums & Institutions
92 Gambling & Casinos
93 Sports & Recreation
94 Civic & Social Organization
95 Consumer Services
96 Consumer Services
"""
# Class of a staff code.
STAFF_CODES = """
00 1-10, 0 1-10, 01 1-10, 1 1-10, 02 1-10, 2 1-10, 03 1-10, 3 1-10, 11 11-50, 12 11-50, 13 11-50, 21 51-200, 22 51-200, 23 51-200,
31 201-500, 32 201-500, 33 201-500, 41 501-1000, 42 1001-5000, 43 1001-5000, 51 1001-5000, 52 5001-10000, 53 10000+, NN 1-10
"""
# Sector of a full activity code.
SECTORS = """
technology 6201Z 6202A 6209Z 6311Z 6312Z
healthcare 8610Z 8621Z 8622A 8690A 8690B
finance 6411Z 6419Z 6420Z 6430Z 6492Z
retail 4711A 4719A 4771Z 4772A 4774Z
construction 4120A 4120B 4211Z 4212Z 4213A
professional_services 6920Z 6910Z 7022Z 7111Z 7112A
"""
# First two digits of a number, and the departments it serves.
AREAS = """
01 75 77 78 91 92 93 94 95
02 02 14 18 22 27 28 29 35 36 37 39 41 44 45 49 50 53 56 58 60 61 76 79 80
03 08 10 21 25 39 51 52 54 55 57 58 59 60 62 67 68 70 71 88 89 90
04 01 03 04 06 07 11 12 13 15 16 17 19 23 24 26 30 31 32 33 34 38 40 42 43 46 47 48 63 64 65 66 69 70 71 73 74 81 82 84 87
05 09 11 12 15 16 17 19 23 24 31 32 33 40 46 47 48 63 64 65 66 79 81 82 86 87
09 09
"""
# Overseas departments and the first digits of their numbers.
OVERSEAS = "971 0590 0591, 972 0596, 973 0594, 974 0262, 975 0508, 976 0269, 977 0590, 978 0590, 986 0689, 987 0089 0189 0589 0989, 988 0542 0568 0584 0593"


def area_fits(phone: Column, code: Column) -> Column:
    """Does a number begin as those of the department (or of the postal code) do?"""
    served: dict[str, list[str]] = {}
    for area, *codes in (line.split() for line in AREAS.strip().splitlines()):
        for c in codes:
            served.setdefault(c, []).append(area)
    served |= {c: areas for c, *areas in (x.split() for x in OVERSEAS.split(", "))}
    d = F.regexp_replace(F.regexp_replace(F.regexp_replace(phone, r"\D", ""), "^0033", ""), "^33", "")
    n = F.when(d.startswith("0"), d).otherwise(F.concat(F.lit("0"), d))
    t = F.regexp_extract(F.upper(F.trim(code)), r"(\d+)", 1)
    key = F.when(F.upper(F.trim(code)).isin("2A", "2B"), "20").when(t.rlike("^9[78]"), F.substring(t, 1, 3)).otherwise(F.substring(t, 1, 2))
    areas = F.create_map(*[x for k, v in served.items() for x in (F.lit(k), F.array(*[F.lit(a) for a in v]))])[key]
    return F.coalesce((d != "") & F.exists(areas, lambda a: n.startswith(a)), F.lit(False))


def departments(spark: SparkSession) -> DataFrame:
    """(code, region, department): a fixed list, small enough to be sent to every task."""
    return spark.createDataFrame([tuple(line.split("; ")) for line in DEPARTMENTS.strip().splitlines()], "code string, region string, department string")


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def industry(naf: Column) -> Column:
    """Industry of an activity code by its first two digits, or null."""
    pairs = dict(line.split(" ", 1) for line in INDUSTRIES.strip().splitlines())
    return _map(pairs)[F.substring(F.regexp_replace(naf, r"[\s.]", ""), 1, 2)]


def sector(naf: Column) -> Column:
    """Sector of a full activity code, or null."""
    pairs = {code: name for name, *codes in (line.split() for line in SECTORS.strip().splitlines()) for code in codes}
    return _map(pairs)[F.upper(F.regexp_replace(naf, r"[\s.]", ""))]


def staff_class(code: Column) -> Column:
    """Class of a staff code, or null."""
    pairs = {k: v for k, v in (x.split() for x in STAFF_CODES.replace("\n", " ").split(",") if x.strip())}
    return _map(pairs)[F.trim(code)]


def region_of(code: Column) -> Column:
    """`region / department` of a department code; other codes are named as such."""
    pairs = {c: f"{region} / {name}" for c, region, name in (line.split("; ") for line in DEPARTMENTS.strip().splitlines())}
    return F.coalesce(_map(pairs)[code], F.concat(F.lit("Département "), code))
