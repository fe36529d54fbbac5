"""What role a name plays for a building, by adding up evidence: every role collects points from the words of the name, from
its shape, from the category that the source gives and from the kind of source; the role with most points wins.

A name is split into words once.  Each table below says what a word, a shape, a category or a source speaks for and how
strongly, so a new kind of evidence is a row, not a rule at the right place.  Shapes that nothing else can be (a plot number,
an advert) weigh most, the source that draws outlines weighs more than any word, and a single word found at a point is
too little to name anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rows import first_rows

# fixed values: the names of roles, sources and categories as they stand in the data
CANONICAL = ("BUILDING_NAME", "STRUCTURAL_ID", "PROJECT_NAME", "PLOT_ID", "ADDRESS")
ROLES = (*CANONICAL, "TENANT", "VENUE", "AMENITY", "INFRASTRUCTURE", "ADVERTISEMENT", "FRAGMENT", "PERSON")
OUTLINES = ("binding", "dld", "dld_unit", "dm_building", "osm", "osm_en", "overture", "register", "wikidata")
BUILDING_CATEGORIES = (
    "apartment_building", "apartment_complex", "building", "condominium_complex", "hotel", "housing_complex", "landmark_and_historical_building", "office_building", "premise", "residential_building", "resort_hotel", "shopping_mall", "subpremise",
)

_STRUCTURE = {"annex", "apartments", "block", "building", "court", "hall", "hotel", "house", "mall", "mansion", "palace", "plaza", "residence", "residences", "suites", "terrace", "tower", "towers", "villa", "villas"}
_LABELS = {"bldg", "block", "building", "cluster", "phase", "tower", "wing"}
_FOOD = {"bakery", "bar", "bistro", "brasserie", "cafe", "coffee", "diner", "eatery", "grill", "kitchen", "lounge", "pizzeria", "pub", "restaurant", "steakhouse", "tavern"}
_TRADE = {
    "academy", "agency", "bank", "barber", "boutique", "butcher", "cleaners", "cleaning", "clinic", "consultancy", "consultants", "contracting", "dentist", "exchange", "florist", "furniture", "garage", "grocery", "insurance", "laundry", "lawyers", "market",
    "nursery", "office", "optician", "pharmacy", "salon", "showroom", "stationery", "studio", "supermarket", "tailor", "tourism", "trading", "travel", "typing", "veterinary", "workshop",
}
_FACILITY = {"atm", "carpark", "concierge", "entrance", "gym", "kiosk", "lobby", "mosque", "parking", "playground", "pool", "reception", "toilet", "valet"}
_WORKS = {"bridge", "bus", "depot", "helipad", "interchange", "metro", "monorail", "pump", "railway", "sewage", "station", "substation", "tram", "tunnel"}
_STREET = {"avenue", "lane", "rd", "road", "st", "street"}
_PRAISE = {"amazing", "bedroom", "bhk", "brand-new", "cosy", "cozy", "fully", "furnished", "hosted", "lovely", "luxurious", "luxury", "rent", "sale", "spacious", "stunning", "view", "views"}
_TITLES = {"dr", "eng", "miss", "mr", "mrs", "ms", "prof"}
_CALLINGS = {"advisor", "agent", "architect", "broker", "coach", "consultant", "designer", "engineer", "instructor", "photographer", "realtor", "therapist", "trainer"}
_EMPTY = {"a", "an", "and", "co", "company", "dubai", "for", "fze", "group", "in", "limited", "llc", "ltd", "of", "the", "uae"}


def _words(name: Column) -> Column:
    return F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _count(words: Column, of: set[str]) -> Column:
    """How many words stand in the list."""
    return F.size(F.filter(words, lambda w: w.isin(sorted(of))))


def evidence(name: Column, source: Column, category: Column) -> list[tuple[str, float, Column]]:
    """(role, points, whether they are due)."""
    w = _words(name)
    n, kind = F.size(w), F.lower(F.coalesce(category, F.lit("")))
    last, first = F.try_element_at(w, F.lit(-1)), F.try_element_at(w, F.lit(1))
    numbers = F.size(F.filter(w, lambda x: x.rlike("^[0-9]+$")))
    coded = last.rlike("^[a-z]{0,2}[0-9]{1,4}[a-z]?$")
    lettered = F.size(F.filter(w, lambda x: x.rlike(r"^\p{L}{2,}")))
    food, trade, structure = _count(w, _FOOD), _count(w, _TRADE | _FOOD), _count(w, _STRUCTURE)
    inside = F.lower(name).rlike(r"\b(at|in|inside)\s+\S+\s+\S+|\b(at|in|inside)\s+the\s+\S+")
    praise = _count(w, _PRAISE) + F.when(F.lower(name).rlike(r"\b[0-9]+ ?(br|bhk|beds?|bedrooms?)\b|\|"), 2).otherwise(0)
    return [
        ("ADVERTISEMENT", 12, praise >= 2),
        ("FRAGMENT", 12, (n > 0) & (_count(w, _EMPTY) == n)),
        ("PERSON", 11, first.isin(*_TITLES) & (n > 1)),
        ("PERSON", 11, name.rlike(r"\s[-–]\s") & (_count(w, _CALLINGS) > 0)),
        ("PLOT_ID", 10, first.isin("plot", "parcel", "land") & (numbers > 0) & (lettered == 1)),
        ("ADDRESS", 9.5, (numbers > 0) & (_count(w, _STREET) > 0)),
        ("ADDRESS", 9.5, first.isin("house", "no", "unit", "villa") & (n > 1) & F.try_element_at(w, F.lit(2)).rlike("[0-9]")),
        ("STRUCTURAL_ID", 9, coded & ((n == 1) | ((n == 2) & first.isin(*_LABELS)) | ((n == 2) & first.rlike("^[a-z]{1,2}$")))),
        ("BUILDING_NAME", 6, source.isin(*OUTLINES)),
        ("PROJECT_NAME", 6.5, source == "projects"),
        ("AMENITY", 4, (_count(w, _FACILITY) > 0)),
        ("AMENITY", 4, kind.contains("parking")),
        ("INFRASTRUCTURE", 3.5, _count(w, _WORKS) > 0),
        ("INFRASTRUCTURE", 3.5, kind.rlike("transit|metro|bus_|train|station")),
        ("VENUE", 3, ((trade > 0) | kind.rlike("restaurant|bar")) & inside),
        ("TENANT", 2, (trade > 0) & ~inside),
        ("TENANT", 0.5, kind.rlike("store|shop|service|restaurant|bar|office") & ~kind.isin(*BUILDING_CATEGORIES)),
        ("VENUE", 0.4, food > 0),
        ("BUILDING_NAME", 2.2, structure > 0),
        ("BUILDING_NAME", 1.5, kind.isin(*BUILDING_CATEGORIES)),
        ("FRAGMENT", 1, (n == 1) & (numbers == 0) & ~coded),
    ]


def role_of(name: Column, source: Column, category: Column | None = None) -> Column:
    """The role of a name as a source gives it, with that source's category if it has one; ties go to the role named first in
    ROLES; UNKNOWN where nothing speaks, as for null and empty names."""
    name = F.trim(F.coalesce(name, F.lit("")))
    points = dict.fromkeys(ROLES, F.lit(0.0))
    for role, weight, due in evidence(name, F.coalesce(source, F.lit("")), F.lit(None).cast("string") if category is None else category):
        points[role] = points[role] + F.when(F.coalesce(due, F.lit(False)), F.lit(float(weight))).otherwise(0.0)
    ranked = F.array(*[F.struct(points[r].alias("points"), F.lit(-i).alias("place"), F.lit(r).alias("role")) for i, r in enumerate(ROLES)])
    best = F.array_max(ranked)
    return F.when((name == "") | (best["points"] <= 0), "UNKNOWN").otherwise(best["role"])


def eligible(role: Column) -> Column:
    """May a name of this role be what a building is called?"""
    return role.isin(*CANONICAL)


def parents(names: DataFrame, register: DataFrame, longest: int = 8) -> DataFrame:
    """a, parent: of names(a, name) the longest name of register(name) that stands in it in whole words and is not all of it
    (ties: the first in order); null if there is none.

    Runs of words are joined with the register's names, so a register of any size will do.  Case and marks do not count;
    register names of more than `longest` words are compared by their runs of that length and then in full.  A name that many
    rows have is looked up once."""
    known = register.select(F.col("name").alias("parent"), _words(F.col("name")).alias("full")).where(F.size("full") > 0).groupBy("full").agg(F.min("parent").alias("parent"))
    known = known.withColumn("run", F.slice("full", 1, longest))
    w = names.select("name").where("name IS NOT NULL").distinct().select("name", _words(F.col("name")).alias("w")).where(F.size("w") > 1)
    starts = w.select("name", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i"))
    upto = F.sequence(F.lit(1), F.least(F.lit(longest), F.size("w") - F.col("i") + 1))
    run = lambda k: F.struct(F.slice("w", F.col("i"), k).alias("run"), F.when(k == longest, F.slice("w", F.col("i"), F.size("w"))).alias("rest"))
    runs = starts.select("name", F.size("w").alias("n"), F.explode(F.transform(upto, run)).alias("r")).select("name", "n", "r.run", "r.rest")
    whole = (F.size("full") <= longest) | (F.slice("rest", F.lit(1), F.size("full")) == F.col("full"))
    held = runs.join(known, "run").where(whole & (F.size("full") < F.col("n"))).select("name", "parent", "full")
    best = first_rows(held, ["name"], [F.size("full").desc(), F.length("parent").desc(), F.col("parent")]).select("name", "parent")
    return names.select("a", "name").join(best, "name", "left").select("a", "parent")
