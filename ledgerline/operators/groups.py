"""Groups of register entities by evidence: names that carry an alias, projects of a portfolio, decisions by hand; and the
attribution of sales to groups.

Everything is joins on words and ids: an alias of any number of words is looked up among the word runs of a name, so neither
aliases nor names are compared pair by pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(x: Column) -> Column:
    """The words of a text: runs of letters and digits, lower case."""
    return F.filter(F.split(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def carried(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """id, grp, alias, lead for names(id, name) that hold an alias of aliases(grp, alias) in whole words; lead: the alias has
    several words or begins the name.  The longest alias, in words, bounds the runs that a name is cut into."""
    known = aliases.select("grp", "alias", words(F.col("alias")).alias("run")).where(F.size("run") > 0).distinct()
    sizes = [r[0] for r in known.select(F.size("run")).distinct().collect()]  # a few numbers
    w = names.select("id", words(F.col("name")).alias("w")).where(F.size("w") > 0)
    at = w.select("id", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i"))
    runs = at.select("id", "i", F.size("w").alias("n"), F.explode(F.array(*[F.slice("w", F.col("i"), F.lit(n)) for n in sizes]) if sizes else F.array().cast("array<array<string>>")).alias("run"))
    hit = runs.join(known, "run")
    return hit.groupBy("id", "grp", "alias").agg(F.max((F.size("run") > 1) | (F.col("i") == 1)).alias("lead"))


def portfolio(seeds: DataFrame, projects: DataFrame, aliases: DataFrame) -> DataFrame:
    """grp, dev, projects, branded: how many registered projects(cid, name, dev) of a developer stand in the portfolio
    seeds(grp, name) of a group.  A seed counts where one project has its name, or several have it and the seed carries an
    alias of the group; `branded` counts projects of such seeds alone."""
    s = seeds.select("grp", words(F.col("name")).alias("k"), F.col("name")).where(F.size("k") > 0).distinct()
    p = projects.where("dev IS NOT NULL").select("cid", "dev", words(F.col("name")).alias("k"))
    several = projects.select("cid", words(F.col("name")).alias("k")).groupBy("k").agg(F.countDistinct("cid").alias("n"))
    own = carried(s.select(F.struct("grp", "name").alias("id"), "name"), aliases).where("id.grp = grp").select(F.col("id.grp").alias("grp"), F.col("id.name").alias("name")).distinct().withColumn("brand", F.lit(True))
    hit = s.join(several, "k").join(own, ["grp", "name"], "left").where((F.col("n") == 1) | F.col("brand")).join(p, "k")
    return hit.groupBy("grp", "dev").agg(F.countDistinct("cid").alias("projects"), F.countDistinct(F.when(F.col("brand"), F.col("cid"))).alias("branded"))


def grouped(developers: DataFrame, aliases: DataFrame, seeds: DataFrame, projects: DataFrame, hand: DataFrame) -> DataFrame:
    """grp, dev, method, score, status, decided_by for developers(dev, name) that anything ties to a group.

    The first rule that fits decides: the register's name leads with an alias, the name holds one inside and the portfolio has
    projects, the portfolio has at least two and half of the developer's projects, or one that is titled with the brand and
    half; what only one weak sign ties goes to review.  Decisions hand(grp, dev, verdict) win.  A developer that rules give to
    several groups goes to review in all."""
    named = carried(developers.select(F.col("dev").alias("id"), "name"), aliases).groupBy("grp", F.col("id").alias("dev")).agg(F.max("lead").alias("lead"), F.lit(True).alias("hit"))
    owned = projects.where("dev IS NOT NULL").groupBy("dev").agg(F.countDistinct("cid").alias("all"))
    tied = named.join(portfolio(seeds, projects, aliases), ["grp", "dev"], "full").join(hand.select("grp", "dev", F.col("verdict")), ["grp", "dev"], "full").join(developers.select("dev"), "dev", "left_semi").join(owned, "dev", "left")
    b, bb = F.coalesce("projects", F.lit(0)), F.coalesce("branded", F.lit(0))
    share = F.coalesce(b / F.col("all"), F.lit(0.0))
    lead, hit = F.coalesce("lead", F.lit(False)), F.coalesce("hit", F.lit(False))
    rules = [
        (lead & (b > 0), "register name and portfolio", "accepted", F.lit(1.0)),
        (lead, "register name", "accepted", F.lit(0.95)),
        (hit & (b > 0), "brand inside the name and portfolio", "accepted", F.lit(0.9)),
        ((b >= 2) & (share >= 0.5), "portfolio", "accepted", F.round(share, 3)),
        ((bb > 0) & (share >= 0.5), "portfolio project with the brand", "accepted", F.round(share, 3)),
        (hit, "brand inside another name", "review", F.lit(0.5)),
        (b > 0, "portfolio, too few", "review", F.round(share, 3)),
    ]
    first = F.struct(F.lit("hand only").alias("method"), F.lit("review").alias("status"), F.lit(0.0).alias("score"))
    for when, method, status, score in reversed(rules):
        first = F.when(when, F.struct(F.lit(method).alias("method"), F.lit(status).alias("status"), score.cast("double").alias("score"))).otherwise(first)
    by_hand = F.col("verdict").isNotNull()
    ruled = tied.withColumn("rule", first).select(
        "grp", "dev", F.when(by_hand, "hand").otherwise(F.col("rule.method")).alias("method"), F.when(by_hand, 1.0).otherwise(F.col("rule.score")).alias("score"),
        F.when(by_hand, F.col("verdict")).otherwise(F.col("rule.status")).alias("status"), F.when(by_hand, "hand").otherwise("rule").alias("decided_by"),
    )
    own = (F.col("status") == "accepted") & (F.col("decided_by") == "rule")
    claims = ruled.where(own).groupBy("dev").agg(F.count("*").alias("claims"))
    twice = own & (F.coalesce("claims", F.lit(0)) > 1)
    return ruled.join(claims, "dev", "left").select("grp", "dev", F.when(twice, F.concat("method", F.lit(", claimed by "), F.col("claims").cast("string"), F.lit(" groups"))).otherwise(F.col("method")).alias("method"), "score", F.when(twice, "review").otherwise(F.col("status")).alias("status"), "decided_by")


def attributed(sales: DataFrame, members: DataFrame, projects: DataFrame, seeds: DataFrame, aliases: DataFrame) -> DataFrame:
    """id, grp, route of sales(id, cid, name): by the developer of the register row that the sale is keyed to; else by that of
    the only developer whose projects have the name; else by the only group in whose portfolio the name begins, unless the
    name carries an alias of another group.  members(grp, dev) are accepted ones; a developer of several groups attributes
    nothing; a null grp is a sale that no route places.

    Only key and name of a sale decide, so each pair of the two is asked once and its sales take the answer."""
    from ..sources.lake import stored

    asked = stored(sales.select("cid", "name").distinct().withColumn("asked", F.monotonically_increasing_id()))
    one = stored(members.groupBy("dev").agg(F.count("*").alias("n"), F.min("grp").alias("grp")).where("n = 1").drop("n"))
    by_key = asked.join(projects.select("cid", "dev"), "cid").join(one, "dev").select("asked", "grp", F.lit("key").alias("route"))
    rest = asked.join(by_key.select("asked"), "asked", "left_anti").select("asked", words(F.col("name")).alias("k"), "name").where(F.size("k") > 0)
    named = projects.where("dev IS NOT NULL").groupBy(words(F.col("name")).alias("k")).agg(F.countDistinct("dev").alias("n"), F.min("dev").alias("dev"))
    by_name = rest.join(named.where("n = 1"), "k").join(one, "dev").select("asked", "grp", F.lit("name").alias("route"))
    # what the register gives to a developer of another group or of none is not the portfolio's to give
    left = stored(rest.join(named.select("k"), "k", "left_anti"))
    starts = seeds.select("grp", words(F.col("name")).alias("k")).where(F.size("k") > 0).distinct()
    sizes = [r[0] for r in starts.select(F.size("k")).distinct().collect()]  # a few numbers
    heads = left.select("asked", F.explode(F.array(*[F.slice("k", 1, n) for n in sizes]) if sizes else F.array().cast("array<array<string>>")).alias("k")).distinct()
    met = heads.join(starts, "k").select("asked", "grp").distinct()
    other = carried(left.select(F.col("asked").alias("id"), "name"), aliases).select(F.col("id").alias("asked"), F.col("grp").alias("alias_of"))
    barred = met.join(other, "asked").where("alias_of <> grp").select("asked", "grp").distinct()
    kept = met.join(barred, ["asked", "grp"], "left_anti").groupBy("asked").agg(F.count("*").alias("n"), F.min("grp").alias("grp")).where("n = 1")
    found = by_key.unionByName(by_name).unionByName(kept.select("asked", "grp", F.lit("portfolio").alias("route")))
    answers = asked.join(found, "asked").select(F.col("cid").alias("c"), F.col("name").alias("m"), "grp", "route")
    return sales.join(answers, F.col("cid").eqNullSafe(F.col("c")) & F.col("name").eqNullSafe(F.col("m")), "left").select("id", "grp", "route")
