"""Golden gates: rules that name their offenders, and answers from the field that a measured distance must bear out; ids that
follow from content; evidence that is appended and superseded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import space

#: A measured distance may differ from the claimed one by this share or by so many metres.
SHARE, METRES = 0.35, 150.0


def gate(rules: dict[str, DataFrame], known: set[str] = frozenset()) -> DataFrame:
    """rule, offenders, verdict: PASS without offenders; FAIL, or `known` for a rule that is known to fail."""
    out = None
    for name, bad in rules.items():
        one = bad.agg(F.count("*").alias("offenders")).select(F.lit(name).alias("rule"), "offenders", F.lit(name in known).alias("known"))
        out = one if out is None else out.unionByName(one)
    return out.select("rule", "offenders", F.when(F.col("offenders") == 0, "PASS").when(F.col("known"), "known").otherwise("FAIL").alias("verdict"))


def field_answers(claims: DataFrame, amenities: DataFrame) -> DataFrame:
    """a, metres, holds for claims(a, lon, lat, kind, access, claimed) against amenities(b, lon, lat, kind, access).

    The nearest amenity of the kind, of public ones alone where the claim says public, must be as far as claimed (within SHARE
    or METRES; a null claim is any distance that the widest claim allows) and of the claimed access.  Beyond the widest
    distance that any claim allows nothing is looked for: metres is null and the claim does not hold.  Claims of one place are
    looked up once, and of the amenities of a place the first stands for all."""
    widest = claims.agg(F.max(F.col("claimed") + F.greatest(F.lit(METRES), SHARE * F.col("claimed"))).alias("m")).first()["m"] or METRES
    kinds = sorted((tuple(r) for r in claims.select("kind", "access").where("kind IS NOT NULL").distinct().collect()), key=str)  # a few
    found = None
    for kind, access in kinds:
        asked = claims.where((F.col("kind") == kind) & F.col("access").eqNullSafe(F.lit(access)))
        there = amenities.where(F.col("kind") == kind)
        there = there.where("access = 'public'") if access == "public" else there
        there = there.where("b IS NOT NULL").groupBy("lon", "lat").agg(F.min(F.struct("b", "access")).alias("b"))
        places = asked.where("lon IS NOT NULL AND lat IS NOT NULL").select(F.struct("lon", "lat").alias("a"), "lon", "lat").distinct()
        near = space.nearest(places, there, float(widest)).select("a.lon", "a.lat", "metres", F.col("b.access").alias("is"))
        one = asked.join(near, ["lon", "lat"], "left").select(*claims.columns, "metres", "is")
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = claims.withColumn("metres", F.lit(None).cast("double")).withColumn("is", F.lit(None).cast("string"))
    near_enough = F.col("claimed").isNull() | (F.abs(F.col("metres") - F.col("claimed")) <= F.greatest(F.lit(METRES), SHARE * F.col("claimed")))
    public = lambda c: F.coalesce(F.col(c), F.lit("public")) == "public"
    return found.select("a", "metres", F.coalesce(near_enough & F.col("metres").isNotNull() & (public("access") == public("is")), F.lit(False)).alias("holds"))


def content_ids(rows: DataFrame, key: str, content: list[Column], finer: list[Column], prefix: str) -> DataFrame:
    """key, id: an id that follows from content, so that it lasts from load to load.  Where several rows share it the finer
    content enters too; rows that are equal in that as well are numbered by key, so a new one changes no older id."""
    text = lambda cs: F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("")) for c in cs])
    short = lambda c: F.substring(F.sha1(c), 1, 10)
    named = rows.select(F.col(key).alias("__k"), short(text(content)).alias("__c"), short(text([*content, *finer])).alias("__f"))
    n = named.groupBy("__c").agg(F.count("*").alias("__n")).where("__n > 1").select("__c", F.lit(True).alias("__shared"))
    # of equal finer content the first keeps the plain id; the rest are few unless rows repeat
    first = named.groupBy("__f").agg(F.min("__k").alias("__first"))
    j = named.join(n, "__c", "left").join(first, "__f")
    plain = F.when(F.col("__shared"), F.col("__f")).otherwise(F.col("__c"))
    suffix = F.when(F.coalesce(F.col("__shared"), F.lit(False)) & (F.col("__k") != F.col("__first")), F.concat(F.lit("-"), F.col("__k").cast("string"))).otherwise("")
    return j.select(F.col("__k").alias(key), F.concat(F.lit(prefix), plain, suffix).alias("id"))


def asserted(evidence: DataFrame, run: DataFrame, job: str, at: int) -> DataFrame:
    """evidence(job, entity, value, status, since, until) after a run(entity, value) of a job: what it asserts anew is appended,
    what it no longer asserts is superseded, other jobs' rows stand."""
    own = (F.col("job") == job) & (F.col("status") == "asserted")
    now = run.select("entity", "value").where("entity IS NOT NULL").distinct()
    same = lambda a, b: F.col(f"{a}.entity").eqNullSafe(F.col(f"{b}.entity")) & F.col(f"{a}.value").eqNullSafe(F.col(f"{b}.value"))
    marked = evidence.alias("e").join(now.withColumn("again", F.lit(True)).alias("n"), same("e", "n"), "left").select("e.*", "again")
    gone = F.coalesce(own, F.lit(False)) & F.col("again").isNull()
    old = marked.select("job", "entity", "value", F.when(gone, "superseded").otherwise(F.col("status")).alias("status"), "since", F.when(gone, F.lit(at)).otherwise(F.col("until")).alias("until"))
    new = now.alias("n").join(evidence.where(own).alias("e"), same("e", "n"), "left_anti")
    return old.unionByName(new.select(F.lit(job).alias("job"), "entity", "value", F.lit("asserted").alias("status"), F.lit(at).alias("since"), F.lit(None).cast("int").alias("until")))


def extracts_compared(before: DataFrame, now: DataFrame, by: str) -> DataFrame:
    """by, was, is, reason of two extracts by group: count, content (same count, other rows), or same.  Groups are compared by
    their counts and order-free fingerprints, so no row is sorted or paired."""
    columns = [c for c in before.columns if c != by]

    def mark(df: DataFrame, n: str) -> DataFrame:
        h = F.xxhash64(*[F.col(c) for c in columns])
        return df.groupBy(F.col(by).alias(f"k{n}")).agg(F.count("*").alias(n), F.bit_xor(h).alias(f"x{n}"), F.sum(h.cast("decimal(38,0)")).alias(f"t{n}"))

    j = mark(before, "was").join(mark(now, "is"), F.col("kwas").eqNullSafe(F.col("kis")), "full")
    was, is_ = F.coalesce("was", F.lit(0)), F.coalesce("is", F.lit(0))
    same = F.col("xwas").eqNullSafe(F.col("xis")) & F.col("twas").eqNullSafe(F.col("tis"))
    return j.select(F.coalesce("kwas", "kis").alias(by), was.alias("was"), is_.alias("is"), F.when(was != is_, "count").when(~same, "content").otherwise("same").alias("reason"))


def churn(published: DataFrame, now: DataFrame, superseded: DataFrame, share: float = 0.01) -> DataFrame:
    """published, vanished, excused, held for ids published(id) against now(id): an id that is gone is excused if
    superseded(id, by) names a successor that is there, over any number of steps of which each is a row."""
    from ..sources.lake import stored

    there = now.select("id").distinct()
    gone = stored(published.select("id").distinct().join(there, "id", "left_anti"))
    step = stored(superseded.select("id", "by").where("by IS NOT NULL").distinct())
    # every pair of an id and a successor that it leads to, found once, so that a circle ends
    walk = seen = gone.select("id", F.col("id").alias("at"))
    while True:
        further = walk.join(step.select(F.col("id").alias("at"), "by"), "at").select("id", F.col("by").alias("at")).distinct()
        walk = stored(further.join(seen, ["id", "at"], "left_anti"))
        if not walk.limit(1).count():
            break
        seen = seen.unionByName(walk)
    excused = seen.join(there.select(F.col("id").alias("at")), "at", "left_semi").select("id").distinct()
    n = published.select("id").distinct().agg(F.count("*").alias("published"))
    g, e = gone.agg(F.count("*").alias("vanished")), excused.agg(F.count("*").alias("excused"))
    return n.crossJoin(g).crossJoin(e).withColumn("held", F.col("vanished") - F.col("excused") > share * F.col("published"))  # one row each
