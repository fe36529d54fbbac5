"""Personal data by weak supervision, with DataFrame functions only.

Candidates of every kind come from regular expressions over the whole text, with their code-point spans.  Four labelers
vote on each candidate (for, against or no opinion): the strict form of the value, gazetteers (top-level domains, issuer
and country prefixes, reserved address ranges), words in the context before it, and the characters around it.
Expectation-maximisation over the counts of the vote patterns, a bounded table, estimates how reliable each labeler is
and how likely each pattern is true; on these soft labels a logistic span classifier is trained with the kind, the votes
and the length as inputs.  Spans of the four base kinds that pass their checks always stay; other candidates (national
phone numbers, written-out addresses, bank and social numbers, titled names) are added where the classifier says so and
no base span overlaps them.

The searches are possessive forms of the plain patterns: they match the same spans, but cannot backtrack over a long run.

Defined results: null and empty texts have no spans; rows with the same doc_id are separate documents; an empty table
gives no rows; with no candidates nothing is trained.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "name", "ssn"]
#: Code points of context before a candidate.
CONTEXT = 40

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further candidates: name of the search -> (kind, pattern, what a text must contain).
MORE = {
    "national": ("phone", r"(?<![0-9A-Za-z+.)-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", None),
    "written_out": ("email", r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,40}+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{2,40}+(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z]{2,10}+){1,3}", "at"),
    "iban": ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", None),
    "name": ("name", r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? \p{Lu}\p{Ll}{1,20}(?: \p{Lu}\p{Ll}{1,20}){0,2}", None),
    "ssn": ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
}
GUARDS = {"email": "@", "ip": ".", "phone": "+"}

# fixed values: word lists of the labelers
DOMAINS = "com org net edu gov info biz io de fr es uk it nl eu us ca au ch at be pl pt se no dk fi ie jp in br mx cn ru".split()
COUNTRIES = "AT BE CH CY CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT SE".split()
WORDS_FOR = {
    "email": "mail|write to|contact|reach|reply", "ip": r"\bip\b|address|host|server|login from", "card": "card|visa|master|payment|credit|paid", "phone": "call|phone|tel|mobile|fax|contact|dial",
    "iban": "iban|account|bank|transfer", "name": "sincerely|signed|dear|contact|by|with", "ssn": "ssn|social security|insurance",
}
WORDS_AGAINST = r"version|isbn|order|invoice|\bref\b|token|serial|build|chapter|page"


def _spans(text: Column, pattern: str, guard: str | None) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("out"))

    # the pieces between the matches, of which the last one is not needed
    pieces = F.split(text, pattern, -1)
    both = F.zip_with(found, F.slice(pieces, 1, F.size(found)), lambda v, g: F.struct(g.alias("gap"), v.alias("value")))
    spans = F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda acc: acc["out"])
    any_ = text.rlike(pattern) if guard is None else text.contains(guard) & text.rlike(pattern)
    return F.when(any_, spans).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.split(_digits(value), ""))
    one = F.transform(digits, lambda d, i: F.when(i % 2 == 1, F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.coalesce(F.try_to_number(d, F.lit("9")).cast("int"), F.lit(0)) + 1)).otherwise(F.coalesce(F.try_to_number(d, F.lit("9")).cast("int"), F.lit(0))))
    return F.aggregate(one, F.lit(0), lambda a, x: a + x) % 10 == 0


def _is_base(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= F.lit("255"))))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(value)).otherwise(False)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "+").when(no, "-").otherwise("0")


def _votes(kind: str, s: Column, before: Column, after: Column) -> Column:
    """Four characters, one vote a labeler."""
    v, digits = s["value"], _digits(s["value"])
    n, never = F.length(digits), F.lit(False)
    # strict form; gazetteer
    form, list_ = {
        "email": lambda: (_vote(v.rlike(r"^[A-Za-z0-9]") & ~v.contains(".."), v.contains("..")), _vote(F.lower(v).rlike(rf"(?:{'|'.join(DOMAINS)})[)\]]?$"), v.rlike(r"[0-9]$"))),
        "ip": lambda: (_vote(v.rlike(r"^(?:[1-9][0-9]{0,2}|0)(?:\.(?:[1-9][0-9]{0,2}|0)){3}$"), v.rlike(r"(?:^|\.)0[0-9]")), _vote(~v.rlike(r"^(?:0|127|255)\."), v.rlike(r"^(?:0|127|255)\."))),
        "card": lambda: (_vote(n.between(16, 19), (n < 13) | (n > 19)), _vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"), digits.rlike("^[01789]"))),
        "phone": lambda: (_vote(n.between(10, 13), (n < 7) | (n > 15)), _vote(v.rlike(r"^\+?\(?[1-9]"), digits.rlike("^0{2}"))),
        "iban": lambda: (_vote(F.length(F.replace(v, F.lit(" "))).between(15, 34), F.length(F.replace(v, F.lit(" "))) < 15), _vote(F.substring(v, 1, 2).isin(COUNTRIES), ~F.substring(v, 1, 2).isin(COUNTRIES))),
        "name": lambda: (_vote(v.rlike(r"\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+$"), never), _vote(v.rlike(r"^(?:Mr|Mrs|Ms|Dr|Prof)\. "), never)),
        "ssn": lambda: (_vote(~v.rlike("^(?:000|666|9)|-00-|-0000$"), v.rlike("^(?:000|666|9)|-00-|-0000$")), F.lit("0")),
    }[kind]()
    context = _vote(F.lower(before).rlike(WORDS_FOR[kind]), F.lower(before).rlike(WORDS_AGAINST))
    edges = _vote(before.rlike(r"(?:^|[\s(\[<\"':;,])$") & after.rlike(r"^(?:[\s)\]>\"':;,.!?]|$)"), before.rlike(r"[\p{L}\p{N}]$") | after.rlike(r"^[\p{L}\p{N}]"))
    return F.concat(form, list_, context, edges)


def candidates(text: Column) -> Column:
    """array<struct<kind, start, end, base, votes, long>> of all candidates; kind is a number in KINDS."""
    def judge(name: str, kind: str):
        def judged(s: Column) -> Column:
            before = F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
            after = F.substring(text, s["end"] + 1, F.lit(1))
            base = _is_base(kind, s["value"]) if name in BASE else F.lit(False)
            size = s["end"] - s["start"]
            return F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), base.alias("base"), _votes(kind, s, before, after).alias("votes"), F.when(size < 12, 0).when(size < 20, 1).otherwise(2).alias("long"))

        return judged

    searches = {k: (k, PATTERNS[k], GUARDS.get(k)) for k in BASE} | MORE
    parts = [(KINDS.index(kind), name not in BASE, F.transform(_spans(text, pattern, guard), judge(name, kind))) for name, (kind, pattern, guard) in searches.items()]
    return F.concat(*[p for _, _, p in sorted(parts, key=lambda x: x[:2])])


def estimate(cells: list[tuple[int, str, int, int]], rounds: int = 50) -> tuple[list[dict], dict]:
    """Expectation-maximisation over (kind, votes, long, count).  Returns for each labeler {(class, vote): probability},
    and the posterior of truth for each (kind, votes).  Labelers are taken as independent given the class."""
    table: dict[tuple[int, str], float] = {}
    for kind, votes, _, n in cells:
        table[kind, votes] = table.get((kind, votes), 0) + n
    labelers = len(next(iter(table))[1]) if table else 0
    # at first every labeler is right four times in five
    model = [{(c, v): {"0": 0.3, "+": 0.56 if c else 0.14, "-": 0.14 if c else 0.56}[v] for c in (0, 1) for v in "+-0"} for _ in range(labelers)]
    prior, posterior = {k: 0.5 for k, _ in table}, {}
    for _ in range(rounds):
        for (kind, votes), _n in table.items():
            like = [math.log(p) for p in (1 - prior[kind], prior[kind])]
            for i, v in enumerate(votes):
                for c in (0, 1):
                    like[c] += math.log(model[i][c, v])
            posterior[kind, votes] = 1 / (1 + math.exp(max(-50.0, min(50.0, like[0] - like[1]))))
        for kind in prior:
            mine = [(n, posterior[k]) for k, n in table.items() if k[0] == kind]
            prior[kind] = (sum(n * p for n, p in mine) + 1) / (sum(n for n, _ in mine) + 2)
        for i in range(labelers):
            for c in (0, 1):
                total = {v: 1.0 for v in "+-0"}
                for (_, votes), n in table.items():
                    total[votes[i]] += n * (posterior[_, votes] if c else 1 - posterior[_, votes])
                for v in "+-0":
                    model[i][c, v] = total[v] / sum(total.values())
    return model, posterior


def train(cells: list[tuple[int, str, int, int]], steps: int = 300, rate: float = 0.5) -> dict[tuple[int, str, int], float]:
    """The classifier's probability for each cell, by logistic regression on the posteriors of estimate()."""
    _, posterior = estimate(cells)
    inputs = lambda kind, votes, size: [f"k{kind}", f"l{size}", *(f"{i}{v}" for i, v in enumerate(votes))]
    weight: dict[str, float] = {}
    total = sum(math.sqrt(n) for *_, n in cells) or 1.0
    score = lambda cell: 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(weight.get(x, 0.0) for x in inputs(*cell))))))
    for _ in range(steps):
        step: dict[str, float] = {}
        for kind, votes, size, n in cells:
            error = (posterior[kind, votes] - score((kind, votes, size))) * math.sqrt(n) / total
            for x in inputs(kind, votes, size):
                step[x] = step.get(x, 0.0) + error
        for x, d in step.items():
            weight[x] = weight.get(x, 0.0) + rate * d
    return {(kind, votes, size): score((kind, votes, size)) for kind, votes, size, _ in cells}


def _key(s: Column) -> Column:
    return F.concat_ws("/", s["kind"].cast("string"), s["votes"], s["long"].cast("string"))


def accepted(found: DataFrame, threshold: float = 0.5) -> Column:
    """The spans of column `found` that stay.  found: a stored table with a column of candidates()."""
    # at most kinds x 3**4 vote patterns x 3 lengths rows reach the driver
    cells = [tuple(r) for r in found.select(F.explode("found").alias("s")).groupBy("s.kind", "s.votes", "s.long").agg(F.count("*")).collect()]
    good = [f"{k}/{v}/{n}" for (k, v, n), p in train(cells).items() if p >= threshold]
    base = F.filter("found", lambda s: s["base"])
    more = F.filter("found", lambda s: ~s["base"] & _key(s).isin(good) & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))) if good else F.slice(base, 1, 0)
    return F.concat(base, more)


def _listed(spans: Column) -> Column:
    """kind:start:end of the spans by kind, then start."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.array_distinct(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))), ",")


def _found(docs: DataFrame, keep: Column) -> DataFrame:
    return written(docs.select(keep, candidates(F.coalesce(F.col("text"), F.lit(""))).alias("found")), "pii-candidates")


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_<base kind>, base_sha256, spans for every row of docs(doc_id, text)."""
    found = _found(docs, F.col("doc_id"))
    out = found.withColumn("all", accepted(found)).withColumn("base", F.filter("found", lambda s: s["base"]))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *map(count, BASE), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("all")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span of its texts replaced by the kind in brackets, all other columns as they were."""
    found = _found(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    order = F.array_sort(F.transform(accepted(found), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names, text = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), F.col("row.text")

    def put(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], F.array(gap, F.element_at(names, s["kind"] + 1)))).otherwise(acc["out"]).alias("out"))

    parts = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), put, lambda a: F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, F.length(text)))))
    masked = F.when(F.size(order) > 0, F.array_join(parts, "")).otherwise(text)
    return found.select(*[masked.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
