"""Personal data by weak supervision, in DataFrame operations only.

Candidates are the matches of strict patterns and of looser ones (obfuscated
mail addresses, phone numbers without a plus, long network addresses, other
separators in card numbers). Five labelers vote on every candidate, each for
(1), against (-1) or not at all (0): the strict pattern, a gazetteer (top-level
domains, calling codes, issuer digits, address ranges), the words before the
candidate, a check of its form (Luhn, ranges, digit counts), and its variety
of characters. Expectation-maximisation over the counts of vote patterns
estimates each labeler's reliability per kind without any true label; the
resulting probabilities train a final classifier of spans (naive Bayes over
votes and shape), which becomes one sum of conditional expressions. Valid
strict matches always stay, strict ones of a wrong form never do (they teach
what is false); the classifier decides on the loose ones, of which those that
overlap a stronger span go.

Only counts of vote patterns reach the driver: at most 3**5 patterns by four
kinds and eight shapes. Positions come from the lengths of the pieces between
matches, summed up per document in a window over its matches; texts without
an @ or a digit are passed over by the patterns that need one.

The patterns use possessive repeats and start only where a run starts or the
last match ended: the same matches as the plain ones, in linear time and
constant stack on any text.

Defined results: a null or empty text has no spans; rows that repeat an id
with another text are read one by one; repeated equal rows each get the same
result; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import stage, table

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["strict", "gazetteer", "context", "form", "variety"]
MIN_PROBABILITY = 0.5
EM_ROUNDS = 40

#: Fixed: the strict patterns' languages.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}"
             r"(?:(?: ?(?:\(dot\)|\[dot\]|\{dot\}) ?|\.)[A-Za-z0-9-]{1,63}){1,6}",
    "ip": r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9./_])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9./_])",
    "phone": r"(?<![0-9A-Za-z+.(-])(?:00[1-9][0-9]{0,2}[ .-])?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z-]|\.[0-9])",
}
#: Gazetteer: common top-level domains.
DOMAINS = ["com", "org", "net", "edu", "gov", "int", "info", "io", "co", "uk", "de", "fr", "es", "it", "nl", "eu", "us", "ca", "au", "ch", "at",
           "jp", "cn", "in", "br", "ru", "pl", "se", "no", "dk", "fi", "be", "pt", "ie", "nz", "mx"]
#: Gazetteer: first digits of calling codes of one or two digits, and of three.
CALLING = r"^(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
CUES = {"email": "mail|contact|write to|reach", "ip": "ip|address|host|server|client|login|from", "card": "card|visa|master|credit|debit|payment|amex",
        "phone": "phone|tel|call|mobile|cell|fax|contact|ring"}
AGAINST = r"(?:version|release|chapter|section|isbn|page|figure|no\.|v\.?|§|#|=)\s*$"
CONTEXT = 40


def pieces(text: Column, pattern: str, kind: str, strict: bool, needed: Column) -> Column:
    """(kind, strict, i, gap, before, match) of each match in order; ``gap``: characters since the last one's end."""
    between = F.transform(F.split(text, pattern, -1), lambda p: F.struct(F.char_length(p).alias("gap"), F.right(p, F.lit(CONTEXT)).alias("before")))
    both = F.arrays_zip(between.alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    rows = F.transform(both, lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), F.lit(strict).alias("strict"), i.alias("i"),
        x["p"]["gap"].alias("gap"), x["p"]["before"].alias("before"), x["m"].alias("m")))
    return F.when(needed, rows)


def matches(docs: DataFrame) -> DataFrame:
    """All candidates of ``docs`` (doc_id, row, text) with their start and end in code points."""
    t = F.col("text")
    digit, at = t.rlike("[0-9]"), t.contains("@")
    needs = {("email", True): at, ("email", False): t.rlike(r"[(\[{]at[)\]}]"), ("ip", False): digit & t.contains(":")}
    found = [pieces(t, p, kind, strict, needs.get((kind, strict), digit)) for strict, ps in ((True, STRICT), (False, LOOSE)) for kind, p in ps.items()]
    # One generator for each pattern's array: most are null and yield nothing that is kept.
    rows = docs.select("doc_id", "row", F.explode_outer(F.array(*found)).alias("_a")).where("_a IS NOT NULL")
    rows = rows.select("doc_id", "row", F.explode_outer("_a").alias("x")).where("x.m IS NOT NULL").select("doc_id", "row", "x.*").distinct()
    own = "sum(gap + char_length(m)) OVER (PARTITION BY doc_id, row, kind, strict ORDER BY i)"
    return rows.selectExpr("doc_id", "row", "kind", "strict", "before", "m", f"{own} - char_length(m) AS start", f"{own} AS end")


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """12 to 19 digits whose check sum is right."""
    d = F.reverse(digits(m))
    def value(i: Column) -> Column:
        x = F.substring(d, i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)
    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.char_length(d) - 1), value), F.lit(0), lambda s, x: s + x)
    return F.char_length(d).between(12, 19) & F.when(F.char_length(d).between(12, 19), total % 10 == 0).otherwise(False)


def form(kind: Column, m: Column) -> Column:
    octets = m.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$")
    return (F.when(kind == 0, F.lit(True)).when(kind == 1, octets | m.contains(":")).when(kind == 2, luhn(m))
            .otherwise(F.char_length(digits(m)).between(9, 15)))


def votes(candidates: DataFrame) -> DataFrame:
    """``candidates`` with a vote of each labeler, and a shape."""
    k, m, before = F.col("kind"), F.col("m"), F.lower("before")
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    domain = F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1))
    number = digits(m)
    gazetteer = (F.when(k == 0, vote(domain.isin(DOMAINS), domain.rlike("^[0-9]")))
                 .when(k == 1, vote(m.rlike(r"^0*(?:[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\.") | m.contains(":"), m.rlike(r"^0*\.|^0*2(?:2[4-9]|[3-9])")))
                 .when(k == 2, vote(number.rlike("^[3-6]"), number.rlike("^[01789]")))
                 .otherwise(vote(F.regexp_replace(number, "^00", "").rlike(CALLING) & (m.startswith("+") | m.startswith("00")), number.rlike("^0{3}"))))
    cue = F.lit(False)
    for i, kind in enumerate(KINDS):
        cue = cue | ((k == i) & before.rlike(rf"\b(?:{CUES[kind]})\w{{0,6}}\W{{0,12}}(?:\w+\W{{1,4}}){{0,2}}$"))
    kinds_of = F.size(F.array_distinct(F.split(number, "")))
    return candidates.select(
        "*", F.when(F.col("strict"), 1).otherwise(0).alias("strict_vote"), gazetteer.alias("gazetteer_vote"),
        vote(cue, before.rlike(AGAINST)).alias("context_vote"), vote(form(k, m), ~form(k, m)).alias("form_vote"),
        F.when((k == 0) | (k == 1), 0).otherwise(vote(kinds_of >= 5, kinds_of <= 3)).alias("variety_vote"),
        F.concat(F.when(F.col("strict"), "s").otherwise("l"), F.when(m.rlike("[ ()]"), " ").otherwise("-"),
                 F.when(F.char_length(m) < 16, "<").otherwise(">")).alias("shape"))


def reliabilities(patterns: list[tuple[tuple[int, ...], float]], rounds: int = EM_ROUNDS):
    """EM for one kind: (prior of true, [labeler][truth][vote] probabilities, probability of each pattern).

    ``patterns``: votes and how often they occur. Pseudo-counts keep a labeler
    better than chance where a kind has few candidates.
    """
    def start(v):
        return 1 / (1 + math.exp(-1.5 * sum(v)))

    prob = [start(v) for v, _ in patterns]
    for _ in range(rounds):
        mass = [sum(n * (p if y else 1 - p) for (_, n), p in zip(patterns, prob)) for y in (0, 1)]
        prior = (mass[1] + 1) / (sum(mass) + 2)
        table_ = []
        for j in range(len(LABELERS)):
            rows = []
            for y in (0, 1):
                count = {-1: 0.5 + 1.5 * (y == 0), 0: 2.0, 1: 0.5 + 1.5 * (y == 1)}
                for (v, n), p in zip(patterns, prob):
                    count[v[j]] += n * (p if y else 1 - p)
                total = sum(count.values())
                rows.append({x: c / total for x, c in count.items()})
            table_.append(rows)

        def posterior(v, prior=prior, table_=table_):
            odds = math.log(prior / (1 - prior)) + sum(math.log(table_[j][1][x] / table_[j][0][x]) for j, x in enumerate(v))
            return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))

        prob = [posterior(v) for v, _ in patterns]
    return prior, table_, prob


def train(rows: list[tuple[int, tuple[int, ...], str, float]]) -> dict[int, tuple[float, list[dict[int, float]], dict[str, float]]]:
    """Per kind: bias and weights (log odds) of each vote and shape, from the counts (kind, votes, shape, n)."""
    out = {}
    for kind in range(len(KINDS)):
        mine = [(v, s, n) for k, v, s, n in rows if k == kind]
        if not mine:
            continue
        counts: dict[tuple[int, ...], float] = {}
        for v, _, n in mine:
            counts[v] = counts.get(v, 0) + n
        patterns = sorted(counts.items())
        prior, _, prob = reliabilities(patterns)
        p = dict(zip((v for v, _ in patterns), prob))
        true, false = sum(n * p[v] for v, _, n in mine) + 1, sum(n * (1 - p[v]) for v, _, n in mine) + 1

        def weight(hit, true=true, false=false, mine=mine, p=p):
            a = sum(n * p[v] for v, s, n in mine if hit(v, s)) + 0.5
            b = sum(n * (1 - p[v]) for v, s, n in mine if hit(v, s)) + 0.5
            return math.log(a / (true + 1)) - math.log(b / (false + 1))

        by_vote = [{x: weight(lambda v, s, j=j, x=x: v[j] == x) for x in (-1, 0, 1)} for j in range(len(LABELERS))]
        out[kind] = (math.log(true / false), by_vote, {s: weight(lambda v, t, s=s: t == s) for s in sorted({s for _, s, _ in mine})})
    return out


def probability(model) -> Column:
    """The classifier as one expression."""
    total = F.lit(-50.0)
    for kind, (bias, by_vote, by_shape) in model.items():
        score = F.lit(bias)
        for name, weights in zip(LABELERS, by_vote):
            v = F.col(f"{name}_vote")
            score = score + F.when(v == 1, weights[1]).when(v == -1, weights[-1]).otherwise(weights[0])
        shape = F.lit(0.0)
        for s, w in by_shape.items():
            shape = F.when(F.col("shape") == s, w).otherwise(shape)
        total = F.when(F.col("kind") == kind, score + shape).otherwise(total)
    return 1 / (1 + F.exp(-total))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row, kind (number), start, end, base and probability of all spans kept."""
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    voted = stage(votes(matches(rows)), "candidates")
    names = [f"{x}_vote" for x in LABELERS]
    counted = voted.groupBy("kind", *names, "shape").count().collect()  # bounded: patterns, not spans
    model = train([(r["kind"], tuple(r[x] for x in names), r["shape"], float(r["count"])) for r in counted])
    scored = voted.withColumn("base", F.col("strict") & (F.col("form_vote") == 1)).withColumn("probability", probability(model))
    cols = ["doc_id", "row", "kind", F.col("start").cast("long"), F.col("end").cast("long"), "base", "probability"]
    base = scored.where("base").select(*cols)
    added = scored.where(~F.col("strict") & (F.col("probability") >= MIN_PROBABILITY)).select(*cols)  # failed strict ones only teach
    # An added span goes if a base span overlaps it, or an added one that is surer (then earlier, then of an earlier kind).
    x, y = added.alias("x"), base.unionByName(added).alias("y")
    better = F.expr("y.base OR y.probability > x.probability OR (y.probability = x.probability AND "
                    "(y.start < x.start OR (y.start = x.start AND (y.kind < x.kind OR (y.kind = x.kind AND y.end > x.end)))))")
    free = x.join(y, F.expr("x.doc_id <=> y.doc_id AND x.row = y.row AND x.start < y.end AND y.start < x.end") & better, "left_anti")
    return base.unionByName(free)


def op7_pii(spark, sf_dir):
    """Spans of personal data in all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = spans(docs)
    name = F.get(F.array(*map(F.lit, KINDS)), F.col("kind"))
    entry = F.struct("start", "kind", "end", F.concat_ws(":", name, "start", "end").alias("s"))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["s"]), ",")
    per_doc = found.groupBy("doc_id", "row").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        listed(F.when(F.col("base"), entry)).alias("base_spans"), listed(entry).alias("spans"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("row")).alias("d")
    out = rows.join(per_doc.alias("p"), F.expr("d.doc_id <=> p.doc_id AND d.row = p.row"), "left")
    return out.select("d.doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(F.encode(F.coalesce("base_spans", F.lit("")), "utf-8"), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"))
