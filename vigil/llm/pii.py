"""Personal data in texts: high-recall generators, gradient-boosted trees over candidates, calibrated thresholds.

Generators are regular expressions that run in the JVM.  Those of ``BASE`` give every match that passes its check
(octets, Luhn, number of digits).  Those of ``LOOSE`` propose further spans, which may overlap: numbers of
telephones without a country code, addresses written out, social security and bank account numbers, and long strings
that may be keys or passwords.

A loose candidate has a label and features that share nothing.  The label (``valid``) is a check of the characters of
the match (number ranges, check digits, top-level domains, mixed characters), and that no word before it names
another kind of number, such as an order's.  The features are its shape (length, separators, brackets) and its context
(words that name its kind, assignment signs, quotes, neighbouring characters); none holds what the label looks at.  Boosted trees trained on loose candidates of this corpus so learn in which shape and
context a generator's matches are real.  The sample has about ``TRAIN_ROWS`` candidates of each kind, or all where there
are fewer, by hash of doc_id, place and match.  All loose candidates are scored, and each kind has its threshold from all of
its candidates: the lowest score, to ``SCORE_DIGITS`` digits, at which ``PRECISION`` of those from there up are valid.
Loose candidates from there on become spans, unless a base span of their kind overlaps them.  Base spans always stay.

Everything is DataFrame and SQL functions.  Matches are placed by running sums over the lengths between them, so
a text with very many matches costs a sort, and every pattern takes linear time and constant stack.

Positions are code points, ends exclusive.  Null text counts as empty.  Texts of any length are searched whole.  Rows are
treated one by one, whether or not they repeat or share doc_id.  Where all drawn candidates have one label, that is
the score of all; a kind that never reaches the precision adds nothing to the base.  An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.shared import stored, whole_text

TRAIN_ROWS = 20_000
PRECISION = 0.95
SCORE_DIGITS = 4
CONTEXT = 40

# Kinds in order, and their patterns.  Beside the plain definitions they say where a run begins and ends, which
# changes no match and spares repeated scans of long runs.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++\.{_LABEL}[A-Za-z0-9.-]*?(?=\.(?:[^A-Za-z0-9-]|\z)|[^A-Za-z0-9.-]|\z)",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?=[\x20-]?[0-9])[0-9\x20-]*?(?=[\x20-](?:[^0-9]|\z)|[^0-9\x20-]|\z)",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z]{2,24}",
    "phone": r"(?<![A-Za-z0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=@-])",
}
#: Patterns that the characters of a match must follow to be valid.
VALID = {
    "email": r"(?i)(?:\.|dot\x20?|\[dot\]|\(dot\)|dot\x20)\x20?(?:com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us)$",
    "phone": r"^\(?[2-9][0-9]{2}\)?[\x20.-]*[2-9][0-9]{2}",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "secret": r"^(?=.*[0-9].*[0-9].*[0-9])(?=.*[A-Za-z].*[A-Za-z].*[A-Za-z])",
}
#: Different characters that a valid key or password has at least.
SECRET_CHARACTERS = 10
#: What a text must hold for a pattern to be tried.
HINTS = {"email": "@", "phone": "+"}
ORDER = ["email", "ip", "card", "phone", "ssn", "iban", "secret"]
NAMES = {
    "email": r"mail|contact|write",
    "ip": r"\bip\b|address|host|server",
    "card": r"card|visa|credit|payment",
    "phone": r"phone|\btel|call|mobile|fax",
    "ssn": r"\bssn\b|social|security",
    "iban": r"iban|bank|account",
    "secret": r"token|secret|\bkey|passw|credential|auth",
}
AGAINST = r"order|version|invoice|item|total|isbn|page|\bid\b"


def _matches(text: Column, kind: str, pattern: str, loose: bool) -> Column:
    """Array of matches with the length of the text since the one before, and their surroundings."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    hint = HINTS.get(kind)
    if loose:
        possible = text.rlike(r"(?i)[\[( ]at[\]) ]" if kind == "email" else "[A-Za-z0-9+/_-]{20}" if kind == "secret" else "[0-9]{2}")
    else:
        possible = text.contains(hint) if hint else text.rlike("[0-9]{2}|[0-9][.\\x20-][0-9]")
    gaps = F.split(text, pattern, -1)
    rows = F.transform(
        F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"), F.slice(gaps, 2, F.size(hits)).alias("next")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            F.lit(loose).alias("loose"),
            i.alias("number"),
            x["hit"].alias("hit"),
            F.length(x["gap"]).alias("gap"),
            F.right(x["gap"], F.lit(CONTEXT)).alias("before"),
            F.left(x["next"], F.lit(1)).alias("after"),
        ),
    )
    return F.when(possible & (F.size(hits) > 0), rows)


_MATCH = "array<struct<kind:string,loose:boolean,number:int,hit:string,gap:int,before:string,after:string>>"


def _digits(column: str = "hit") -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def _luhn() -> Column:
    """Whether the digits of ``hit`` pass the check: from the right, every second one doubled."""
    return F.expr(
        "aggregate(transform(split(reverse(regexp_replace(hit, '[^0-9]', '')), ''),"
        " (d, i) -> (try_cast(d AS int) * (1 + i % 2)) - if(i % 2 = 1 AND d > '4', 9, 0)),"
        " 0, (a, d) -> a + coalesce(d, 0)) % 10 = 0"
    )


def _octets() -> Column:
    return F.expr(
        "size(split(hit, '[.]')) = 4 AND forall(split(hit, '[.]'), p -> length(ltrim('0', p)) <= 3"
        " AND coalesce(try_cast(p AS int), 256) <= 255)"
    )


def _passes() -> Column:
    n = F.length(_digits())
    return (
        F.when(F.col("kind") == "ip", _octets())
        .when(F.col("kind") == "card", n.between(12, 19) & _luhn())
        .when(F.col("kind") == "phone", n.between(9, 15))
        .otherwise(F.lit(True))
    )


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (``row, doc_id``) and their candidates with place, kind and surroundings."""
    text = F.col("text")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", whole_text().alias("text"))
    empty = F.expr(f"cast(array() AS {_MATCH})")
    kinds = [(k, p, False) for k, p in BASE.items()] + [(k, p, True) for k, p in LOOSE.items()]
    found = stored(
        rows.select("row", "doc_id", F.concat(*[F.coalesce(_matches(text, *x).cast(_MATCH), empty) for x in kinds]).alias("found")), "pii-matches"
    )
    before = Window.partitionBy("row", "loose", "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        found.select("row", "doc_id", F.explode("found").alias("m"))
        .select("row", "doc_id", "m.*")
        .withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(before).cast("long"))
        .withColumn("start", F.col("end") - F.length("hit"))
        .withColumn("passes", F.col("loose") | _passes())
        .drop("gap", "number")
    )
    return found.select("row", "doc_id"), placed


def _mod_97() -> Column:
    """Whether the check digits of ``hit`` are those of a bank account: its characters as one number, the first four last."""
    return F.expr(
        "aggregate(split(concat(substring(regexp_replace(hit, ' ', ''), 5), left(hit, 4)), ''), 0,"
        " (a, c) -> if(c = '', a, (a * if(c < 'A', 10, 100) + if(c < 'A', ascii(c) - 48, ascii(c) - 55)) % 97)) = 1"
    )


def valid() -> Column:
    """The label of a loose candidate: its characters pass their check, and it isn't called something else."""
    checks = {k: F.col("hit").rlike(pattern) for k, pattern in VALID.items()} | {"iban": _mod_97()}
    checks["secret"] = checks["secret"] & (F.size(F.array_distinct(F.split("hit", ""))) >= SECRET_CHARACTERS)
    label = F.lit(False)
    for kind, check in checks.items():
        label = label | ((F.col("kind") == kind) & check)
    return F.coalesce(label & ~F.lower("before").rlike(AGAINST), F.lit(False)).cast("double")


def features() -> dict[str, Column]:
    """Shape and context of a candidate as numbers; nothing that ``valid`` looks at."""
    hit, before = F.col("hit"), F.lower("before")
    number = lambda pattern: F.regexp_count(hit, F.lit(pattern)).cast("double")
    named = F.lit(False)
    for kind, words in NAMES.items():
        named = named | ((F.col("kind") == kind) & before.rlike(words))
    flags = {
        "named": named,
        "assigned": before.rlike(r"[=:]\s*[\"']?\z"),
        "quoted": before.rlike(r"[\"']\z") & F.col("after").rlike(r"[\"']"),
        "after_letter": F.col("before").rlike(r"[A-Za-z0-9]\z"),
        "after_sign": F.col("before").rlike(r"[^A-Za-z0-9\s]\z"),
        "before_letter": F.col("after").rlike("[A-Za-z0-9]"),
        "numbers_before": before.rlike("[0-9]"),
    }
    return {
        "length": F.length(hit).cast("double"),
        "spaces": number("[\\x20-]"),
        "dots": number("[.]"),
        "brackets": number("[()\\[\\]]"),
        "kind": F.array_position(F.array(*map(F.lit, ORDER)), F.col("kind")).cast("double"),
        **{k: F.coalesce(v, F.lit(False)).cast("double") for k, v in flags.items()},
    }


def _vectors(rows: DataFrame) -> DataFrame:
    columns = features()
    numbers = rows.select("*", *[c.alias(f"f_{n}") for n, c in columns.items()])
    return VectorAssembler(inputCols=[f"f_{n}" for n in columns], outputCol="features").transform(numbers)


def scored(loose: DataFrame) -> DataFrame:
    """Loose candidates with label and score, of trees trained on a bounded sample of every kind."""
    sizes = {r["kind"]: r["count"] for r in loose.groupBy("kind").count().collect()}  # at most a row for each kind
    draw = F.pmod(F.xxhash64("doc_id", "kind", "start", "hit"), F.lit(1 << 62))
    drawn = F.lit(False)
    for kind, n in sorted(sizes.items()):
        drawn = drawn | ((F.col("kind") == kind) & (draw <= int(min(1.0, TRAIN_ROWS / n) * (1 << 62))))
    label = valid().alias("label")
    sample = stored(_vectors(loose.where(drawn)).select("features", label), "pii-sample")
    labels = [r.label for r in sample.select("label").distinct().collect()]
    kept = ["row", "kind", "start", "end", label]
    if len(labels) < 2:
        return _vectors(loose).select(*kept, F.lit(labels[0] if labels else 0.0).alias("score"))
    model = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.2, seed=7, cacheNodeIds=False).fit(sample.coalesce(1))
    score = F.round(vector_to_array("probability")[1], SCORE_DIGITS)
    return model.transform(_vectors(loose)).select(*kept, score.alias("score"))


def thresholds(candidates: DataFrame) -> dict[str, float]:
    """For each kind that has one, the lowest score at which the candidates from there up have the precision."""
    histogram = candidates.groupBy("kind", "score").agg(F.count("*").alias("n"), F.sum("label").alias("positive"))
    above = Window.partitionBy("kind").orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, 0)
    curve = histogram.select("kind", "score", (F.sum("positive").over(above) / F.sum("n").over(above)).alias("precision"))
    return {r.kind: r.score for r in curve.where(F.col("precision") >= PRECISION).groupBy("kind").agg(F.min("score").alias("score")).collect()}


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (``row, doc_id``) and spans ``row, kind, start, end, base, score``."""
    rows, found = candidates(docs)
    placed = stored(found, "pii-candidates")
    base = placed.where("NOT loose AND passes").select("row", "kind", "start", "end", F.lit(True).alias("base"), F.lit(1.0).alias("score"))
    loose = stored(scored(placed.where("loose")), "pii-scores")
    enough = F.lit(False)
    for kind, least in thresholds(loose).items():
        enough = enough | ((F.col("kind") == kind) & (F.col("score") >= least))
    more = loose.where(enough).select("row", "kind", "start", "end", F.lit(False).alias("base"), "score")
    # A loose span goes if a base span of its kind overlaps it: in order of start, the furthest base end so far, or
    # the nearest base start still to come, tells.
    both = base.union(more)
    upto = Window.partitionBy("row", "kind").orderBy("start", F.desc("base")).rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy("row", "kind").orderBy("start", F.desc("base")).rowsBetween(0, Window.unboundedFollowing)
    kept = (
        both.withColumn("reach", F.max(F.when(F.col("base"), F.col("end"))).over(upto))
        .withColumn("following", F.min(F.when(F.col("base"), F.col("start"))).over(onward))
        .where(F.col("base") | ((F.coalesce("reach", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("following") >= F.col("end"), F.lit(True))))
        .drop("reach", "following")
    )
    return rows, kept


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every document."""
    rows, found = spans(docs)
    place = F.array_position(F.array(*map(F.lit, ORDER)), F.col("kind"))
    item = F.struct("start", place.alias("place"), "end", F.concat_ws(":", "kind", "start", "end").alias("text"))
    joined = lambda items: F.concat_ws(",", F.transform(F.array_sort(items), lambda x: x["text"]))
    summed = found.groupBy("row").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE],
        joined(F.collect_list(F.when(F.col("base"), item))).alias("base_spans"),
        joined(F.collect_list(item)).alias("spans"),
    )
    return rows.join(summed, "row", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
