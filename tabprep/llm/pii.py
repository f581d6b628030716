"""Personal data: generators propose spans, boosted trees score them by format and context, thresholds select."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import body, checkpointed, name

KINDS = ("email", "ip", "card", "phone")
# The strict patterns. A look-behind keeps a failed run from being tried again at each of its places, and
# last groups are possessive, so that a run of any length is a loop in the matcher and not a recursion.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The high-recall generators: other separators, spelled-out signs, no leading plus. Their spans may overlap.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\x20?(?:@|\(at\)|\[at\])\x20?)[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{2,63}){1,8}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?[.,]\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9+])(?:00|\+)?\x20?\(?[0-9]{2,4}\)?[\x20./-][0-9]{2,4}[\x20./-][0-9]{3,4}(?:[\x20./-]?[0-9]{2,4})?(?![0-9])",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
CONTEXT = 30
BINS, PRECISION = 20, 0.95               # of the calibration, and what a threshold must reach on the held-out half
TREES, DEPTH = 12, 3


def _valid(kind: Column, text: Column) -> Column:
    digits = F.regexp_replace(text, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", text.rlike(f"^{PART}(?:\\.{PART}){{3}}$"))
        .when(kind == "card", n.between(13, 19) & F.call_function("luhn_check", F.when(n.between(13, 19), digits).otherwise(F.lit("1"))))
        .otherwise(n.between(9, 15)))


def _candidates(docs: DataFrame) -> DataFrame:
    """Every match of every pattern: key, mark, kind, strict, start, end, text, and what stands around it."""
    every = []
    for strict, patterns in ((True, STRICT), (False, LOOSE)):
        for kind in KINDS:
            found = F.regexp_extract_all(F.col("__body"), F.lit(patterns[kind]), F.lit(0))
            gaps = F.split(F.col("__body"), patterns[kind], -1)
            one = F.when(F.size(found) > 0, F.arrays_zip(found.alias("match"), gaps.alias("gap"), F.slice(gaps, 2, 1 << 30).alias("next")))
            every.append(F.struct(F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), one.alias("found")))
    rows = (
        docs.filter(F.col("__body").rlike("[0-9@]|\\((?:at|dot)\\)|\\[(?:at|dot)\\]"))
        .select("__id", "__mark", F.explode(F.array(*every)).alias("e")).filter("e.found is not null")
        .select("__id", "__mark", "e.kind", "e.strict", F.posexplode("e.found").alias("i", "f")).filter("f.match is not null")
        .select("__id", "__mark", "kind", "strict", "i", F.col("f.match").alias("match"),
                F.char_length("f.gap").alias("gap"), F.right("f.gap", F.lit(CONTEXT)).alias("before"), F.left(F.coalesce("f.next", F.lit("")), F.lit(CONTEXT)).alias("after"))
        .distinct())
    own = Window.partitionBy("__id", "__mark", "kind", "strict").orderBy("i")
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.char_length("match")).over(upto)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.char_length("match"))


def _features() -> dict[str, Column]:
    text, before, after = F.col("match"), F.lower("before"), F.lower("after")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return {
        **{f"is_{k}": flag(F.col("kind") == k) for k in KINDS},
        "length": F.least(F.char_length(text), F.lit(40)).cast("double"), "digits": F.least(count("[0-9]"), F.lit(24.0)),
        "letters": F.least(count("[A-Za-z]"), F.lit(24.0)), "dots": F.least(count("\\."), F.lit(8.0)),
        "dashes": F.least(count("-"), F.lit(8.0)), "spaces": F.least(count("\\x20"), F.lit(8.0)), "brackets": F.least(count("[()\\[\\]]"), F.lit(4.0)),
        "plus": flag(F.startswith(text, F.lit("+"))), "at": flag(F.contains(text, F.lit("@"))), "zero": flag(text.rlike("^0")),
        "longest_run": F.least(F.coalesce(F.array_max(F.transform(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)), F.length)), F.lit(0)), F.lit(20)).cast("double"),
        "high_part": flag(text.rlike("(?<![0-9])(?:2[6-9][0-9]|25[6-9]|[3-9][0-9]{2})(?![0-9])")),
        "glued_left": flag(before.rlike("[a-z0-9_.=/:#-]$")), "glued_right": flag(after.rlike("^[a-z0-9_=/:#-]")),
        "alone_left": flag(before.rlike("(?:^|[\\x20\\n(\"'])$")),
        "says_phone": flag(before.rlike("(?:phone|tel|call|fax|mobil|cell)[^a-z]*$")), "says_card": flag(before.rlike("(?:card|visa|credit|amex|iban|account)[^a-z]*$")),
        "says_net": flag(before.rlike("(?:ip|host|server|address|login)[^a-z]*$")), "says_mail": flag(before.rlike("(?:mail|contact|write)[^a-z]*$")),
        "says_other": flag(before.rlike("(?:version|release|isbn|issn|license|licence|token|order|id|no|page|section)[^a-z]*$")),
    }


def _thresholds(scored: DataFrame) -> dict[str, float]:
    """Per kind the lowest score at and above which the held-out candidates reach the precision."""
    counted = scored.filter("not fit").groupBy("kind", F.floor(F.col("p") * BINS).alias("bin")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("yes"))
    above = Window.partitionBy("kind").orderBy(F.col("bin").desc())
    reached = counted.withColumn("precision", F.sum("yes").over(above) / F.sum("n").over(above)).filter(F.col("precision") >= PRECISION)
    return {r["kind"]: r["bin"] / BINS for r in reached.groupBy("kind").agg(F.min("bin").alias("bin")).collect()}


def find_spans(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents with ``base`` and ``spans``: arrays of (kind, start, end), in code points, by kind and start.

    Strict patterns give the base: their matches, left to right, that pass the check of their kind (address parts,
    card digits and check digit, number of phone digits). Looser generators propose more, overlapping spans.
    Boosted trees learn from every match whose label is known (strict ones pass or fail their check; loose ones that
    touch a base span of their kind are right, those that touch another kind's or fail the check are not), by the
    format of the match and the words around it; the check digit itself is no feature. They are trained on counts of equal
    feature rows, so the training table is small for any corpus; half of the documents are held out, and per kind
    the lowest score that reaches the precision there is the threshold. A proposed span above it that
    touches no base span is added, of overlapping ones of a kind the first and longest.

    All in SQL functions and the trees of Spark's own library; rows of matches are shuffled, texts are not. Null and
    empty texts have no spans; with matches of one class only nothing is added; equal rows are found alike, and a
    null key is a key. Columns named base or spans are replaced, an empty table gives an empty table.
    """
    kept = docs.drop("base", "spans")
    text = body()
    marked = docs.select(name(key).alias("__id"), F.xxhash64(text).alias("__mark"), text.alias("__body"))
    found = checkpointed(_candidates(marked))
    found = found.withColumn("valid", F.col("strict") & _valid(F.col("kind"), F.col("match")))
    # what follows is looked at in reverse: a frame to the end would be gone through anew for every row
    group, upto = Window.partitionBy("__id", "__mark"), (Window.unboundedPreceding, -1)
    earlier = group.orderBy("start", F.col("valid").desc(), "end", "kind", "strict").rowsBetween(*upto)
    later = group.orderBy(F.desc("start"), "valid", F.desc("end"), F.desc("kind"), F.desc("strict")).rowsBetween(*upto)

    def touches(kind: str) -> Column:
        of_kind = F.col("valid") & (F.col("kind") == kind)
        left, right = F.max(F.when(of_kind, F.col("end"))).over(earlier), F.min(F.when(of_kind, F.col("start"))).over(later)
        return F.coalesce(left > F.col("start"), F.lit(False)) | F.coalesce(right < F.col("end"), F.lit(False))

    found = found.withColumns({f"__{k}": touches(k) for k in KINDS})
    own, other = F.lit(False), F.lit(False)
    for k in KINDS:
        own = own | ((F.col("kind") == k) & F.col(f"__{k}"))
        other = other | ((F.col("kind") != k) & F.col(f"__{k}"))
    label = F.when(F.col("strict"), F.col("valid")).when(own, F.lit(True)).when(other | ~_valid(F.col("kind"), F.col("match")), F.lit(False))
    found = found.withColumns({"label": label.cast("double"), "apart": ~F.col("strict") & ~own & ~other})
    base = found.filter("valid").select("__id", "__mark", "kind", "start", "end")
    made = _features()
    held = F.pmod(F.xxhash64("__id", "__mark"), F.lit(2)) == 0
    rows = checkpointed(found.select("__id", "__mark", "kind", "apart", "start", "end", "label", held.alias("fit"), *[c.alias(n) for n, c in made.items()]))
    table = checkpointed(rows.filter("label is not null").groupBy("kind", "label", "fit", *made).agg(F.count("*").cast("double").alias("n")).coalesce(1))
    assembler = VectorAssembler(inputCols=list(made), outputCol="features")
    every = base
    if {r["label"] for r in table.filter("fit").select("label").distinct().collect()} == {0.0, 1.0}:
        trees = GBTClassifier(labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=5, stepSize=0.3)
        model = trees.fit(assembler.transform(table.filter("fit")))
        chance = vector_to_array("probability")[1]
        limits = _thresholds(model.transform(assembler.transform(table)).withColumn("p", chance))
        limit = F.lit(None).cast("double")
        for kind, at in limits.items():
            limit = F.when(F.col("kind") == kind, F.lit(at)).otherwise(limit)
        loose = model.transform(assembler.transform(rows.filter("apart"))).withColumn("p", chance).filter(F.col("p") >= limit)
        loose = loose.select("__id", "__mark", "kind", "start", "end")
        both = base.withColumn("taken", F.lit(1)).union(loose.withColumn("taken", F.lit(0)))
        of_kind = Window.partitionBy("__id", "__mark", "kind")
        reach = F.max("end").over(of_kind.orderBy("start", F.col("taken").desc(), F.col("end").desc()).rowsBetween(*upto))
        soon = F.min(F.when(F.col("taken") == 1, F.col("start"))).over(of_kind.orderBy(F.desc("start"), "taken", "end").rowsBetween(*upto))
        free = (F.coalesce(reach, F.lit(-1)) <= F.col("start")) & (F.coalesce(soon, F.col("end")) >= F.col("end"))
        every = both.withColumn("free", free).filter((F.col("taken") == 1) | F.col("free")).select(*base.columns)
    rank = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    span = F.struct(rank.alias("rank"), "start", "end", "kind")
    tagged = base.withColumn("own", F.lit(True)).union(every.withColumn("own", F.lit(False)))
    joined = tagged.groupBy("__id", "__mark").agg(
        F.array_sort(F.collect_set(F.when(F.col("own"), span))).alias("base"), F.array_sort(F.collect_set(F.when(~F.col("own"), span))).alias("spans"))
    joined = joined.select(F.col("__id").alias("__k"), F.col("__mark").alias("__m"), "base", "spans")
    same = name(key).eqNullSafe(F.col("__k")) & (F.xxhash64(text) == F.col("__m"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    shaped = lambda c: F.when(F.col(c).isNotNull(), F.transform(F.col(c), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].cast("bigint").alias("start"), s["end"].cast("bigint").alias("end")))).otherwise(none)
    return kept.join(joined, same, "left").select(*[name(c) for c in kept.columns], shaped("base").alias("base"), shaped("spans").alias("spans"))
