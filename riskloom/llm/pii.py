"""Personal data by candidate gradient boosting, in DataFrame and SQL functions only.

Wide generators propose overlapping spans (anything around an at sign, spelled-out and bracketed addresses, runs and groups of digits, numbers in dotted
or bracketed parts, local phone numbers); the rules of four kinds (e-mail, IP address, card, phone) propose theirs. Every candidate gets features of its
format and its context. Boosted trees learn which of them are personal data from two teachers. The rules' values are rewritten into formats that only the
wide generators propose (``_rewritten``): accepted values are positives; refused ones, shortened ones and ordinary words in the form of an address are
negatives, each in its own context. And what the wide generators hit in the text itself, apart from every accepted span, is taken as ordinary with a quarter of
a row's weight: a little real data among it does no harm, much of it lets the trees add less. The trees are fitted on a bounded sample; a threshold per
kind is set on all rewritten values kept from them, at the wanted precision. Selected are all spans that the rules accept, and candidates of the wide
generators that lie apart from them and reach their threshold. Added spans that overlap become one, of the kind of the likeliest.

Positions are code points, the end exclusive. Pieces between matches give the places of matches, in one window per text. The lengths in the wide patterns
bound what is proposed: an address name of up to 64 characters, a number of up to 23 digits.

Defined results: null and empty texts have no spans; a table without both positives and negatives adds none to the rules' spans; repeated rows
repeat their result (a text is known by a digest of its id and characters); other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.llm.training import lowest_hashes
from riskloom.session import materialize

SAMPLE_ROWS = 20_000  # candidates the trees are fitted on, at most
PRECISION = 0.97
BINS = 50
KINDS = ("email", "ip", "card", "phone")  # fixed order of the result

# The four rules. Possessive groups and look-behinds keep them linear on long runs; they match what the plain patterns match.
RULES = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SPELLED = r"(?i)[a-z0-9._-]{2,40}\s?[\[(]?\s?\bat\b\s?[\])]?\s?[a-z0-9-]{2,40}\s?[\[(]?\s?\bdot\b\s?[\])]?\s?[a-z]{2,10}"
BRACKETED = r"(?i)[a-z0-9._%+-]{1,64}\s?[\[({<]\s?at\s?[\])}>]\s?[a-z0-9-]{1,63}(?:(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?)[a-z0-9-]{2,63}){1,8}"
# kind, pattern, and what a text must hold to be searched
WIDE = [
    ("email", r"(?:(?<!\S)|\G)[^\s@]{1,64}@[^\s@]{1,255}", "@"),
    ("email", SPELLED, r"(?i)\bdot\b"),
    ("email", BRACKETED, r"(?i)[\[({<]\s?at\s?[\])}>]"),
    ("ip", r"(?<![0-9])[0-9]{1,3}(?:[.:,][0-9]{1,3}){3,5}", "[0-9]"),
    ("ip", r"(?<![0-9])[0-9]{1,3}(?:\s?[\[(]\s?(?:\.|dot)\s?[\])]\s?[0-9]{1,3}){3}(?![0-9])", r"[0-9]\s?[\[(]"),
    ("card", r"[0-9](?:[\x20._/-]{0,2}[0-9]){11,22}", "[0-9]"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])", "[0-9]{13}"),
    ("phone", r"(?:\+|(?<![0-9A-Za-z./-])00|\()[0-9][\x20()./0-9-]{6,20}[0-9]", "[0-9]"),
    ("phone", r"(?<![0-9+().-])[2-9][0-9]{2}([.-])[2-9][0-9]{2}\1[0-9]{4}(?![0-9])", "[0-9][.-][0-9]"),
]
# fixed values: common last parts of host names that are no words; those of accepted addresses join them
TAILS = "com org net edu gov mil info biz io eu de fr nl pl ch uk ca au br mx jp cn ru".split()
TAIL_SHARE = 0.001  # of the accepted addresses
ORDINARY_WEIGHT = 0.25


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(v: Column) -> Column:
    """Check digit of a number of at most 19 digits; longer ones are false."""
    d = _digits(v)
    n = F.length(d)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.when(
        F.pmod(n - i, F.lit(2)) == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(d, i, F.lit(1)).cast("int") + 1)).otherwise(F.substring(d, i, F.lit(1)).cast("int")))
    return F.when((n >= 1) & (n <= 19), F.pmod(total, F.lit(10)) == 0).otherwise(False)


def _small_parts(v: Column) -> Column:
    """All dotted parts are numbers up to 255."""
    def small(p):
        p = F.regexp_replace(p, "^0+(?=[0-9])", "")
        return (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(256)) <= 255)

    return F.forall(F.split(v, r"\."), small)


def accepted(kind: Column, v: Column) -> Column:
    """The rule's check after its pattern has matched."""
    n = F.length(_digits(v))
    return F.when(kind == "email", True).when(kind == "ip", _small_parts(v)).when(kind == "card", F.when(n.between(13, 19), luhn(v)).otherwise(False)).otherwise(n.between(9, 15))


def _proposals(text: Column) -> Column:
    """All patterns with their matches and the pieces between, as one array; texts without the needed characters are not searched."""
    rules = zip(KINDS, RULES.values(), ("@", "[0-9]", "[0-9]", "[+]"))
    jobs = [(kind, rule, pattern, text.rlike(needs)) for rule, found in ((True, rules), (False, WIDE)) for kind, pattern, needs in found]
    return F.array(*[F.struct(
        F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), F.lit(j).alias("generator"),
        F.when(needs, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("found"),
        F.when(needs, F.split(text, pattern, -1)).alias("between")) for j, (kind, rule, pattern, needs) in enumerate(jobs)])


def candidates(rows: DataFrame) -> DataFrame:
    """row, kind, rule, start, end, value, before, after; ``rows`` has row and text."""
    proposed = rows.select("row", F.explode(_proposals(F.col("text"))).alias("p")).where(F.size("p.found") > 0)
    each = proposed.select("row", F.col("p.kind").alias("kind"), F.col("p.rule").alias("rule"), F.col("p.generator").alias("generator"), F.col("p.between").alias("between"), F.posexplode("p.found").alias("i", "value"))
    each = each.select("row", "kind", "rule", "generator", "i", "value", F.right(F.get("between", F.col("i")), F.lit(24)).alias("before"), F.left(F.get("between", F.col("i") + 1), F.lit(4)).alias("after"),
                       (F.char_length(F.get("between", F.col("i"))) + F.char_length("value")).cast("bigint").alias("step"))
    by = Window.partitionBy("row", "generator")
    upto = by.orderBy("i").rangeBetween(Window.unboundedPreceding, 0)
    times = F.count_if(F.col("i") == 0).over(by)  # a row that is there twice has every match twice
    end = (F.sum("step").over(upto) / times).cast("bigint")
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.char_length("value"))
    return placed.dropDuplicates(["row", "generator", "i"]).drop("generator", "i", "step")


FEATURES = [*(f"is_{k}" for k in KINDS), "reads", "chars", "digits", "letters", "dots", "dashes", "spaces", "parens", "plus", "at", "dots_after_at", "parts", "longest_part", "check_digit", "glued_before", "glued_after",
            "known_tail", "says_at", "brackets", "no_name", "says_mail", "says_phone", "says_card", "says_host"]


def _reads(kind: Column, v: Column, known_tail: Column) -> Column:
    """With at, dot and prefix signs undone the value has its kind's form: parts up to 255, the check digit, 9 to 15 digits, or a host of known end."""
    dots = F.regexp_replace(v, r"(?i)\s?[\[({<]\s?(?:\.|dot)\s?[\])}>]\s?|\s\bdot\b\s", ".")
    address = F.regexp_replace(dots, r"(?i)\s?[\[({<]\s?at\s?[\])}>]\s?|\s\bat\b\s", "@")
    n = F.length(_digits(F.regexp_replace(v, "^00", "")))
    return (F.when(kind == "email", known_tail & address.rlike(r"(?i)\A[\p{L}0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)+\z"))
            .when(kind == "ip", F.when(dots.rlike(r"\A[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z"), _small_parts(dots)).otherwise(False))
            .when(kind == "card", n.between(13, 19) & luhn(v)).otherwise(n.between(9, 15)))


def with_features(found: DataFrame, tails: list[str]) -> DataFrame:
    """Format and context as numbers; ``tails`` are known last parts of host names."""
    v, before = F.col("value"), F.lower("before")
    count = lambda cls: F.regexp_count(v, F.lit(cls)).cast("double")
    numbers = F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))
    known_tail = F.regexp_extract(F.lower(v), "([a-z]+)[^a-z]*$", 1).isin(tails)
    values = {
        "reads": _reads(F.col("kind"), v, known_tail).cast("double"), **{f"is_{k}": (F.col("kind") == k).cast("double") for k in KINDS}, "chars": F.char_length("value").cast("double"), "digits": count("[0-9]"), "letters": count("[A-Za-z]"), "dots": count(r"\."), "dashes": count("-"), "spaces": count(r"\s"), "parens": count("[()]"),
        "plus": v.startswith("+").cast("double"), "at": v.contains("@").cast("double"), "dots_after_at": F.regexp_count(F.regexp_extract(v, "@(.*)", 1), F.lit(r"\.")).cast("double"),
        "parts": count("[0-9]+"), "longest_part": F.array_max(F.transform(numbers, F.length)).cast("double"), "check_digit": luhn(v).cast("double"),
        "glued_before": before.rlike(r"[a-z0-9]$").cast("double"), "glued_after": F.col("after").rlike("^[A-Za-z0-9]").cast("double"),
        "known_tail": known_tail.cast("double"), "says_at": v.rlike(r"(?i)\bat\b").cast("double"), "brackets": count(r"[\[\]{}<>]"),
        "no_name": v.rlike(r"(?i)\bat\s(?:the|an?|this|that|our|your|my|his|her|their|its|each|every|no|one)\b").cast("double"),
        "says_mail": before.rlike("mail|contact").cast("double"), "says_phone": before.rlike("phone|tel|call|mobile|fax").cast("double"),
        "says_card": before.rlike("card|visa|pay|account").cast("double"), "says_host": before.rlike("host|server|addr|ip").cast("double"),
    }
    return found.withColumns({k: F.coalesce(x, F.lit(0.0)) for k, x in values.items()})


def _teach(found: DataFrame) -> DataFrame:
    """Adds ok (the rule accepts it) and touches (it overlaps an accepted span)."""
    found = found.withColumn("ok", F.col("rule") & accepted(F.col("kind"), F.col("value")))
    row = Window.partitionBy("row")
    earlier = F.max(F.when(F.col("ok"), F.col("end"))).over(row.orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    later = F.min(F.when(F.col("ok"), F.col("start"))).over(row.orderBy("start").rangeBetween(0, Window.unboundedFollowing))
    touches = F.coalesce(earlier > F.col("start"), F.lit(False)) | F.coalesce(later < F.col("end"), F.lit(False))
    return found.withColumn("touches", touches)


def _rewritten(found: DataFrame) -> DataFrame:
    """Adds made and label: the rules' values in formats of the wide generators with their label, and each candidate itself.

    A candidate of a wide generator apart from all accepted spans is labelled as ordinary, other candidates have no label.
    """
    v, ok, digits = F.col("value"), F.col("ok").cast("double"), _digits(F.col("value"))
    no, yes = F.lit(0.0), F.lit(1.0)

    def made(kind: str, *forms: tuple[Column, Column], of: str | None = None) -> list[Column]:
        return [F.when(F.col("rule") & (F.col("kind") == (of or kind)), F.struct(F.lit(kind).alias("kind"), value.alias("value"), label.alias("label"), F.lit(True).alias("made"))) for value, label in forms]

    def address(v: Column) -> list[tuple[Column, Column]]:
        dotted = F.regexp_replace(v, r"\.(?=[^@]*$)", " [dot] ")
        return [(F.regexp_replace(v, r"^(.*)@(?:.*\.)?([^.@]+)\.([^.@]+)$", "$1 at $2 dot $3"), yes), (F.regexp_replace(v, "@", "é@"), yes), (F.regexp_replace(v, "@", "(at)"), yes),
                (F.regexp_replace(dotted, "@", " [at] "), yes), (F.regexp_extract(v, r"^[^@]+@[^.@]+", 0), no)]

    words = F.slice(F.reverse(F.regexp_extract_all("before", F.lit(r"\p{L}{2,}"), F.lit(0))), 1, 3)
    word = lambda i: F.get(words, F.lit(i))
    ordinary = [(F.concat(word(2), F.lit(" at "), word(1), F.lit(" dot "), word(0)), no), (F.concat(word(0), F.lit(" at the dot com")), no)]
    abroad = F.concat(F.lit("00"), F.substring(v, 2, 1 << 30))
    bracket = F.regexp_extract(v, r"\(.*", 0)
    local = F.right(digits, F.lit(10))
    forms = F.array(
        *made("email", *address(v), *address(F.regexp_replace(v, "[._+-]?[0-9]+", "")), *address(F.regexp_replace(v, r"^([^@]{1,4})[^@]*@(?:.*\.)?([^.@]+\.[^.@]+)$", "$1@$2")), *ordinary),
        *made("ip", (F.regexp_replace(v, r"\.", "[.]"), ok), *[(F.regexp_replace(F.regexp_replace(v, part, wrong), r"\.", "[.]"), no) for part, wrong in ((r"\.[0-9]+", ".999"), (r"\.[0-9]+$", ".300"), (r"^[0-9]+", "260"))]),
        *made("card", (F.regexp_replace(digits, "(.{4})(?=.)", "$1."), ok), (F.regexp_replace(digits, "(.{4})(?=.)", "$1/"), ok), (digits, ok)),
        *made("phone", (abroad, ok), (F.regexp_replace(abroad, "[^0-9]+", " "), ok), (F.regexp_replace(F.concat(F.lit("004"), F.substring(v, 2, 1 << 30)), "[^0-9]+", " "), ok * (F.length(digits) < 15).cast("double")), (bracket, ok * F.length(_digits(bracket)).between(9, 15).cast("double")),
              (F.concat(F.lit("("), F.substring(digits, 2, 2), F.lit(") "), F.substring(digits, 4, 6)), no),
              (F.regexp_replace(local, "^(...)(...)(....)$", "$1-$2-$3"), ok), (F.regexp_replace(local, "^(...)(...)(....)$", "$1.$2.$3"), ok)),
        *made("phone", (F.concat(F.lit("00"), F.left(digits, F.lit(13))), no), of="card"))
    wide = F.lit(False)
    for kind, pattern, _ in WIDE:
        wide = wide | ((F.col("v.kind") == kind) & F.col("v.value").rlike(rf"\A(?:{pattern})\z"))
    itself = F.array(F.struct(F.col("kind").alias("kind"), v.alias("value"), F.when(~F.col("rule") & ~F.col("touches"), no).alias("label"), F.lit(False).alias("made")))
    each = found.withColumn("v", F.explode(F.concat(itself, F.array_compact(forms)))).where(~F.col("v.made") | wide)
    return each.withColumns({n: F.col(f"v.{n}") for n in ("kind", "value", "label", "made")}).drop("v")


def _known_tails(found: DataFrame) -> list[str]:
    """The listed last parts, and those of at least a share of the accepted addresses (so no more than its inverse)."""
    tail = F.lower(F.regexp_extract("value", "[A-Za-z]+$", 0))
    counts = found.where(F.col("ok") & (F.col("kind") == "email")).groupBy(tail.alias("tail")).agg(F.count("*").alias("n"))
    of_all = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = counts.where((F.col("n") >= of_all * TAIL_SHARE) & (F.length("tail") > 0))
    return sorted({*TAILS, *(r["tail"] for r in common.collect())})


def _thresholds(scored: DataFrame) -> dict[str, float]:
    """Per kind, the least probability of a half or more from which on precision holds; none where it never does or nothing good is known."""
    bins = {(r["kind"], r["bin"]): r for r in scored.groupBy("kind", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()}  # kinds x bins rows
    out = {}
    for kind in KINDS:
        good = n = 0.0
        for b in range(BINS - 1, BINS // 2 - 1, -1):
            if (kind, b) in bins:
                good, n = good + bins[kind, b]["good"], n + bins[kind, b]["n"]
            if good < PRECISION * n:
                break
            if good:
                out[kind] = b / BINS
    return out


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, and spans: array of (kind, start, end, base), by kind as listed, then start."""
    rows = docs.select(c(id_col).alias("doc_id"), F.coalesce(c(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), F.col("text")))))
    proposed = materialize(_teach(candidates(rows)), "pii-proposed")
    order = F.xxhash64("row", "kind", "start", "end", "rule", "value")
    found = materialize(with_features(_rewritten(proposed), _known_tails(proposed)).withColumn("h", order).drop("before", "after", "value"), "pii-candidates")
    taught, found = found.where(F.col("label").isNotNull()), found.where("NOT made")
    bound = lowest_hashes(taught, "h", sample_rows)
    sample = materialize(taught.where(F.col("h") < bound), "pii-sample")
    held = F.pmod("h", F.lit(5)) == 0
    n, good = sample.where(~held).agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    kept = found.where("ok").select("row", rank.alias("rank"), "start", "end", F.lit(True).alias("base"), "kind")
    if 0 < good < n:
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
        weighted = sample.where(~held).withColumn("weight", F.when(F.col("made"), 1.0).otherwise(ORDINARY_WEIGHT))
        model = GBTClassifier(maxIter=15, maxDepth=4, stepSize=0.2, seed=7, weightCol="weight").fit(assemble.transform(weighted).select("features", "label", "weight"))
        score = lambda df: model.transform(assemble.transform(df)).withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")
        limits = _thresholds(score(taught.where("made").where(held | (F.col("h") >= bound))))
        if limits:
            least = F.coalesce(*[F.when(F.col("kind") == k, F.lit(t)) for k, t in limits.items()], F.lit(2.0))
            added = score(found.where(~F.col("rule") & ~F.col("touches"))).where(F.col("p") >= least)
            kept = kept.unionByName(_joined(added.withColumn("rank", rank)))
    spans = kept.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("rank", "start", "end", "base", "kind"))).alias("spans"))
    return rows.select("doc_id", "row").join(spans, "row", "left").select("doc_id", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))


def _joined(added: DataFrame) -> DataFrame:
    """Added spans that overlap as one, of the kind of the likeliest (on ties the first listed)."""
    by = Window.partitionBy("row").orderBy("start", "end", "rank", "p")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    opened = added.withColumn("opens", F.when(before > F.col("start"), 0).otherwise(1))
    numbered = opened.withColumn("run", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max_by(F.struct("rank", "kind"), F.struct("p", -F.col("rank")))
    each = numbered.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), best.alias("best"))
    return each.select("row", F.col("best.rank").alias("rank"), "start", "end", F.lit(False).alias("base"), F.col("best.kind").alias("kind"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts per kind and digest of the rules' spans, and all spans as text."""
    found = find_personal_data(docs)
    base = F.filter("spans", lambda s: s["base"])
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
