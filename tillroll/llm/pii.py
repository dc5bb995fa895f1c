"""Personal data: exact base patterns, and bootstrapped contextual extraction.

Base spans are the leftmost, non-overlapping matches of four kinds (email, ip,
card, phone) that pass a check.  They are the seeds.  The words around a span
are its lexical patterns: the two before it, and the one before with the one
after.  Patterns and the values met in them make a graph that Spark scores in
rounds: a pattern's confidence is the mean score of its distinct values, a
value's score is 1 minus the product of the doubts of its confident patterns.
Candidates are tokens that hold a digit or an @, and runs of number groups
joined by a space, a hyphen or brackets.  Those that overlap no base span are
added where a confident pattern stands around them and they look like its kind;
of added spans the longest stays.  Copies of a text add nothing to a pattern:
values are counted once.

Words are whole, whatever their length, and those around a base span and around
a candidate are read alike from the text around them.  They reach back and
forth over two other matches of the kind: only a word that holds more than two
(a list of addresses without white space) is cut.

Only DataFrame functions run: regular expressions give matches and the pieces
between them, whose lengths give the places.  The expressions are those of the
kinds in linear form (possessive, and no start inside a run that has failed).

Defined cases: null is empty; empty texts and empty tables have no spans; a very
long text is read whole, in time linear in its length; rows equal in doc_id and
text share their spans; null ids work as any other; a token that patterns of
several kinds find takes the kind of the surest (ties: the later name); extra
columns are kept by ``redact``, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, packed, text_or_empty

_LOCAL, _SPACE = r"A-Za-z0-9._%+-", r"\x20\x09-\x0D"
KINDS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # 14 digits or more; a shorter run holds no longer one
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Tokens that may be identifiers: they hold a digit or an @.
TOKEN = rf"(?<![^{_SPACE}])[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+"
#: Number groups that a space, a hyphen or brackets join.
RUN = rf"(?<![^{_SPACE}])\(?[0-9]++(?:\)?[\x20-]?\(?[0-9]++)++"
#: Most digits of a run: those of the longest card number.
RUN_DIGITS = 19
CANDIDATES = {"token": TOKEN, "run": RUN}
#: A longer pattern is stood for by its SHA-256.
LONG = 200
NUMBER = {kind: k for k, kind in enumerate(KINDS)}
#: A pattern needs so many distinct seeds, and a value or pattern this score; rounds of scoring.
SEEDS, CONFIDENT, ROUNDS = 3, 0.8, 3


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = _digits(value)
    n = F.length(d)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(d, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    return n.between(14, 19) & (F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0)


def _passes(kind: Column, value: Column) -> Column:
    part = r"0*+(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    # leading zeros may leave no digit behind them
    part = rf"(?:{part}|0++)"
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
        .when(kind == "card", F.when(F.length(_digits(value)).between(14, 19), _luhn(value)).otherwise(False))
        .when(kind == "phone", F.length(_digits(value)).between(10, 15))
        .when(kind == "run", F.length(_digits(value)) <= RUN_DIGITS)
        .otherwise(True)
    )


def _looks_like(kind: Column, value: Column) -> Column:
    """Whether a candidate can be an identifier of a kind."""
    digits = F.length(_digits(value))
    return (
        F.when(kind == "email", value.contains("@") & (F.length(value) >= 5))
        .when(kind == "ip", (digits >= 4) & value.rlike(r"[.:].*[.:]"))
        .when(kind == "card", digits >= 12)
        .otherwise(digits >= 7)
    )


def _matches(keyed: DataFrame, kind: str, pattern: str, hint: Column | None) -> DataFrame:
    """Every match of a kind with the whole words around it: one row a match."""
    space, word = f"[{_SPACE}]", f"[^{_SPACE}]"
    rows = keyed if hint is None else keyed.where(hint)
    rows = rows.withColumn("m", F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).where(F.size("m") > 0)
    rows = rows.withColumn("p", F.split("text", pattern, -1)).select(
        "doc_id", "th", "m", F.transform("p", F.length).alias("gaps"),
        # the ends of each piece: its last two words, backwards, and its first word
        F.transform("p", lambda p: F.regexp_extract(F.reverse(p), f"^{space}*+{word}*+{space}*+{word}*+{space}?", 0)).alias("q"),
        F.transform("p", lambda p: F.regexp_extract(p, f"^{space}*+{word}*+{space}?", 0)).alias("h"),
    )
    at = lambda name, i: F.coalesce(F.get(name, i), F.lit(""))
    back = lambda i: F.concat(at("q", i), F.reverse(at("m", i - 1)), at("q", i - 1), F.reverse(at("m", i - 2)), at("q", i - 2))
    ahead = lambda i: F.concat(at("h", i + 1), at("m", i + 1), at("h", i + 2), at("m", i + 2), at("h", i + 3))
    each = F.transform("m", lambda v, i: F.struct(v.alias("value"), F.get("gaps", i).alias("gap"), back(i).alias("back"), ahead(i).alias("ahead")))
    rows = rows.select("doc_id", "th", F.lit(kind).alias("kind"), F.posexplode(each).alias("at", "x"))
    words = lambda c, what: F.lower(F.regexp_extract(c, f"^{space}*+({what})", 1))
    return rows.select(
        "doc_id", "th", "kind", "at", "x.value", "x.gap", F.reverse(words("x.back", f"{word}++{space}++{word}++")).alias("two"),
        F.reverse(words("x.back", f"{word}++")).alias("last"), words("x.ahead", f"{word}++").alias("following"),
    )


def mentions(docs: DataFrame) -> DataFrame:
    """All matches of the kinds that pass, and all candidates that overlap none
    of them (kind null): doc_id, th, kind, value, lo, hi (characters), and the words
    around: two (the two before), last (the one before), following."""
    keyed = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("th"), text_or_empty().alias("text"))
    hints = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+"), "ip": F.col("text").contains(".")}
    found = [_matches(keyed, kind, pattern, hints.get(kind)) for kind, pattern in {**KINDS, **CANDIDATES}.items()]
    rows = reduce(DataFrame.union, found).repartition("doc_id", "th", "kind").dropDuplicates(["doc_id", "th", "kind", "at"])
    upto = F.sum(F.col("gap") + F.length("value")).over(Window.partitionBy("doc_id", "th", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("hi", upto.cast("long")).withColumn("lo", F.col("hi") - F.length("value")).where(_passes(F.col("kind"), F.col("value")))
    is_base = ~F.col("kind").isin(*CANDIDATES)
    by_place = Window.partitionBy("doc_id", "th").orderBy("lo", "hi", "kind")
    behind = F.max(F.when(is_base, F.col("hi"))).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(is_base, F.col("lo"))).over(by_place.rowsBetween(1, Window.unboundedFollowing))
    free = is_base | ((F.coalesce(behind, F.lit(0)) <= F.col("lo")) & (F.coalesce(ahead, F.col("hi")) >= F.col("hi")))
    rows = rows.withColumn("free", free).where("free")
    return rows.select("doc_id", "th", F.when(is_base, F.col("kind")).alias("kind"), "value", "lo", "hi", "two", "last", "following")


def _patterns(rows: DataFrame) -> DataFrame:
    """One row for each mention and pattern around it."""
    two, last, following = F.col("two"), F.col("last"), F.col("following")
    around = F.array(F.when(two != "", F.concat(F.lit("L "), two)), F.when((last != "") & (following != ""), F.concat(F.lit("A "), last, F.lit(" _ "), following)))
    rows = rows.withColumn("pattern", F.explode(F.array_compact(around))).drop("two", "last", "following")
    return rows.withColumn("pattern", F.when(F.length("pattern") > LONG, F.sha2("pattern", 256)).otherwise(F.col("pattern")))


def discover(rows: DataFrame) -> DataFrame:
    """The candidates that confident patterns find, none inside another: doc_id, th, kind, lo, hi."""
    met = _patterns(rows)
    edges = materialize(met.groupBy("pattern", "value").agg(F.min("kind").alias("seed")), "pii-edges")
    # patterns without enough seeds of a kind never count
    seeded = edges.where("seed is not null").groupBy("pattern", F.col("seed").alias("kind")).agg(F.count("*").alias("n_seeds")).where(F.col("n_seeds") >= SEEDS).select("pattern", "kind")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n_values"))
    graph = materialize(edges.join(seeded, "pattern").join(sizes, "pattern"), "pii-graph")
    known = F.when(F.col("seed") == F.col("kind"), 1.0).when(F.col("seed").isNotNull(), 0.0)
    confident = None
    for _ in range(ROUNDS):
        scored = graph.withColumn("own", known)
        if confident is not None:
            doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
            values = graph.where("seed is null").join(confident, ["pattern", "kind"]).groupBy("value", "kind").agg((1 - doubt).alias("found"))
            scored = scored.join(values, ["value", "kind"], "left").withColumn("own", F.coalesce("own", "found"))
        confidence = F.sum(F.coalesce("own", F.lit(0.0))) / F.sum(F.lit(1.0))
        confident = scored.groupBy("pattern", "kind").agg(confidence.alias("confidence")).where(F.col("confidence") >= CONFIDENT * 0.75)
        confident = materialize(confident, "pii-patterns")
    sure = confident.where(F.col("confidence") >= CONFIDENT)
    tokens = met.where("kind is null").drop("kind").join(sure, "pattern").where(_looks_like(F.col("kind"), F.col("value")))
    # one kind for a token: that of its surest pattern
    best = F.max(F.struct("confidence", F.col("kind").alias("best"))).getField("best")
    found = tokens.groupBy("doc_id", "th", "lo", "hi").agg(best.alias("kind"))
    by_place = Window.partitionBy("doc_id", "th").orderBy("lo", F.col("hi").desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("upto", F.coalesce(F.max("hi").over(by_place), F.lit(0))).where("hi > upto")
    return found.select("doc_id", "th", "kind", "lo", "hi")


def spans(docs: DataFrame) -> DataFrame:
    """All spans, one a row: doc_id, th, kind, lo, hi, added."""
    rows = materialize(mentions(docs), "pii-mentions")
    base = rows.where("kind is not null").select("doc_id", "th", "kind", "lo", "hi", F.lit(False).alias("added"))
    return base.union(discover(rows).withColumn("added", F.lit(True)))


def _number() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in NUMBER.items() for x in kv]), F.col("kind"))


def _with_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with _th and the sorted list _s of their spans (empty if none)."""
    listed = found.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th2")).agg(
        F.sort_array(F.collect_list(F.struct("lo", _number().alias("number"), "hi", "kind", "added"))).alias("_s")
    )
    keyed = docs.withColumn("_th", F.xxhash64(text_or_empty()))
    none = F.array().cast(listed.schema["_s"].dataType)
    return keyed.join(listed, keyed.doc_id.eqNullSafe(listed._id) & (keyed._th == listed._th2), "left").withColumn("_s", F.coalesce("_s", none)).drop("_id", "_th2")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    joined = _with_spans(docs.select("doc_id", "text"), spans(docs))
    text = lambda s: F.concat_ws(":", s["kind"], s["lo"].cast("string"), s["hi"].cast("string"))
    base = F.filter("_s", lambda s: ~s["added"])
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [of(kind).alias(f"n_{kind}") for kind in KINDS]
    return joined.select(
        "doc_id", *counts, F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("_s", text), ",").alias("spans"), F.size(F.filter("_s", lambda s: s["added"])).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; where spans
    overlap, the rest of the later one is replaced after the earlier."""
    found = spans(docs)
    by_place = Window.partitionBy("doc_id", "th").orderBy("lo", _number(), "hi").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("_end", F.coalesce(F.max("hi").over(by_place), F.lit(0))).where("hi > _end")
    found = found.withColumn("_end", F.greatest(F.col("_end"), F.lit(0))).withColumn("lo", F.greatest("lo", "_end")).drop("_end")
    joined = _with_spans(packed(docs), found)
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_s", lambda s: s["hi"]))
    piece = F.transform(
        F.arrays_zip(F.col("_s").alias("s"), F.slice(ends, F.lit(1), F.size("_s")).alias("e")),
        lambda z: F.concat(F.substring(F.col("text"), (z["e"] + 1).cast("int"), (z["s"]["lo"] - z["e"]).cast("int")), F.lit("["), F.upper(z["s"]["kind"]), F.lit("]")),
    )
    rest = F.substring(F.col("text"), (F.element_at(ends, -1) + 1).cast("int"), F.length("text"))
    cleaned = F.when(F.size("_s") > 0, F.concat(F.array_join(piece, ""), rest)).otherwise(F.col("text"))
    return joined.select(F.col("_row").withField("text", cleaned).alias("_row")).select("_row.*")
