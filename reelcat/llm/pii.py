"""Personal data: candidate spans scored by gradient-boosted trees, all in JVM expressions.

*Base spans* (email, ip, card, phone) follow fixed patterns and checks and always stay.
*Generators* of high recall propose further, possibly overlapping spans: numbers of nine
digits or more in any grouping, spelled-out addresses, long opaque tokens. Each candidate
has features of its format and of the text around it.

*Training* is weakly supervised. Positive: numbers that meet a base span of their kind, opaque
tokens named by a key, base spans rewritten into formats that the base patterns miss (other
separators, no country code, ``(at)``). Negative: only what its format or place rules out
(failing checks, wrong lengths, dates, quads, numbers after a serial's cue, ``at`` without a
mark, tokens no key names) and the like made from base spans. A candidate that may be data
is left out of training and of thresholds, so that a corpus full of rewritten data does not
teach the trees that it is clean. The trees are fitted on a sample bounded by ``train_rows``,
in which rare kinds and labels are kept whole. A quarter, by content, is held back from it; by
kind, the lowest score of a positive whose precision reaches ``precision`` on all that is held
back, of every document, is the threshold. A kind without positives there selects none.

*Scoring*: the trees become one expression per candidate. Tokens named by a key are selected as
such; the trees see no key's name and extend them by format, quotes and assignment. Selected
candidates that meet no base span and no better candidate are added. Every text is scanned
once; no shuffle but the training's sample and sums (by kind and rounded score).

Nulls: a null text is empty and has no spans. Equal rows fare alike. An empty table gives
an empty result; input columns travel in one struct.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcat.llm.common import packed, table, whole
from reelcat.session import stage_table

KINDS = ["email", "ip", "card", "phone", "secret"]
#: The base patterns, written so that a failing start is not tried again inside the same run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GUARD = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: Generators: name, the pattern, what a text must hold.
GENERATORS = {
    "number": (r"(?<![A-Za-z0-9])[+(]?[0-9](?:[\x20()./-]{0,2}+[0-9]){8,}+(?![A-Za-z0-9])", "[0-9]"),
    "spelled": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[(\[{]at[)\]}] ?| at )[A-Za-z0-9-]++(?:(?: ?[(\[{]dot[)\]}] ?| dot |\.)[A-Za-z0-9-]++)*+", "at"),
    "opaque": (r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+={0,2}+", "[0-9]"),
}
CUES = {
    "cue_phone": r"(?i)(?:phone|tel|call|fax|mobile|whatsapp|sms)[^a-z]{0,6}$",
    "cue_card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|iban)[^a-z]{0,6}$",
    "cue_mail": r"(?i)(?:mail|contact|write|reach)[^a-z]{0,6}$",
    "cue_serial": r"(?i)(?:order|serial|invoice|ticket|parcel|tracking|isbn|batch|ref(?:erence)?|no|nr|id)[^a-z]{0,6}$",
}
#: What names a secret: the label of opaque tokens, therefore no feature.
KEY_NAME = r"(?i)(?:token|key|secret|passw(?:or)?d|api|auth|bearer)[\"']? ?[=: ] ?[\"']?$"
DATE = r"^(?:19|20)[0-9]{2}([-./ ]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])(?![0-9])"
FEATURES = ["chars", "digits", "letters", "others", "spaces", "groups", "longest", "dots", "distinct", "plus", "parens", "zeros", "luhn", "dated",
            "hexadecimal", "mixed", "at_mark", "dot_word", "quoted", "assigned", *CUES, *[f"is_{g}" for g in GENERATORS]]
BLOCK = 256


def _steps(t: Column, pattern: str, guard: Column) -> Column:
    """Each match with the length of the gap before it: array<struct<g, k, m, b>>, b the last 24 characters before it."""
    parts = F.arrays_zip(F.split(t, pattern, -1).alias("g"), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("m"))
    met = F.filter(parts, lambda x: x["m"].isNotNull())
    return F.when(guard, F.transform(met, lambda x: F.struct(
        F.length(x["g"]).alias("g"), F.length(x["m"]).alias("k"), x["m"].alias("m"), F.right(x["g"], F.lit(24)).alias("b"))))


def _spans(steps: str) -> Column:
    """array<struct<start, m, b>> with starts in code points; ``steps`` names a column of _steps.

    Lengths are summed in blocks, then over blocks, so many matches don't copy one growing array each.
    """
    def at(x, by):
        return F.struct((x["start"] + by).alias("start"), x["m"].alias("m"), x["b"].alias("b"))

    def add(a, x):
        one = F.struct((a["at"] + x["g"]).alias("start"), x["m"].alias("m"), x["b"].alias("b"))
        return F.struct((a["at"] + x["g"] + x["k"]).alias("at"), F.concat(a["s"], F.array(one)).alias("s"))

    def join(a, x):
        return F.struct((a["at"] + x["at"]).alias("at"), F.concat(a["s"], F.transform(x["s"], lambda v: at(v, a["at"]))).alias("s"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,m:string,b:string>>").alias("s"))
    blocks = F.transform(F.sequence(F.lit(1), F.size(steps), F.lit(BLOCK)), lambda b: F.aggregate(F.slice(steps, b, BLOCK), zero, add))
    return F.when(F.size(steps) > 0, F.aggregate(blocks, zero, join)["s"]).otherwise(zero["s"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(m)).between(14, 19) & _luhn(_digits(m))
    return F.length(_digits(m)).between(10, 15)


def _groups(m: Column) -> Column:
    return F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))


def _longest(m: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(_groups(m), F.length)), F.lit(0))


def named_secret(x: Column) -> Column:
    """Whether a candidate is an opaque token with a digit that a key's name and an assignment come before."""
    return (x["generator"] == "opaque") & x["m"].rlike("[0-9]") & x["b"].rlike(KEY_NAME)


def features(m: Column, b: Column, generator: Column) -> dict[str, Column]:
    """The features of a candidate ``m`` after the text ``b``, as doubles."""
    def count(pattern):
        return F.length(m) - F.length(F.regexp_replace(m, pattern, ""))

    found = {
        "chars": F.length(m), "digits": count("[0-9]"), "letters": count("[A-Za-z]"), "others": count("[^A-Za-z0-9 ]"), "spaces": count(" "),
        "groups": F.size(_groups(m)), "longest": _longest(m), "dots": count("[.]"), "zeros": m.startswith("00"), "dated": m.rlike(DATE),
        "distinct": F.size(F.array_distinct(F.split(m, ""))), "plus": m.startswith("+"), "parens": m.contains("("),
        "luhn": F.coalesce(_luhn(_digits(m)), F.lit(False)), "hexadecimal": m.rlike("^[0-9a-f]+$"),
        "mixed": m.rlike("[0-9]") & m.rlike("[A-Za-z]"), "at_mark": m.rlike(r"[(\[{]at[)\]}]"), "dot_word": m.rlike(r" dot |[(\[{]dot[)\]}]"),
        "quoted": b.rlike("[\"']$"), "assigned": b.rlike("[=:] ?[\"']?$"),
    }
    found |= {name: b.rlike(cue) for name, cue in CUES.items()}
    found |= {f"is_{g}": generator == g for g in GENERATORS}
    return {k: found[k].cast("double") for k in FEATURES}


def proposed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, t, base, candidates): spans with their kind, start, end, text and features; one narrow pass."""
    df = packed(docs).withColumn("t", whole(F.col(f"row.`{text}`")))
    t = F.col("t")
    df = df.withColumns({f"s_{k}": _steps(t, p, t.contains(GUARD[k]) if GUARD[k] else t.rlike("[0-9]")) for k, p in BASE.items()}
                        | {f"s_{g}": _steps(t, p, t.rlike(need)) for g, (p, need) in GENERATORS.items()})
    df = df.withColumns({f"f_{k}": _spans(f"s_{k}") for k in [*BASE, *GENERATORS]})

    def span(x, kind, order, **more):
        return F.struct(x["start"].alias("start"), F.lit(order).alias("rank") if isinstance(order, int) else order.alias("rank"),
                        (x["start"] + F.length(x["m"])).alias("end"), kind.alias("kind"), x["m"].alias("m"), x["b"].alias("b"),
                        *[c.alias(n) for n, c in more.items()])

    def based(k):
        return F.transform(F.filter(f"f_{k}", lambda x: _valid(k, x["m"])), lambda x: span(x, F.lit(k), KINDS.index(k)))

    def candidate(g):
        def one(x):
            n = F.length(_digits(x["m"]))
            kind = {"number": F.when(n >= 14, "card").otherwise("phone"), "spelled": F.lit("email"), "opaque": F.lit("secret")}[g]
            rank = F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int") - 1
            return span(x, kind, rank, generator=F.lit(g), **features(x["m"], x["b"], F.lit(g)))

        some = F.filter("f_number", lambda x: F.length(_digits(x["m"])) <= 19) if g == "number" else F.col(f"f_{g}")
        return F.transform(some, one)

    return df.select("row", "t", F.array_sort(F.concat(*map(based, BASE))).alias("base"), F.concat(*map(candidate, GENERATORS)).alias("candidates"))


def _overlap(x: Column, y: Column) -> Column:
    return (x["start"] < y["end"]) & (y["start"] < x["end"])


@dataclass(frozen=True)
class Model:
    """Trees as (feature, threshold, left, right) or a leaf's value, with their weights; thresholds by kind."""

    trees: list = field(default_factory=list)
    thresholds: dict = field(default_factory=dict)

    def margin(self, value) -> Column:
        """The boosted score; ``value`` gives the column of a feature's name."""
        def walk(node):
            if not isinstance(node, tuple):
                return F.lit(float(node))
            name, threshold, left, right = node
            return F.when(value(name) <= threshold, walk(left)).otherwise(walk(right))

        total = F.lit(0.0)
        for weight, tree in self.trees:
            total = total + F.lit(float(weight)) * walk(tree)
        return total


def _tree(node):
    if node.subtreeDepth() == 0:
        return node.prediction()
    split = node.split()
    return (FEATURES[split.featureIndex()], split.threshold(), _tree(node.leftChild()), _tree(node.rightChild()))


def _label(x: Column, base: Column) -> Column:
    """1 for a candidate that is data, 0 for one that its format or place rules out, null for one that may be data."""
    met = F.filter(base, lambda y: _overlap(x, y))
    n, alike = x["digits"], F.exists(met, lambda y: y["kind"] == x["kind"])
    phone = ((n.between(10, 15) & x["groups"].between(2, 6) & (x["longest"] <= 5) & (x["dated"] == 0) & (x["cue_serial"] == 0)) | (x["cue_phone"] == 1))
    number = F.when(alike, 1.0).when(F.exists(met, lambda y: y["kind"] == "ip"), 0.0).when((F.size(met) == 0) & ~F.when(
        x["kind"] == "card", x["luhn"] == 1).otherwise(phone), 0.0)
    spelled = F.when((F.size(met) == 0) & (x["at_mark"] == 0) & (x["dot_word"] == 0), 0.0)
    opaque = F.when(named_secret(x), 1.0).when(F.size(met) == 0, 0.0)
    return F.when(x["generator"] == "number", number).when(x["generator"] == "spelled", spelled).otherwise(opaque)


def _rewritten(base: DataFrame) -> DataFrame:
    """Base spans in formats that the base patterns don't know, and the like that can't be data: (m, b, generator, kind, label)."""
    m, d = F.col("x.m"), _digits(F.col("x.m"))
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    bare, national = F.regexp_replace(m, r"\+", ""), F.regexp_replace(m, r"^\+[0-9]{1,3}[ .-]*", "")
    wrong = F.concat(F.substr(d, F.lit(1), F.length(d) - 1), F.pmod(F.right(d, F.lit(1)).cast("int") + 1, F.lit(10)).cast("string"))

    def fours(digits, by):
        return F.regexp_replace(digits, "(.{4})(?=.)", f"$1{by}")

    def parted(number, by):
        return F.regexp_replace(F.regexp_replace(number, r"^\(", ""), "[ ().-]+", by)

    anywhere = F.element_at(F.array(*map(F.lit, ["", "", " phone: ", " call ", " card: ", " mail "])), F.pmod(F.xxhash64("x.m", "x.b"), F.lit(6)).cast("int") + 1)
    serial = F.element_at(F.array(*map(F.lit, [" order ", " serial no. ", " invoice: ", " ref ", " ticket #", " id "])), F.pmod(F.xxhash64("x.m", "x.b"), F.lit(6)).cast("int") + 1)
    dialled = [bare, parted(bare, "."), parted(bare, "-"), national, parted(national, "."), parted(national, "-"), parted(national, " "), F.concat(F.lit("00"), d)]
    # (kind, generator, span, the text put before it, label)
    ways = [("phone", "number", w, anywhere, 1) for w in dialled]
    ways += [("phone", "number", _digits(w), F.lit(" phone: "), 1) for w in (bare, national)]
    ways += [("phone", "number", w, serial, 0) for w in (_digits(bare), _digits(national), parted(bare, "-"), parted(national, "-"), parted(national, "."))]
    ways += [("phone", "number", _digits(w), F.lit(""), 0) for w in (bare, national)]
    ways += [("phone", "number", F.substr(parted(national, "."), F.lit(1), F.length(parted(national, ".")) - 1), anywhere, 0)]
    ways += [("card", "number", fours(d, by), anywhere, 1) for by in (".", "/", "  ", "- ")]
    ways += [("card", "number", fours(wrong, by), anywhere, 0) for by in (".", "/", "-", " ", "")]
    ways += [("card", "number", fours(F.substr(d, F.lit(1), F.lit(12)), "-"), c, 0) for c in (F.lit(""), serial)]
    ways += [("email", "spelled", F.concat(local, F.lit(a), F.replace(domain, F.lit("."), F.lit(o))), anywhere, 1)
             for a, o in ((" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), ("[at]", "."), ("(at)", "(dot)"))]
    ways += [("email", "spelled", F.concat(local, F.lit(" at "), w), anywhere, 0) for w in (F.substring_index(domain, ".", 1), domain)]
    rows = [F.struct(F.lit(k).alias("of"), F.lit(g).alias("generator"), w.alias("m"), F.concat("x.b", c).alias("b"), F.lit(float(y)).alias("label"))
            for k, g, w, c, y in ways]
    some = base.withColumn("w", F.explode(F.filter(F.array(*rows), lambda w: w["of"] == F.col("x.kind"))))
    n = F.length(_digits(F.col("w.m")))
    some = some.withColumn("kind", F.when(F.col("w.generator") == "number", F.when(n >= 14, "card").otherwise("phone")).otherwise(F.col("w.of")))
    proposable = F.col("w.m").rlike(f"^(?:{GENERATORS['number'][0]})$") & n.between(9, 19)
    # what a rewriting turns into a number of another kind says nothing of that kind
    return some.where((F.col("w.generator") != "number") | (proposable & ((F.col("kind") == F.col("w.of")) | (F.col("w.label") == 0)))).select(
        "w.m", "w.b", "w.generator", "kind", "w.label", "salt")


def _shares(counts: dict, limit: int) -> dict:
    """The part of each stratum to take for ``limit`` rows in all: small strata whole, the larger ones alike."""
    left, out = limit, {}
    for i, (name, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        take = min(n, left // (len(counts) - i))
        out[name], left = take / n, left - take
    return out


def _sampled(df: DataFrame, by: list[str], limit: int) -> DataFrame:
    """About ``limit`` rows of ``df`` at most, by a hash of the span and its row; rare combinations of ``by`` are kept whole."""
    stratum = F.concat_ws(" ", *by)
    shares = _shares({r["s"]: r["count"] for r in df.groupBy(stratum.alias("s")).count().collect()}, limit)
    if not shares:
        return df
    share = F.element_at(F.create_map(*[c for k, v in shares.items() for c in (F.lit(k), F.lit(v))]), stratum)
    return df.where(F.pmod(F.xxhash64("m", "b", "salt"), F.lit(1_000_000_000)) < share * 1_000_000_000)


def _held() -> Column:
    return F.pmod(F.xxhash64("m", "b", F.lit("held")), F.lit(4)) == 0


def _made(base: DataFrame) -> DataFrame:
    """The rewritten spans of ``base`` as examples of both labels."""
    found = features(F.col("m"), F.col("b"), F.col("generator"))
    return _rewritten(base).select("m", "b", "salt", "kind", F.lit(False).alias("meets"), "label", *[c.alias(k) for k, c in found.items()])


def train(found: DataFrame, train_rows: int = 20_000, precision: float = 0.97, trees: int = 12, depth: int = 4) -> Model:
    """Trees from a bounded sample of the staged ``found`` (base, candidates), thresholds from all that is held back of it."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    salt = F.xxhash64("row").alias("salt")
    each = found.select("base", salt, F.explode("candidates").alias("x"))
    meets = F.exists("base", lambda y: _overlap(F.col("x"), y))
    given = each.select("x.m", "x.b", "salt", "x.kind", meets.alias("meets"), _label(F.col("x"), F.col("base")).alias("label"), *[F.col(f"x.{k}") for k in FEATURES])
    given = given.where(F.col("label").isNotNull())
    based = found.select(salt, F.explode("base").alias("x")).select("salt", "x", "x.m", "x.b")
    some = _sampled(given.where(~_held()), ["kind", "label", "meets"], train_rows)
    rows = some.unionByName(_made(_sampled(based, ["x.kind"], train_rows // 8)).where(~_held()))
    fit = stage_table(rows, "pii-sample").repartition(4)
    if fit.select("label").distinct().count() < 2:
        return Model()
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(fit).select("vector", "label")
    boosted = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, checkpointInterval=-1).fit(vectors)
    model = Model([(w, _tree(t._call_java("rootNode"))) for w, t in zip(boosted.treeWeights, boosted.trees)])
    # by kind, the lowest margin whose precision on held-back rows that no base span settles is reached (and stays so above)
    margin = F.round(F.greatest(F.least(model.margin(F.col), F.lit(5.0)), F.lit(-5.0)), 2).alias("margin")
    held = given.unionByName(_made(based)).where(_held() & ~F.col("meets")).select("kind", "label", margin)
    sums = held.groupBy("kind", "margin").agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("all")).orderBy(F.desc("margin")).collect()
    thresholds: dict = {}
    for kind in KINDS:
        good = every = 0
        for r in (r for r in sums if r["kind"] == kind):
            good, every = good + r["good"], every + r["all"]
            if good < precision * every:
                break
            if r["good"]:
                thresholds[kind] = r["margin"]
    return Model(model.trees, thresholds)


def _text(x: Column) -> Column:
    return F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))


def personal_data(docs: DataFrame, text: str = "text", keep_text: bool = True, model: Model | None = None, **training) -> DataFrame:
    """(row, base, spans): arrays of (start, rank, end, kind, ...) for each document, sorted; ``spans`` holds the base's too."""
    found = proposed(docs, text)
    if not keep_text:
        found = found.withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text]))
    found = stage_table(found.drop("t"), "pii-candidates")
    model = train(found, **training) if model is None else model
    free = F.filter("candidates", lambda x: ~F.exists("base", lambda y: _overlap(x, y)))
    scored = F.transform(free, lambda x: F.struct(F.when(named_secret(x), F.lit(100.0)).otherwise(F.round(model.margin(lambda name: x[name]), 2)).alias("margin"), *[
        x[c].alias(c) for c in ("start", "rank", "end", "kind", "m", "b", "generator")]))

    def selected(x):
        passed = named_secret(x)
        for kind, limit in model.thresholds.items():
            passed = passed | ((x["kind"] == kind) & (x["margin"] >= F.lit(float(limit))))
        return passed

    chosen = found.withColumn("chosen", F.filter(scored, selected))

    def beaten(x):
        return F.exists("chosen", lambda y: _overlap(x, y) & ((y["margin"] > x["margin"]) | ((y["margin"] == x["margin"]) & (
            (y["start"] < x["start"]) | ((y["start"] == x["start"]) & (y["rank"] < x["rank"]))))))

    added = F.transform(F.filter("chosen", lambda x: ~beaten(x)), lambda x: F.struct(*[x[c].alias(c) for c in ("start", "rank", "end", "kind", "m", "b")]))
    return chosen.select("row", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` of personal_data with a column ``redacted``: the text with every span replaced by its kind in brackets."""
    t = whole(F.col(f"row.`{text}`"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("s"))

    def step(a, x):
        start = F.greatest(x["start"], a["at"])
        piece = F.concat(F.substr(t, a["at"] + 1, start - a["at"]), F.when(x["end"] > a["at"], F.concat(F.lit("["), x["kind"], F.lit("]"))).otherwise(F.lit("")))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.concat(a["s"], F.array(piece)).alias("s"))

    end = F.aggregate("spans", zero, step)
    df = df.withColumn("cut", end)
    return df.withColumn("redacted", F.concat(F.array_join("cut.s", ""), F.substr(t, F.col("cut.at") + 1))).drop("cut")


def op2_personal_data(spark, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)

    def count(k):
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")

    added = (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    secrets = F.size(F.filter("spans", lambda x: x["kind"] == "secret")).cast("long").alias("n_secret")
    return found.select("row.doc_id", *map(count, BASE), F.sha2(F.array_join(F.transform("base", _text), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", _text), ",").alias("spans"), added, secrets)
