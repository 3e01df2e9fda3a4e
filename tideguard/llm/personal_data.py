"""Personal data: overlapping candidate spans, boosted trees, calibrated thresholds.

DataFrame functions only. The base patterns (email, ip, card, phone) are found
by regular expressions and validated (octets, Luhn, number of digits); their
spans always stay. High-recall generators propose further spans, which may
overlap each other and the base ones. Each candidate has a pattern: its kind and
ten yes/no features of its format and context. Candidates that a validator can
judge are weakly labelled by it; the validators' verdicts are no features. An
e-mail candidate counts as right if it is written plainly or a word like "mail"
or "contact" stands before it: "look @ home.now" alone is no address. Spark
counts the labelled candidates of all documents by pattern (at most 5,120
patterns, whatever the corpus), MLlib's gradient-boosted trees learn from the
counts of half of the documents, and the other half calibrates one threshold per
kind: the lowest score, a half at least, at which the candidates above it are
right often enough.
A candidate of an accepted pattern that no base span contains becomes a span.

Matches and offsets: a text is cut by the same expression that extracts the
matches, so the lengths of the pieces give the offsets in code points. The
expressions are possessive or bounded, so that no text exhausts the stack and
none takes quadratic time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import free_name, table
from tideguard.session import materialise

KINDS = ("email", "ip", "card", "phone", "secret")

#: Equal to the plain patterns, leftmost and not overlapping, but linear in the text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}(?![0-9])(?![ -][0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
CANDIDATES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}+ ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z]{2,24}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{3})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
    "secret": r"(?i)(?:key|token|secret|password|passwd|pwd)[a-z_]{0,10}[\"']? ?[=:] ?[\"']?[A-Za-z0-9+/_.=-]{8,256}+[\"']?",
}
#: A text without a match of the gate has none of the pattern of the same kind: base patterns first, then candidates.
BASE_GATES = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
GATES = {"email": "@|[\\[(]at[\\])]", "ip": "[0-9]\\.[0-9]", "card": "[0-9]{4}", "phone": "[0-9]{3}", "secret": "[=:]"}
NEARBY = r"(?i)(?:mail|contact|write|reach|ip|host|server|address|card|visa|credit|pay|phone|tel|call|mobile|fax|key|token|secret|pass)"


@dataclass(frozen=True)
class PrivacyConfig:
    precision: float = 0.9   #: of the labelled candidates above a kind's threshold
    trees: int = 10
    depth: int = 3
    context: int = 30        #: characters before a match that are looked at


def matches_of(df: DataFrame, name: str, expression: str, gate: str) -> DataFrame:
    """Adds ``name``: array of (text, start, end, left, right), offsets in code points."""
    body = F.col("_body")
    df = df.withColumn("_m", F.when(body.rlike(gate), F.regexp_extract_all(body, F.lit(expression), F.lit(0)))
                       .otherwise(F.array().cast("array<string>")))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split(body, expression, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("_l", F.transform("_m", lambda m, i: F.length(m) + F.length(F.get("_p", i))))
    # Sums of blocks of 256 lengths, then sums within a block: no quadratic work on a text full of matches.
    total = lambda array: F.aggregate(array, F.lit(0), lambda a, x: a + x)
    df = df.withColumn("_s", F.when(F.size("_l") > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_l") - 1) / 256).cast("int")),
        lambda b: total(F.slice(F.col("_l"), b * 256 + 1, 256)))).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_b", F.transform("_s", lambda _, b: total(F.slice(F.col("_s"), 1, b))))
    before = lambda i: (F.get("_b", F.floor(i / 256).cast("int")) + total(F.slice(F.col("_l"), F.floor(i / 256).cast("int") * 256 + 1, i % 256))
                        + F.length(F.get("_p", i)))
    found = F.transform("_m", lambda m, i: F.struct(
        m.alias("text"), before(i).alias("start"), F.get("_p", i).alias("left"), F.get("_p", i + 1).alias("right")))
    return (df.withColumn("_f", found)
            .withColumn(name, F.transform("_f", lambda x: F.struct(
                x["text"].alias("text"), x["start"].cast("long").alias("start"),
                (x["start"] + F.length(x["text"])).cast("long").alias("end"),
                F.right(x["left"], F.lit(64)).alias("left"), F.left(x["right"], F.lit(1)).alias("right"))))
            .drop("_m", "_p", "_l", "_s", "_b", "_f"))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def octets(text: Column) -> Column:
    def small(part):
        plain = F.regexp_replace(part, "^0+", "")
        return (F.length(plain) <= 3) & (F.concat(F.lit("0"), F.substring(plain, 1, 3)).cast("int") <= 255)
    return F.forall(F.split(text, r"\."), small)


def luhn(text: Column) -> Column:
    number = F.reverse(digits(text))
    def add(total, i):
        digit = F.substring(number, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1))), F.lit(0), add) % 10 == 0


def valid(kind: str, text: Column) -> Column:
    n = F.length(digits(text))
    return {"email": F.lit(True), "ip": octets(text), "card": n.between(12, 19) & luhn(text), "phone": n.between(9, 15),
            "secret": text.rlike("[0-9]") & text.rlike(r"[=:] ?[\"']?.*[A-Za-z]") & (F.length(text) >= 20)}[kind]


def plausible(kind: str, m: Column) -> Column:
    """The weak label of a candidate."""
    if kind == "email":
        return ~m["text"].rlike(r"[ \[(]") | m["left"].rlike(NEARBY)
    return valid(kind, m["text"])


def valid_spans(column: str, kind: str) -> Column:
    """(start, kind, end) of the matches that the validator lets pass."""
    return F.transform(F.filter(column, lambda m: valid(kind, m["text"])),
                       lambda m: F.struct(m["start"], F.lit(KINDS.index(kind)).alias("kind"), m["end"]))


def described(column: str, kind: str, config: PrivacyConfig) -> Column:
    """(start, kind, end, pattern, label) of the matches of a generator."""
    number = KINDS.index(kind)

    def one(m: Column) -> Column:
        body = m["text"]
        bits = [m["left"].rlike(NEARBY + r".{0,%d}$" % config.context), m["left"].rlike("[A-Za-z0-9]$"), m["right"].rlike("^[A-Za-z0-9]"),
                body.contains("+"), body.contains("("), body.rlike("[.-]"), body.contains(" "), F.length(digits(body)) >= 12,
                F.length(body) >= 20, body.rlike("[A-Za-z]") & body.rlike("[0-9]")]
        pattern = F.lit(number * 1024)
        for i, bit in enumerate(bits):
            pattern = pattern + bit.cast("int") * (1 << i)
        return F.struct(m["start"], F.lit(number).alias("kind"), m["end"], pattern.alias("pattern"),
                        plausible(kind, m).cast("int").alias("label"))

    return F.transform(column, one)


def spans(documents: DataFrame, key: str = "doc_id", text: str = "text", config: PrivacyConfig = PrivacyConfig()) -> DataFrame:
    """(doc_id, base, more): the base spans (start, kind, end) of every row, and its candidates (start, kind, end, pattern, label)."""
    df = documents.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_body"))
    for kind, expression in BASE.items():
        df = matches_of(df, f"_base_{kind}", expression, BASE_GATES[kind])
        df = df.withColumn(f"_base_{kind}", valid_spans(f"_base_{kind}", kind))
    df = df.withColumn("base", F.array_sort(F.concat(*[f"_base_{k}" for k in BASE]))).drop(*[f"_base_{k}" for k in BASE])
    for kind, expression in CANDIDATES.items():
        df = matches_of(df, f"_more_{kind}", expression, GATES[kind])
        df = df.withColumn(f"_more_{kind}", described(f"_more_{kind}", kind, config))
    return df.select("doc_id", "base", F.array_sort(F.concat(*[f"_more_{k}" for k in CANDIDATES])).alias("more"))


def accepted(found: DataFrame, config: PrivacyConfig = PrivacyConfig()) -> list[int]:
    """The patterns whose candidates become spans.

    None if the corpus has no labelled candidates of both classes to learn from.
    """
    half = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)), F.lit(0)).alias("half")
    counts = materialise(found.select(half, F.explode("more").alias("c"))
                         .groupBy("half", F.col("c.pattern").alias("pattern"), F.col("c.label").cast("double").alias("label"))
                         .agg(F.count("*").cast("double").alias("n")), "patterns").coalesce(1)  # at most 4 * 5120 rows
    names = [f"f{i}" for i in range(10)] + [f"k{k}" for k in range(len(KINDS))]
    number = F.floor(F.col("pattern") / 1024)
    rows = counts.select("*", *[F.shiftright("pattern", i).bitwiseAND(1).cast("double").alias(f"f{i}") for i in range(10)],
                         *[(number == k).cast("double").alias(f"k{k}") for k in range(len(KINDS))])
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    learn = rows.where("half = 0")
    if learn.select("label").distinct().count() < 2:
        return []
    trees = GBTClassifier(maxIter=config.trees, maxDepth=config.depth, weightCol="n", seed=5).fit(learn)
    scored = (trees.transform(rows).select("half", "pattern", "label", "n", vector_to_array("probability")[1].alias("p"))
              .collect())
    chosen: list[int] = []
    for k in range(len(KINDS)):
        mine = [r for r in scored if r["pattern"] // 1024 == k]
        held = sorted((r for r in mine if r["half"] == 1), key=lambda r: -r["p"])
        right = all_ = 0.0
        threshold = 2.0
        for i, r in enumerate(held):
            right, all_ = right + r["n"] * r["label"], all_ + r["n"]
            if right >= config.precision * all_ and (i + 1 == len(held) or held[i + 1]["p"] < r["p"]):
                threshold = max(r["p"], 0.5)  # never what the trees hold for wrong
        chosen += sorted({r["pattern"] for r in mine if r["p"] >= threshold})
    return chosen


def personal_data(documents: DataFrame, key: str = "doc_id", text: str = "text", config: PrivacyConfig = PrivacyConfig()) -> DataFrame:
    """(doc_id, base, spans): arrays of (start, kind, end), ordered by start, then kind; kind is a place in KINDS.

    Defined results: null and empty texts have no spans; repeated rows get equal
    spans; equal spans of one kind count once; an empty table stays empty; other
    columns are not looked at.
    """
    found = materialise(spans(documents, key, text, config), "personal-data")
    patterns = accepted(found, config)
    wanted = F.array(*[F.lit(p) for p in patterns]).cast("array<int>")
    own = F.transform("base", lambda b: F.struct(b["start"], F.lit(0).alias("place"), b["kind"], b["end"]))
    extra = F.transform(F.filter("more", lambda c: F.array_contains(wanted, c["pattern"])),
                        lambda c: F.struct(c["start"], F.lit(1).alias("place"), c["kind"], c["end"]))
    # A candidate lies in a base span if the greatest end of the base spans up to it in the order of starts reaches its
    # own end: maxima of blocks of 256, then within a block, so that a text full of matches costs no quadratic time.
    df = found.withColumn("_all", F.array_sort(F.concat(own, extra)))
    df = df.withColumn("_e", F.transform("_all", lambda x: F.when(x["place"] == 0, x["end"]).otherwise(F.lit(0))))
    df = df.withColumn("_s", F.when(F.size("_e") > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_e") - 1) / 256).cast("int")),
        lambda b: F.array_max(F.slice(F.col("_e"), b * 256 + 1, 256)))).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_b", F.transform("_s", lambda _, b: F.coalesce(F.array_max(F.slice(F.col("_s"), 1, b)), F.lit(0))))
    block = lambda i: F.floor(i / 256).cast("int")
    reached = lambda i: F.greatest(F.get("_b", block(i)), F.array_max(F.slice(F.col("_e"), block(i) * 256 + 1, i % 256 + 1)))
    df = df.withColumn("_kept", F.filter("_all", lambda x, i: (x["place"] == 0) | (reached(i) < x["end"])))
    return df.select("doc_id", "base", F.array_sort(F.transform("_kept", lambda x: F.struct(x["start"], x["kind"], x["end"]))).alias("spans"))


def joined(column: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(column, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(documents: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with redacted: the text with every span of ``found`` replaced by its kind in brackets.

    ``found`` is what ``personal_data`` returns for a table with unique keys. Of overlapping spans the first covers.

    Defined results: a null text stays null; rows whose key is null or not in ``found`` keep their text; an own column
    ``redacted`` is replaced, all others stay as they are, ``spans`` among them.
    """
    mine = free_name("spans", documents.columns)
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    def step(a, s):
        clean = F.substr(F.col(text), (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        return F.when(s["start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(
            F.struct(F.concat(a["out"], clean, F.get(names, s["kind"])).alias("out"), s["end"].alias("at")))
    done = documents.join(found.select(F.col("doc_id").alias(key), F.col("spans").alias(mine)), key, "left")
    folded = F.aggregate(F.coalesce(mine, F.array().cast(found.schema["spans"].dataType)), start, step,
                         lambda a: F.concat(a["out"], F.substr(F.col(text), (a["at"] + 1).cast("int"))))
    return done.withColumn("redacted", folded).drop(mine)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the base spans and all spans of every document."""
    found = personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))
