"""Personal data: fixed forms, then identifiers found by bootstrapped contexts. DataFrame functions only.

The fixed forms (e-mail, IP address, card and phone number) give the first known identifiers. The
words around them become lexical patterns; Spark counts how many different identifiers each pattern
occurs with and how many of those are known. Patterns that are mostly known make the unknown ones
they occur with known, and so on for ``ROUNDS`` rounds. What the trusted patterns found and no fixed
form covers is added with the kind 'context'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, read
from quillmill.llm.registry import query

#: Fixed forms in their order. Each is written so that a match can't begin inside a run that was already
#: given up, which makes matching linear and changes no match; \G is the end of the match before.
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = [*FORMS, "context"]

#: An identifier-like token: at least so many characters and digits.
LEAST_CHARS, LEAST_DIGITS = 8, 3
#: A pattern is trusted with so many different known identifiers that make up this share of all it occurs with.
LEAST_KNOWN, TRUST = 5, 0.8
#: An identifier becomes known when its patterns together leave less doubt than this.
DOUBT = 0.2
ROUNDS = 3

_TOKEN = r"(?<![^\s\x22'`(),;=<>\[\]{}|])[^\s\x22'`(),;=<>\[\]{}|0-9]*+[0-9][^\s\x22'`(),;=<>\[\]{}|]*+"


def _spans(text: Column, pattern: str) -> tuple[Column, Column]:
    """(gaps, matches) of a pattern, in text order: a gap before every match and one at the end."""
    return F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)


def _located(gaps: str, found: str, keep) -> Column:
    """array<struct<s, e, v>> in code points of the matches for which ``keep(match)`` holds."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint,v:string>>").alias("out"))

    def step(acc: Column, i: Column) -> Column:
        value = F.get(F.col(found), i)
        s = acc["at"] + F.char_length(F.get(F.col(gaps), i))
        e = s + F.char_length(value)
        one = F.struct(s.alias("s"), e.alias("e"), value.alias("v"))
        return F.struct(e.alias("at"), F.when(keep(value), F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    none = F.array().cast("array<struct<s:bigint,e:bigint,v:string>>")
    n = F.size(found)
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), start, step)["out"]).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.split(_digits(value), ""))

    def add(total: Column, pair: Column) -> Column:
        d = pair["d"] * F.when(pair["i"] % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    indexed = F.transform(F.filter(digits, lambda c: c != ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(indexed, F.lit(0), add) % 10 == 0


def _kept(kind: str):
    def ip(value: Column) -> Column:
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) > 3, F.lit(False)).otherwise(F.concat(F.lit("0"), p).cast("int") <= 255))

    def card(value: Column) -> Column:
        n = F.length(_digits(value))
        return F.when((n >= 13) & (n <= 19), _luhn(value)).otherwise(False)

    def phone(value: Column) -> Column:
        return F.length(_digits(value)).between(9, 15)

    return {"email": lambda v: F.lit(True), "ip": ip, "card": card, "phone": phone}[kind]


def with_forms(df: DataFrame) -> DataFrame:
    """``df`` with text, and for each fixed form an array<struct<s, e, v>> column named after its kind."""
    kept = list(df.columns)
    none = F.array().cast("array<string>")
    for kind, pattern in FORMS.items():
        gaps, found = _spans(F.col("text"), pattern)
        needs = NEEDS[kind]
        may = F.col("text").rlike("[0-9]") if needs is None else F.contains("text", F.lit(needs))
        df = df.select(*kept, F.when(may, found).otherwise(none).alias("__found"), may.alias("__may"))
        gaps = F.when(F.size("__found") > 0, gaps).otherwise(none)
        df = df.select(*kept, "__found", gaps.alias("__gaps"))
        df = df.select(*kept, _located("__gaps", "__found", _kept(kind)).alias(kind))
        kept.append(kind)
    return df


def _tokens(df: DataFrame) -> DataFrame:
    """(key, s, e, v, left1, left2, right1) of the identifier-like tokens of (key, text)."""
    gaps, found = _spans(F.col("text"), _TOKEN)
    df = df.where(F.col("text").rlike("[0-9]")).select("key", F.col("text"), found.alias("__found"))
    df = df.where(F.size("__found") > 0).select("key", "__found", gaps.alias("__gaps"))
    indexed = F.transform(_located("__gaps", "__found", lambda v: F.lit(True)), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    df = df.select("key", "__gaps", "__found", F.explode(indexed).alias("t"))
    # a trailing mark belongs to the sentence
    value = F.regexp_replace(F.col("t.x.v"), r"[.:!?*#%&$]+$", "")
    before = F.get("__gaps", F.col("t.i"))
    after = F.get("__gaps", F.col("t.i") + 1)
    df = df.select(
        "key",
        F.col("t.x.s").alias("s"),
        (F.col("t.x.s") + F.char_length(value)).alias("e"),
        value.alias("v"),
        F.regexp_extract(before, r"(\S++\s*)$", 1).alias("left1"),
        F.regexp_extract(before, r"(\S++\s++\S++\s*)$", 1).alias("left2"),
        F.regexp_extract(after, r"^\s*(\S++)", 1).alias("right1"),
    )
    enough = (F.char_length("v") >= LEAST_CHARS) & (F.length(_digits(F.col("v"))) >= LEAST_DIGITS)
    return df.where(enough)


def _patterns(tokens: DataFrame) -> DataFrame:
    """(key, s, e, v, pattern): each token once for every context it stands in."""
    contexts = F.array(
        F.when(F.col("left1") != "", F.concat(F.lit("1:"), "left1")),
        F.when(F.col("left2") != "", F.concat(F.lit("2:"), "left2")),
        F.when((F.col("left1") != "") & (F.col("right1") != ""), F.concat(F.lit("3:"), "left1", F.lit("_"), "right1")),
    )
    pattern = F.explode(F.filter(contexts, lambda c: c.isNotNull())).alias("context")
    return tokens.select("key", "s", "e", F.xxhash64("v").alias("v"), pattern).withColumn("pattern", F.xxhash64("context")).drop("context")


def bootstrap(found: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, trust) after ROUNDS rounds over the graph of (pattern, v) in ``found``; ``known``: (v).

    Only hashes of patterns and identifiers move; both sides of a hot pattern are combined before.
    """
    graph = materialize(found.select("pattern", "v").distinct(), "pattern-graph")
    seeds = materialize(known.select("v").distinct(), "known")
    trusted = None
    for _ in range(ROUNDS):
        marked = graph.join(seeds.withColumn("is_known", F.lit(1)), "v", "left")
        scores = marked.groupBy("pattern").agg(F.count("*").alias("n"), F.count("is_known").alias("known"))
        scores = scores.where((F.col("known") >= LEAST_KNOWN) & (F.col("known") >= F.col("n") * TRUST))
        trusted = materialize(scores.select("pattern", (F.col("known") / (F.col("n") + 1)).alias("trust")), "trusted")
        doubt = graph.join(trusted, "pattern").groupBy("v").agg(F.exp(F.sum(F.log(1 - F.col("trust")))).alias("doubt"))
        seeds = materialize(seeds.union(doubt.where(F.col("doubt") < DOUBT).select("v")).distinct(), "known")
    return trusted


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, email, ip, card, phone, context): arrays of spans (s, e, v) in code points, end exclusive, by start.

    Null and empty texts have none. Rows with the same id and text (repeated rows) have the same
    spans. Without any known identifier no context is trusted. Other columns aren't read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    forms = materialize(with_forms(rows.withColumn("key", F.xxhash64("text"))).drop("text"), "forms")
    tokens = materialize(_tokens(rows.select("text", F.xxhash64("text").alias("key"))), "tokens")
    contexts = materialize(_patterns(tokens), "contexts")
    every = F.concat(*[F.transform(k, lambda x: x["v"]) for k in FORMS])
    known = forms.select(F.explode(every).alias("text_v")).select(F.xxhash64("text_v").alias("v"))
    trusted = bootstrap(contexts, known)
    discovered = contexts.join(trusted, "pattern").groupBy("key", "s", "e").agg(F.exp(F.sum(F.log(1 - F.col("trust")))).alias("doubt"))
    discovered = discovered.where(F.col("doubt") < DOUBT).join(tokens.select("key", "s", "e", "v").distinct(), ["key", "s", "e"])
    by_text = discovered.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("s", "e", "v"))).alias("more"))  # one text's own
    joined = forms.join(materialize(by_text, "discovered"), "key", "left")
    free = F.filter(
        F.col("more"),
        lambda x: ~F.exists(F.concat(*list(FORMS)), lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])),
    )
    none = F.array().cast("array<struct<s:bigint,e:bigint,v:string>>")
    return joined.select("id", *FORMS, F.coalesce(free, none).alias("context"))


def span_list(kinds: list[str]) -> Column:
    """kind:start:end by kind, then start, joined by commas."""
    def named(kind: str) -> Column:
        return F.transform(kind, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))

    each = [named(kind) for kind in kinds]
    return F.array_join(F.concat(*each), ",")


@query("op5_personal_data")
def op5_personal_data(spark, sf_dir):
    found = find_personal_data(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in FORMS],
        F.sha2(span_list(list(FORMS)), 256).alias("base_sha256"),
        span_list(KINDS).alias("spans"),
        F.size("context").cast("long").alias("n_context"),
    )
