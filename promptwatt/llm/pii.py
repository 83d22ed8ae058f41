"""Personal data (operator 10): rules for e-mail addresses, IP addresses, card
and phone numbers, and bootstrapped contextual extraction of further identifiers,
in Spark column expressions and joins only.

Bootstrapping: candidates are the white-space tokens with a digit or an @. Those
that overlap a rule's span are seeds. Seeds induce lexical patterns: the word to
the left, the word to the right, and a key before = or : inside the token. Spark
scores the graph of patterns and instances in ROUNDS rounds: a pattern's score is
the share of its occurrences whose instance scores (with SMOOTH pseudo-misses), an
instance's score is the mean over its patterns weighted by their support, and
seeds stay at 1. Patterns with at least MIN_SUPPORT seeds count; instances at or
above MIN_SCORE that have MIN_CHARS characters and MIN_DIGITS digits are found.

Offsets are code points, ends exclusive. Rules give leftmost matches that do not
overlap within a kind; possessive repeats and the look at the character before
(or the end of the last match, \\G) keep long runs linear without changing what
matches.

Defined results: null texts are empty and have no spans; repeated rows have
spans of their own; scores do not depend on ties; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE_CLASS, stored

KINDS = ("email", "ip", "card", "phone", "context")
ROUNDS = 3
SMOOTH = 2.0
MIN_SUPPORT, MIN_SCORE, MIN_CHARS, MIN_DIGITS = 5, 0.9, 8, 2
SALTS = 32
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that every text with a match passes.
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?+[0-9]){13}", "phone": r"\+[0-9]"}
CANDIDATE = rf"(?:(?<![^{SPACE_CLASS}])|\G)[^{SPACE_CLASS}0-9@]*+[0-9@][^{SPACE_CLASS}]*+"
SPAN = "array<struct<start:int,end:int,text:string,before:string>>"
KIND_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _matches(text: Column, pattern: str) -> Column:
    """Matches with their offsets and the text between them and the last one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        end = start + F.length(x["text"])
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(start.alias("start"), end.alias("end"), x["text"].alias("text"), x["before"].alias("before"))).alias("out"))

    pairs = F.zip_with(found, F.slice(pieces, 1, F.size(found)), lambda m, p: F.struct(m.alias("text"), p.alias("before")))
    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


def _luhn(digits: Column) -> Column:
    """Sum of the digits from the right, every second one doubled and cast to one digit."""
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda k: F.substr(F.reverse(digits), k, F.lit(1)).cast("int") * F.when(k % 2 == 0, 2).otherwise(1))
    return F.aggregate(F.transform(each, lambda x: F.when(x > 9, x - 9).otherwise(x)), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    digits = F.regexp_replace(text, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda x: x.cast("double") <= 255)
    if kind == "card":
        return F.length(digits).between(14, 19) & _luhn(digits)
    return F.length(digits).between(10, 15) if kind == "phone" else F.lit(True)


def _of_kind(text: Column, kind: str) -> Column:
    found = F.filter(_matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["text"]))
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))


def rule_spans(text: Column) -> Column:
    """Spans (start, kind number, end) of the four rules, sorted."""
    parts = [F.when(text.contains("@") if kind == "email" else text.rlike(GATES[kind]), _of_kind(text, kind)).otherwise(F.array().cast(KIND_SPAN)) for kind in PATTERNS]
    return F.array_sort(F.concat(*parts))


def _bare(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, r"[^\p{L}\p{N}]", ""))


def candidates(text: Column, rules: Column) -> Column:
    """Identifier-like tokens with their contexts; seed: overlaps a rule's span."""
    raw = _matches(text, CANDIDATE)
    flat = lambda s: F.translate(s, "\t\n\x0b\x0c\r", "     ")

    def one(m: Column) -> Column:
        core = F.regexp_extract(m["text"], r"^[\"'(\[]*+(.*?)[\"'.,;:!?)\]]*$", 1)
        lead = F.length(F.regexp_extract(m["text"], r"^([\"'(\[]*+)", 1))
        start = m["start"] + lead
        return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), core.alias("core"),
                        _bare(F.substring_index(F.rtrim(flat(m["before"])), " ", -1)).alias("left"),
                        F.lower(F.regexp_extract(core, r"^([A-Za-z_]{1,40}+)[=:]", 1)).alias("key"))

    found = F.transform(raw, one)
    last = F.size(found) - 1
    # the right context of a token is the first word of the text before the next one
    nexts = F.concat(F.transform(F.slice(raw, 2, F.greatest(F.size(raw), F.lit(1))), lambda m: _bare(F.substring_index(F.ltrim(flat(m["before"])), " ", 1))), F.array(F.lit("")))
    return F.transform(found, lambda c, i: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["core"].alias("core"), c["left"].alias("left"),
        F.when(i < last, F.get(nexts, i)).otherwise("").alias("right"), c["key"].alias("key"),
        F.exists(rules, lambda r: (r["start"] < c["end"]) & (r["end"] > c["start"])).alias("seed")))


def _salted_join(big: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """big joined to small (unique keys) with every key dealt over SALTS tasks."""
    small = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("salt", F.pmod(F.xxhash64("instance", "pattern"), F.lit(SALTS)).cast("int")).join(small, [key, "salt"]).drop("salt")


def found_instances(cands: DataFrame) -> DataFrame:
    """Instances (core) that the scored patterns find, of rows (core, left,
    right, key, seed)."""
    patterns = F.filter(F.array(*[F.when(F.col(c) != "", F.concat(F.lit(f"{c}:"), F.col(c))) for c in ("left", "right", "key")]), lambda p: p.isNotNull())
    edges = (cands.select(F.col("core").alias("instance"), "seed", F.explode(patterns).alias("pattern"))
             .groupBy("pattern", "instance").agg(F.count("*").cast("double").alias("n"), F.max("seed").alias("seed")))
    edges = stored(edges, "pii-edges")
    scores = edges.select("pattern", "instance", "n", "seed", F.col("seed").cast("double").alias("s"))
    for _ in range(ROUNDS):
        p = scores.groupBy("pattern").agg((F.sum(F.col("n") * F.col("s")) / (F.sum("n") + SMOOTH)).alias("p"),
                                          F.sum(F.col("seed").cast("int")).alias("support")).filter(F.col("support") >= MIN_SUPPORT)
        i = (_salted_join(edges, p, "pattern").groupBy("instance").agg((F.sum(F.col("p") * F.log1p("support")) / F.sum(F.log1p("support"))).alias("i")))
        i = stored(i, "pii-scores")
        scores = edges.join(i, "instance", "left").select("pattern", "instance", "n", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("i", F.lit(0.0))).alias("s"))
    good = F.col("s") >= MIN_SCORE
    shaped = (F.length("instance") >= MIN_CHARS) & (F.length(F.regexp_replace("instance", "[^0-9]", "")) >= MIN_DIGITS)
    return scores.filter(~F.col("seed") & good & shaped).select(F.col("instance").alias("core")).distinct()


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and its spans (start, kind number, end), sorted, for each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int,core:string,left:string,right:string,key:string,seed:boolean>>")
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn("rules", rule_spans(F.col("text")))
    rows = rows.withColumn("cands", F.when(F.col("text").rlike("[0-9@]"), candidates(F.col("text"), F.col("rules"))).otherwise(none))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "rules", "cands"), "pii-rows")
    cands = rows.select("row", F.explode("cands").alias("c")).select("row", "c.*")
    found = cands.filter(~F.col("seed")).select("row", "start", "end", "core").join(found_instances(cands), "core")
    more = found.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("context")).alias("kind"), "end")).alias("more"))
    out = rows.select("row", "doc_id", "rules").join(more, "row", "left")
    return out.select("doc_id", "rules", F.array_sort(F.concat("rules", F.coalesce("more", F.array().cast(KIND_SPAN)))).alias("spans"))


def named(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
