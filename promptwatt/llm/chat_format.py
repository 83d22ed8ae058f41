"""Chat formatting (operator 9): a visitor over typed content parts, in Spark
column expressions only.

A conversation is a group of rows (conv_id, turn, role, parts). Each part has a
kind (text, image, audio or document), a text, a reference and a size. The
visitor walks the parts in order: text is escaped and kept, every other part
becomes a placeholder `<|kind:k|>` with k its place among the conversation's
attachments; the reference and the number of model tokens that the part expands
to are recorded. Unknown kinds are treated as documents; a null part is skipped.

Template of a turn: `<turn role>` newline, content, `</turn>` newline. Inside
roles and texts `\\` is written `\\b`, `<` is `\\l` and `>` is `\\g`, so a text can
neither open nor close a turn nor fake a placeholder, and unescaping restores it.

Defined results: a null text is empty, a null role is empty, a null turn comes
first, ties are ordered by role and content, repeated rows are turns of their
own, rows with a null conversation form one conversation, an empty table gives
an empty result, and further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Tokens that an attachment expands to: for each unit of its size, and at least.
EXPANSION = {"image": (85, 85), "audio": (25, 25), "document": (500, 500)}
PARTS = "array<struct<kind:string,text:string,ref:string,size:long>>"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("size"))).cast(PARTS)


def _kind(part: Column) -> Column:
    return F.when(part["kind"].isin("text", *EXPANSION), part["kind"]).otherwise(F.lit("document"))


def _expanded(part: Column) -> Column:
    out = F.lit(0).cast("long")
    for kind, (each, least) in EXPANSION.items():
        size = F.coalesce(part["size"], F.lit(1))
        out = F.when(_kind(part) == kind, F.greatest(F.lit(least).cast("long"), size * F.lit(each))).otherwise(out)
    return out


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: formatted text, spans under the loss mask
    (start and length in code points, of assistant contents), attachments."""
    rows = turns.select(
        "conv_id", F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                            F.filter(F.coalesce(F.col("parts").cast(PARTS), F.array().cast(PARTS)), lambda p: p.isNotNull()).alias("parts")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    flat = F.flatten(F.transform("turns", lambda t: F.transform(t["parts"], lambda p: F.struct(_kind(p).alias("kind"), p["ref"].alias("ref"), _expanded(p).alias("tokens")))))
    convs = convs.withColumn("attachments", F.transform(F.filter(flat, lambda p: p["kind"] != "text"), lambda p, k: F.struct(k.alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))))
    # attachments before each turn, so that placeholders number on through the conversation
    seen = F.transform("turns", lambda t: F.size(F.filter(t["parts"], lambda p: _kind(p) != "text")))
    convs = convs.withColumn("before", F.aggregate(seen, F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n)))

    def visit(t: Column, first: Column) -> Column:
        def step(acc: Column, p: Column) -> Column:
            is_text = _kind(p) == "text"
            piece = F.when(is_text, escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), _kind(p), F.lit(":"), acc["k"].cast("string"), F.lit("|>")))
            return F.struct(F.array_append(acc["out"], piece).alias("out"), (acc["k"] + F.when(is_text, 0).otherwise(1)).alias("k"))
        return F.array_join(F.aggregate(t["parts"], F.struct(F.array().cast("array<string>").alias("out"), first.alias("k")), step, lambda acc: acc["out"]), "")

    convs = convs.withColumn("pieces", F.transform("turns", lambda t, i: F.struct(
        t["role"].alias("role"), F.concat(F.lit("<turn "), escape(t["role"]), F.lit(">\n")).alias("head"), visit(t, F.get("before", i)).alias("body"))))
    convs = convs.withColumn("lengths", F.transform("pieces", lambda p: F.struct((p["role"] == "assistant").alias("loss"), F.length(p["head"]).alias("head"), F.length(p["body"]).alias("body"))))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    spans = F.aggregate("lengths", start, lambda acc, n: F.struct(
        (acc["at"] + n["head"] + n["body"] + F.lit(len("</turn>\n"))).alias("at"),
        F.when(n["loss"], F.array_append(acc["spans"], F.struct((acc["at"] + n["head"]).alias("start"), n["body"].alias("length")))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return convs.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("</turn>\n"))), "").alias("formatted"),
        spans.alias("loss_spans"), "attachments",
        F.coalesce(F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"]), F.lit(0)).cast("long").alias("attachment_tokens"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) parsed back from a formatted conversation; texts keep
    their placeholders."""
    marks = F.lit(r"<turn ([^<>]*)>\n([^<]*+(?:<\|[^<]*+)*+)</turn>\n")
    return F.transform(F.arrays_zip(F.regexp_extract_all(formatted, marks, F.lit(1)).alias("role"), F.regexp_extract_all(formatted, marks, F.lit(2)).alias("text")),
                       lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")))


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"], s["length"])))
