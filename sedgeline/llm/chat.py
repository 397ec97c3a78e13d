"""Chat formatting over typed content parts, in DataFrame functions only.

A message holds ordered content parts of type text, image, audio or document. A visitor turns each part into a piece of
text: text parts, joined where they follow each other, are escaped, the others become numbered placeholders such as `<|image:0|>`, whose reference and
expanded token count (what the placeholder grows to in the model's input) are recorded in order. Turns are marked
`<|start|>role<|body|>...<|end|>`. No control string can come from a text: wherever a `<` or `[` would begin one, a
backslash is put after it (and one more after those already there), which `unescape` takes away again.

The loss mask is kept per turn, as the count of code points before the turn's masked text and of those in it, so that
mask and text stay aligned in conversations of any length; `loss_spans` gives them as positions in the whole text.

Defined results: null parts, null texts and null roles are empty; a null reference stays null in the attachment list; an
unknown part type is text; ties in turn go by role, then by text; repeated rows are repeated turns; messages with a null
conversation id form one conversation; empty tables give no rows; other columns are ignored, whatever their names. A
conversation becomes one row, which is the operator's result; rows are gathered to one partial list per task first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, BODY, END = "<|start|>", "<|body|>", "<|end|>"
#: What may not come out of a text: the template's own marks and those of common other templates.
CONTROL = r"(<|\[)(\\*)(\||/?s>|/?INST\])"
ESCAPED = r"(<|\[)\\(\\*)(\||/?s>|/?INST\])"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ROLES_LEARNT = ("assistant",)

# Expanded token counts: image tiles of 28 x 28 pixels, audio frames of 40 ms, a document's pages of 512 tokens each.
TILE, FRAMES, PAGE = 28, 25, 512


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def text_part(text: Column) -> Column:
    """A list of one text part."""
    null = F.lit(None)
    fields = [F.lit("text").alias("type"), text.cast("string").alias("text"), null.cast("string").alias("ref"), null.cast("int").alias("width"), null.cast("int").alias("height"), null.cast("double").alias("seconds"), null.cast("int").alias("pages")]
    return F.array(F.struct(*fields))


def _is_media(part: Column) -> Column:
    return F.coalesce(part["type"].isin("image", "audio", "document"), F.lit(False))


def expanded_tokens(part: Column) -> Column:
    """What a part's placeholder expands to; unknown sizes count as the smallest."""
    tiles = F.ceil(F.greatest(F.coalesce(part["width"], F.lit(1)), F.lit(1)) / TILE) * F.ceil(F.greatest(F.coalesce(part["height"], F.lit(1)), F.lit(1)) / TILE)
    frames = F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(1.0 / FRAMES)) * FRAMES)
    return F.when(part["type"] == "image", tiles).when(part["type"] == "audio", frames).when(part["type"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * PAGE).otherwise(0).cast("long")


def visit(parts: Column, first: Column | int = 0) -> Column:
    """Struct (body, attachments, media_tokens) of a message; placeholders are numbered from `first`."""
    parts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    media = F.filter(parts, _is_media)
    at = F.filter(F.transform(parts, lambda p, i: F.when(_is_media(p), i)), lambda i: i.isNotNull())

    def flat(x: Column) -> Column:
        """Texts that follow each other are one text, so that none of them can end what another has begun."""
        n = F.size(x["at"])
        start = lambda j: F.when(j == 0, 0).otherwise(F.get(x["at"], j - 1) + 1)
        end = lambda j: F.when(j == n, F.size(x["parts"])).otherwise(F.get(x["at"], j))
        run = lambda j: escape(F.array_join(F.transform(F.slice(x["parts"], start(j) + 1, end(j) - start(j)), lambda p: F.coalesce(p["text"], F.lit(""))), ""))
        mark = lambda j: F.concat(F.lit("<|"), F.get(x["parts"], F.get(x["at"], j))["type"], F.lit(":"), (j + first).cast("string"), F.lit("|>"))
        return F.array_join(F.transform(F.sequence(F.lit(0), n), lambda j: F.concat(run(j), F.when(j < n, mark(j)).otherwise(""))), "")

    # The list is bound to a name first, as an expression inside of lambdas would be computed for every part.
    body = F.get(F.transform(F.array(F.struct(parts.alias("parts"), at.alias("at"))), flat), F.lit(0))
    return F.struct(
        body.alias("body"),
        F.transform(media, lambda p, i: F.struct((i + first).cast("long").alias("number"), p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens"))).alias("attachments"),
        F.aggregate(media, F.lit(0).cast("long"), lambda a, p: a + expanded_tokens(p)).alias("media_tokens"),
    )


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", learnt: tuple[str, ...] = ROLES_LEARNT) -> DataFrame:
    """A row per conversation: conv_id, formatted, mask (per turn: skip, take), attachments (number, type, ref, tokens,
    turn), media_tokens, n_turns. Attachments are numbered through the conversation."""
    is_media = f"exists({parts}, p -> p.type in ('image','audio','document'))"
    rows = df.select(F.col(conv).alias("conv_id"), F.struct(F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), visit(F.col(parts)).alias("seen"), F.expr(f"coalesce({is_media}, false)").alias("has_media"), F.when(F.expr(is_media), F.col(parts)).alias("parts")).alias("m"))
    # A turn's text is made where the row is read; only turns with media are made anew, with numbers that go on.
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<long>").alias("at"))
    firsts = F.when(F.exists("ms", lambda m: m["has_media"]), F.aggregate("ms", start, lambda a, m: F.struct((a["n"] + F.size(m["seen"]["attachments"])).alias("n"), F.concat(a["at"], F.array(a["n"])).alias("at")))["at"]).otherwise(F.transform("ms", lambda m: F.lit(0).cast("long")))
    whole = whole.withColumn("firsts", firsts)
    seen = F.transform("ms", lambda m, i: F.struct(m["turn"].alias("turn"), m["role"].alias("role"), F.when(m["has_media"], visit(m["parts"], F.get("firsts", i))).otherwise(m["seen"]).alias("seen")))
    whole = whole.select("conv_id", seen.alias("ts"))
    head = lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(BODY))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: F.concat(head(t), t["seen"]["body"], F.lit(END))), "").alias("formatted"),
        F.transform("ts", lambda t: F.struct(F.length(head(t)).alias("skip"), F.when(t["role"].isin(*learnt), F.length(t["seen"]["body"])).otherwise(0).alias("take"))).alias("mask"),
        F.flatten(F.transform("ts", lambda t: F.transform(t["seen"]["attachments"], lambda a: F.struct(a["number"], a["type"], a["ref"], a["tokens"], t["turn"].alias("turn"))))).alias("attachments"),
        F.aggregate("ts", F.lit(0).cast("long"), lambda a, t: a + t["seen"]["media_tokens"]).alias("media_tokens"),
        F.size("ts").cast("long").alias("n_turns"),
    )


def read_turns(formatted: Column, mask: Column) -> Column:
    """The turns of a formatted text: array of (role, text, loss), unescaped; `loss` is what the mask covers."""
    pieces = F.split(formatted, r"<\|end\|>")
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    text = lambda p: unescape(F.substring_index(p, BODY, -1))
    return F.transform(
        F.arrays_zip(pieces.alias("p"), mask.alias("m")),
        lambda x: F.struct(unescape(F.substring(F.substring_index(x["p"], BODY, 1), len(START) + 1, 1 << 30)).alias("role"), text(x["p"]).alias("text"), unescape(F.substring(x["p"], x["m"]["skip"] + 1, x["m"]["take"])).alias("loss")),
    )


def loss_spans(df: DataFrame) -> DataFrame:
    """A row per masked stretch: conv_id, start, length, in code points of `formatted`."""
    turns = df.select("conv_id", "mask", F.posexplode(F.split("formatted", r"<\|end\|>")).alias("i", "p"))
    from pyspark.sql import Window

    before = F.coalesce(F.sum(F.length("p") + len(END)).over(Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = turns.withColumn("m", F.get("mask", F.col("i"))).withColumn("start", before + F.col("m.skip"))
    return turns.where("m.take > 0").select("conv_id", F.col("start").cast("long"), F.col("m.take").cast("long").alias("length"))
