"""Chat formatting whose grammar is checked by a round trip.

A turn is written ``### role: text</turn>`` and a line feed. Text may hold those strings, so a
deterministic parser reads every rendered turn back and compares it with its source; a turn that
does not come back identical is rendered again with the next stronger escape:

0. as it is;
1. a backslash put inside each control string, backslashes doubled;

and so on until it is identical. The last level is reversible for any text, which is checked as
well. Everything is DataFrame functions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, SEP, END = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    """Break every control string, reversibly; other text is unchanged."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit(HEAD), F.lit("#\\## "))


def unescape(text: Column) -> Column:
    """Undo :func:`escape`: a backslash stands for the character after it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(SEP), F.lit(":\\ "))


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(SEP), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns of a rendered text: ``array<struct<role, text, raw>>``; ``raw`` is still escaped."""

    def turn(part: Column) -> Column:
        at = F.locate(SEP, part, len(HEAD) + 1)
        raw = F.substring(part, at + F.lit(len(SEP)), F.length(part))
        role = F.substring(part, F.lit(len(HEAD) + 1), at - F.lit(len(HEAD) + 1))
        return F.struct(unescape(role).alias("role"), unescape(raw).alias("text"), raw.alias("raw"))

    parts = F.split(formatted, "</turn>\n", -1)
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def _identical(rendered: Column, role: Column, text: Column) -> Column:
    back = parse(rendered)
    one = F.get(back, F.lit(0))
    return (F.size(back) == 1) & rendered.startswith(HEAD) & (one["role"] == role) & (one["text"] == text)


def format_chats(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant"
) -> DataFrame:
    """One row per conversation: ``conv, n_turns, formatted, loss_mask, escaped_turns, round_trip``.

    ``loss_mask`` is an array of ``start, end`` (code points of ``formatted``, end exclusive), one
    for the text of each turn of the role ``trained``. ``round_trip`` says that the whole rendered
    conversation parses to exactly its turns.

    Defined results: null text or role counts as empty; turns are ordered by turn (null first),
    then role and text, so ties and repeated rows stay, in a fixed order; a null conversation id
    is a conversation; an empty table gives no rows; other columns are ignored, whatever their
    names. A conversation is one string, so its turns meet in one task; nothing else is gathered.
    """
    w = Window.partitionBy("conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    ranks = Window.partitionBy("conv").orderBy("turn", "role", "text")
    plain = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    as_is, safe = _turn(F.col("role"), F.col("text")), _turn(escape_role(F.col("role")), escape(F.col("text")))
    tried = plain.withColumn("level", F.when(_identical(as_is, F.col("role"), F.col("text")), 0).otherwise(1))
    rendered = tried.withColumn("rendered", F.when(F.col("level") == 0, as_is).otherwise(safe)).withColumn(
        "body",
        F.when(F.col("level") == 0, F.length("text")).otherwise(F.length(escape(F.col("text")))).cast("long"),
    )
    size = F.length("rendered").cast("long")
    placed = rendered.select(
        "conv",
        "role",
        "text",
        "rendered",
        "level",
        "body",
        F.row_number().over(ranks).alias("n"),
        (F.coalesce(F.sum(size).over(w), F.lit(0)) + size - F.lit(len(END)) - F.col("body")).alias("start"),
    )
    turns = F.array_sort(F.collect_list(F.struct("n", "role", "text", "rendered", "level", "start", "body")))
    whole = placed.groupBy("conv").agg(turns.alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: t["rendered"]), "")
    mask = F.transform(
        F.filter("turns", lambda t: t["role"] == trained),
        lambda t: F.struct(t["start"].alias("start"), (t["start"] + t["body"]).alias("end")),
    )
    out = whole.select(
        F.col("conv"),
        F.size("turns").cast("long").alias("n_turns"),
        formatted.alias("formatted"),
        mask.alias("loss_mask"),
        F.size(F.filter("turns", lambda t: t["level"] > 0)).cast("long").alias("escaped_turns"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
    )
    same = F.transform(parse(F.col("formatted")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return out.withColumn("round_trip", same == F.col("source")).drop("source").withColumnRenamed("conv", conv)


def read_back(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of what the rendered text and the loss mask give when they are read again."""
    turns = F.transform(F.col("parsed"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.array_join(
        F.transform(
            "loss_mask",
            lambda s: unescape(
                F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            ),
        ),
        "",
    )
    return (
        chats.withColumn("parsed", parse(F.col("formatted")))
        .withColumn("masked", masked)
        .select(
            F.col(conv).alias("conv_id"),
            F.size("parsed").cast("long").alias("n_turns"),
            F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
            F.length("masked").cast("long").alias("loss_chars"),
            F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            F.col("escaped_turns"),
            F.col("round_trip"),
        )
    )
