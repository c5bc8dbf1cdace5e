"""Chat formatting of typed content parts, with DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A content part: kind (text, image, audio, document), its text, its attachment reference, and its
#: size in the kind's own unit (image: pixels on the longer side, audio: milliseconds, document: pages).
PART = "struct<kind:string,text:string,ref:string,size:bigint>"
TURN = f"struct<turn:bigint,role:string,parts:array<{PART}>>"


@dataclass(frozen=True)
class Template:
    """How turns are marked. ``escape`` must not be part of any mark."""

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    control: str = "<|"
    escape: str = "\\"
    trained_role: str = "assistant"
    #: Size units per token of an attachment; at least one token each.
    unit: dict[str, int] = field(default_factory=lambda: {"image": 28, "audio": 40, "document": 1})
    per_unit: dict[str, int] = field(default_factory=lambda: {"image": 9, "audio": 1, "document": 512})


def escaped(text: Column, t: Template) -> Column:
    """Double the escape character, then put one after every ``<`` (the first character of a mark).

    No escaped text holds ``<|``, nor does any two of them end to end.
    """
    e, c = t.escape, t.control[0]
    return F.replace(F.replace(text, F.lit(e), F.lit(e + e)), F.lit(c), F.lit(c + e))


def unescaped(text: Column, t: Template) -> Column:
    """The inverse: every ``<`` is followed by one escape character put in; the others are doubled."""
    e, c = t.escape, t.control[0]
    return F.replace(F.replace(text, F.lit(c + e), F.lit(c)), F.lit(e + e), F.lit(e))


def escaped_role(role: Column, t: Template) -> Column:
    """As :func:`escaped`; what ends a role becomes ``<n``, which no escaped text holds."""
    return F.replace(escaped(role, t), F.lit(t.after_role), F.lit(t.control[0] + "n"))


def unescaped_role(role: Column, t: Template) -> Column:
    return unescaped(F.replace(role, F.lit(t.control[0] + "n"), F.lit(t.after_role)), t)


def expanded_tokens(part: Column, t: Template) -> Column:
    """Tokens an attachment stands for: its size in whole units, at least one."""
    out = F.lit(0).cast("long")
    for kind, unit in t.unit.items():
        n = F.greatest(F.lit(1), F.ceil(F.coalesce(part["size"], F.lit(0)) / F.lit(unit)))
        out = F.when(part["kind"] == kind, n * F.lit(t.per_unit[kind])).otherwise(out)
    return out.cast("long")


def visit(part: Column, t: Template) -> Column:
    """One part as (shown, ref, tokens): text is escaped, an attachment becomes a placeholder mark."""
    mark = F.concat(F.lit(t.control), part["kind"], F.lit("|>"))
    known = part["kind"].isin(list(t.unit))
    return F.struct(
        F.when(known, mark).otherwise(escaped(F.coalesce(part["text"], F.lit("")), t)).alias("shown"),
        F.when(known, part["kind"]).alias("kind"),
        F.when(known, part["ref"]).alias("ref"),
        expanded_tokens(part, t).alias("tokens"),
    )


def format_chats(turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id") -> DataFrame:
    """Render conversations whose turns are rows ``conv_id, turn, role, parts``.

    Returns per conversation: ``conv_id``; ``formatted``; ``spans``, for every turn the (start, end,
    trained) code point offsets of its content in ``formatted``; ``loss_spans``, the (start, end) of the
    trained ones; ``attachments``, an array of (slot, turn, kind, ref, tokens) in the order of the
    placeholders; ``n_turns``; and ``expanded_tokens``, their sum.

    A visitor (``visit``) maps every part to what is shown and to an attachment record; parts of an
    unknown or null kind are text. Null text, role and parts are empty. A null turn number sorts
    first; turns of equal number are ordered by role, then content, so that repeated rows give the
    same output in any input order. A conversation with no rows has no output; an empty table gives
    an empty result. The conversation of null id is a conversation. Other columns are ignored.
    Each conversation is one output string, so its turns meet in one row: rendering happens before
    the shuffle, and one aggregation per conversation gathers only finished pieces. Places are running
    sums over a conversation's sorted turns, so the work is linear in them (but for sorting).
    """
    t = template or Template()
    role = F.coalesce(F.col("role"), F.lit(""))
    pieces = turns.select(
        F.col(conv_col).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.transform(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")), lambda p: visit(p, t)).alias("seen"),
    ).select(
        "conv",
        "turn",
        "role",
        F.concat(F.lit(t.open), escaped_role(F.col("role"), t), F.lit(t.after_role)).alias("head"),
        F.array_join(F.transform("seen", lambda s: s["shown"]), "").alias("body"),
        F.filter(
            F.transform("seen", lambda s: F.struct(s["kind"].alias("kind"), s["ref"].alias("ref"), s["tokens"].alias("tokens"))),
            lambda s: s["kind"].isNotNull(),
        ).alias("files"),
    )
    before = Window.partitionBy("conv").orderBy("turn", "role", "body", "files").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + F.lit(len(t.close))
    placed = pieces.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long"))
    chats = placed.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("at", "turn", "role", "head", "body", "files"))).alias("turns"))

    def span(x: Column) -> Column:
        start = x["at"] + F.length(x["head"])
        return F.struct(start.cast("long").alias("start"), (start + F.length(x["body"])).cast("long").alias("end"), (x["role"] == t.trained_role).alias("trained"))

    rendered = chats.select(
        "conv",
        "turns",
        F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(t.close))).alias("shown"),
        F.transform("turns", span).alias("spans"),
        F.flatten(
            F.transform("turns", lambda x: F.transform(x["files"], lambda f: F.struct(x["turn"].alias("turn"), f["kind"].alias("kind"), f["ref"].alias("ref"), f["tokens"].alias("tokens"))))
        ).alias("files"),
    )
    return rendered.select(
        F.col("conv").alias(conv_col),
        F.array_join("shown", "").alias("formatted"),
        "spans",
        F.transform(F.filter("spans", lambda s: s["trained"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss_spans"),
        F.transform("files", lambda f, i: F.struct(i.cast("long").alias("slot"), f["turn"].alias("turn"), f["kind"].alias("kind"), f["ref"].alias("ref"), f["tokens"].alias("tokens"))).alias("attachments"),
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate("files", F.lit(0).cast("long"), lambda a, f: a + f["tokens"]).alias("expanded_tokens"),
    )


def _blocks(text: str, t: Template) -> Column:
    """What stands behind each opening mark: escaped texts hold no "<|", so each begins a turn."""
    cut = F.split(F.col(text), _literal(t.open))
    return F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0)))


def _said(block: Column, t: Template) -> tuple[Column, Column]:
    """Role and text of a block; its close mark ends it."""
    cut = F.instr(block, t.after_role)
    return (
        unescaped_role(F.substring(block, F.lit(1), cut - 1), t),
        unescaped(F.substring(block, cut + len(t.after_role), F.length(block) - cut - len(t.after_role) + 1 - len(t.close)), t),
    )


def parse_chats(formatted: DataFrame, template: Template | None = None, text_col: str = "formatted") -> DataFrame:
    """Add ``parsed``, an array of (role, text) read back from the formatted text alone.

    Placeholders of attachments stay in the text as they are shown. A null text has a null ``parsed``.
    """
    t = template or Template()

    def one(b: Column) -> Column:
        role, text = _said(b, t)
        return F.struct(role.alias("role"), text.alias("text"))

    return formatted.withColumn("parsed", F.transform(_blocks(text_col, t), one))


def read_turns(chats: DataFrame, template: Template | None = None, conv_col: str = "conv_id") -> DataFrame:
    """The turns of ``conv_id, formatted, spans`` as rows ``conv_id, number, role, text, learned, chars``.

    Role and text are read from the formatted text alone. ``learned`` is what it holds under the turn's
    trained span, unescaped, or null without one: the span counts from the start of the whole text, and
    a turn's place is the running sum of those before, so nothing is looked up from the start again.
    ``chars`` is the turn's share of the formatted code points.
    """
    t = template or Template()
    zipped = F.arrays_zip(_blocks("formatted", t).alias("block"), F.col("spans").alias("span"))
    rows = chats.select(F.col(conv_col).alias("conv"), F.posexplode(zipped).alias("number", "one")).select("conv", "number", F.col("one")["block"].alias("block"), F.col("one")["span"].alias("span"))
    chars = F.length("block") + F.lit(len(t.open))
    before = Window.partitionBy("conv").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(chars).over(before), F.lit(0)) + F.lit(len(t.open)))
    role, text = _said(F.col("block"), t)
    own = F.substring(F.col("block"), (F.col("span.start") - F.col("at") + 1).cast("int"), (F.col("span.end") - F.col("span.start")).cast("int"))
    return rows.select(F.col("conv").alias(conv_col), "number", role.alias("role"), text.alias("text"), F.when(F.col("span.trained"), unescaped(own, t)).alias("learned"), chars.cast("long").alias("chars"))


def _literal(mark: str) -> str:
    return "\\Q" + mark + "\\E"


def as_text_parts(messages: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` as typed turns with one text part each."""
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("size"),
    )
    return messages.select("conv_id", "turn", "role", F.array(part).alias("parts"))
