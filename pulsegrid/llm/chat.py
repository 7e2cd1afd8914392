"""Chat formatting: the turns of a conversation as one training string with a loss mask.

Turns are collected as structs and sorted; neighbours of one role share a block. Everything is a Spark expression.

A template has three marks: one opens a block, one joins turns of the same block, one closes it. Marks (and those of an older
bracket template) inside a text get a backslash after their first character, and one more if there are some already, so the
texts can be read back and a text never opens or closes a block.

Defined cases: a NULL text or role is empty; a NULL turn sorts first; equal turns are ordered by role, then text, and all are
kept; a NULL conversation id is a conversation of its own; an empty table gives no rows; other columns are not carried.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

#: Turns that are gathered in one row before a conversation is put together.
CHUNK_TURNS = 256
LOSS_ROLES = ("assistant",)

_MARKS = r"\|im_(?:start|sep|end)\|>|/?s>|/?INST\]|</?SYS>>"
_ESCAPE = rf"([<\[])(\\*)({_MARKS})"
_UNESCAPE = rf"([<\[])\\(\\*)({_MARKS})"


@dataclass(frozen=True)
class Template:
    """Marks of a format; each must be one that ``escape`` knows."""

    start: str = "<|im_start|>"
    joint: str = "<|im_sep|>"
    end: str = "<|im_end|>\n"


CHAT_MARKS = Template()


def escape(text):
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text):
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def _role_name(role):
    """A role stands on a line of its own, so its line feeds are written as %0A."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_of(name):
    return F.replace(F.replace(unescape(name), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_conversations(df, conv="conv_id", turn="turn", role="role", text="text", template=CHAT_MARKS,
                         loss_roles=LOSS_ROLES, chunk_turns=CHUNK_TURNS):
    """One row per conversation: ``conv``, n_turns, n_blocks, formatted, and segments ``(text, loss)`` in order.

    The segments joined are ``formatted``; those with ``loss`` are the mask. A long conversation is escaped and sorted in
    chunks of turns, which meet only as finished pieces.
    """
    order = F.coalesce(F.col(turn).cast("long"), F.lit(-(2 ** 63)))
    rows = df.select(
        F.col(conv).alias("conv"), F.floor(order / F.lit(chunk_turns)).alias("chunk"),
        F.struct(order.alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"),
    )
    chunks = rows.groupBy("conv", "chunk").agg(F.array_sort(F.array_agg("t")).alias("ts")).select(
        "conv", "chunk",
        F.transform("ts", lambda t: F.struct(t["role"].alias("role"), escape(t["text"]).alias("text"))).alias("ts"))
    whole = chunks.groupBy("conv").agg(F.array_sort(F.array_agg(F.struct("chunk", "ts"))).alias("cs")).select(
        "conv", F.flatten(F.transform("cs", lambda c: c["ts"])).alias("ts"))

    def lead(t, i):
        opened = F.concat(F.lit(template.start), _role_name(t["role"]), F.lit("\n"))
        return (F.when(i == 0, opened)
                .when(F.get("ts", i - 1)["role"] == t["role"], F.lit(template.joint))
                .otherwise(F.concat(F.lit(template.end), opened)))

    pieces = F.transform("ts", lambda t, i: F.struct(
        lead(t, i).alias("lead"), t["text"].alias("text"), t["role"].isin(*loss_roles).alias("loss")))
    parts = whole.select("conv", pieces.alias("ps"))
    segments = F.concat(
        F.flatten(F.transform("ps", lambda p: F.array(
            F.struct(p["lead"].alias("text"), F.lit(False).alias("loss")),
            F.struct(p["text"].alias("text"), p["loss"].alias("loss"))))),
        F.array(F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss"))))
    joined = parts.select(
        "conv", F.size("ps").cast("long").alias("n_turns"),
        F.size(F.filter("ps", lambda p: p["lead"] != template.joint)).cast("long").alias("n_blocks"),
        segments.alias("segments"))
    return joined.select(
        F.col("conv").alias(conv), "n_turns", "n_blocks",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parsed_turns(formatted, template=CHAT_MARKS):
    """The turns ``(role, text)`` of a formatted string, as they were before."""
    def quoted(mark):
        return "\\Q" + mark + "\\E"

    def of_block(block):
        inner = F.left(block, F.length(block) - F.lit(len(template.end)))
        name = F.substring_index(inner, "\n", 1)
        texts = F.split(F.substr(inner, F.length(name) + 2), quoted(template.joint))
        return F.transform(texts, lambda x: F.struct(_role_of(name).alias("role"), unescape(x).alias("text")))

    blocks = F.split(formatted, quoted(template.start))
    return F.flatten(F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), of_block))


def masked_text(segments):
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
