"""Chat formatting by prefix-target expansion, in DataFrame functions alone.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for every turn. Inside roles
and texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|``, in roles a line
break becomes ``&nl;`` as well, so no control string can come from content and
all of it can be read back.

``turns`` renders every turn by itself. ``examples`` has one row for every
assistant turn: all turns before it are its context, only its reply is
trainable. Every example holds its context, a prefix of the conversation's
rendered text, so a conversation of n turns has examples of the order of n
squared. They can be stored without it: ``with_context`` writes it again.

Turns are ordered by (turn, role, text); repeated rows are turns of their own.
Null roles and texts are empty. Null conversation ids form one conversation.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.functions.let import let
from vialens.llm.shared import settle

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, head, reply, piece): every turn rendered, ``head`` up to its text."""
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    shown = F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.concat(F.lit(START), shown, F.lit("\n")).alias("head"),
        escape(text).alias("reply"),
    )
    return rows.withColumn("piece", F.concat("head", "reply", F.lit(END + "\n")))


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, text, targets): a conversation's rendered turns one after the other.

    ``targets`` has a struct for every assistant turn: the length of the
    rendered context, where the trainable reply begins and where it ends, in
    code points. Rendering happens before the shuffle; what meets in one row
    is the conversation's text, which the row holds anyway.
    """
    turn = F.struct(
        "turn",
        "role",
        "reply",
        F.length("head").alias("head"),
        F.length("piece").alias("size"),
        "piece",
    )
    rows = turns(conversations).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(turn)).alias("rows")
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_TARGETS).alias("targets"))

    def step(so_far: Column, row: Column) -> Column:
        reply = so_far["at"] + row["head"]
        target = F.struct(
            so_far["at"].alias("context_chars"),
            reply.alias("begin"),
            (reply + F.length(row["reply"])).alias("end"),
        )
        is_target = row["role"] == "assistant"
        return F.struct(
            (so_far["at"] + row["size"]).alias("at"),
            F.when(is_target, F.concat(so_far["targets"], F.array(target)))
            .otherwise(so_far["targets"])
            .alias("targets"),
        )

    return rows.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("text"),
        F.aggregate("rows", begin, step)["targets"].alias("targets"),
    )


_TARGETS = "array<struct<context_chars:int,begin:int,end:int>>"


def examples(rendered: DataFrame) -> DataFrame:
    """(conv_id, example, context_chars, begin, end, target, context): one row an assistant turn.

    ``context`` holds all turns before it, the first ``context_chars`` of the
    conversation's text, the reply under the loss mask is [begin, end) of that
    text, and ``target`` is the reply with the marks around it.
    """
    rows = rendered.select("conv_id", "text", F.posexplode("targets").alias("example", "t"))
    start = F.col("t.context_chars")
    size = F.col("t.end") + len(END) - start
    return rows.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        "t.context_chars",
        "t.begin",
        "t.end",
        F.substr("text", start + 1, size).alias("target"),
        F.substr("text", F.lit(1), start).alias("context"),
    )


def with_context(rendered: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` examples, kept without their contexts, with ``context`` as ``examples`` gives it."""
    texts = rendered.select("conv_id", "text")
    joined = chosen.drop("context").alias("e").join(
        texts.alias("t"), F.col("e.conv_id").eqNullSafe(F.col("t.conv_id"))
    )
    context = F.substr("t.text", F.lit(1), F.col("e.context_chars"))
    return joined.select("e.*", context.alias("context"))


def parsed(text: Column) -> Column:
    """array<struct<role,text>> read back from rendered text."""
    pieces = F.split(text, r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(START) + 1))
        at = F.instr(body, "\n")
        role = F.replace(F.substr(body, F.lit(1), at - 1), F.lit("&nl;"), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), unescape(F.substr(body, at + 1)).alias("text"))

    return F.transform(pieces, turn)


def losses(said: DataFrame) -> DataFrame:
    """(conv_id, loss_chars, loss_sha256, formatted_chars) of the examples of each conversation."""
    mask = F.substr("target", F.col("begin") - F.col("context_chars") + 1, F.col("end") - F.col("begin"))
    rows = said.select(
        "conv_id",
        F.struct("example", unescape(mask).alias("reply")).alias("trained"),
        (F.length("context").cast("long") + F.length("target") + 1).alias("size"),
    )
    by_conversation = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("trained"))["reply"].alias("replies"),
        F.sum("size").alias("formatted_chars"),
    )
    loss = let(F.array_join("replies", ""), lambda s: F.struct(
        F.length(s).cast("long").alias("n"), F.sha2(s.cast("binary"), 256).alias("sha")))
    read = by_conversation.select("conv_id", loss.alias("loss"), "formatted_chars")
    return read.select(
        "conv_id",
        F.col("loss.n").alias("loss_chars"),
        F.col("loss.sha").alias("loss_sha256"),
        "formatted_chars",
    )


def digests(conversations: DataFrame) -> DataFrame:
    """What the formatted texts and the examples hold, read back from them, by conversation.

    The turns are parsed from a conversation's text. The examples are written
    with their contexts, and what they train on and their lengths come from the
    table read back; zstd keeps little of what neighbouring contexts repeat.
    ``formatted_chars`` is the length of all examples, contexts included; a
    conversation's turns after its last assistant turn are in its text, but in
    no example.
    """
    rendered = formatted(conversations)

    def spoken(rows: Column) -> Column:
        return F.array_join(
            F.transform(rows, lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), ""
        )

    whole = let(parsed(F.col("text")), lambda r: F.struct(
        F.size(r).cast("long").alias("n"), F.sha2(spoken(r).cast("binary"), 256).alias("sha")))
    read = rendered.select("conv_id", whole.alias("whole")).alias("t")
    trained = losses(settle(examples(rendered), "zstd")).alias("e")
    both = read.join(trained, F.col("t.conv_id").eqNullSafe(F.col("e.conv_id")), "left")
    return both.select(
        "t.conv_id",
        F.col("whole.n").alias("n_turns"),
        F.col("whole.sha").alias("turns_sha256"),
        F.coalesce("loss_chars", F.lit(0).cast("long")).alias("loss_chars"),
        F.coalesce("loss_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("loss_sha256"),
        F.coalesce("formatted_chars", F.lit(0).cast("long")).alias("formatted_chars"),
    )
