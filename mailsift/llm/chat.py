"""Chat formatting as relational expressions.

A conversation is one string and therefore one row: its turns are collected as structs, sorted, and
each becomes a piece that depends on the role before it; the pieces are joined at the end. Adjacent turns of one
role share a block; a mark between them keeps them apart, so that the original turns can be read back:

    <|im_start|>role\\ntext<|turn|>text<|im_end|>\\n

Control strings inside texts are broken by an escape mark, which is itself escaped, so a text can
never open or close anything and comes back as it was.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values -----------------------------------------------------------------------------
BLOCK_START = "<|im_start|>"
TURN_BREAK = "<|turn|>"
BLOCK_END = "<|im_end|>"
# Strings that a template or a tokenizer gives a meaning of their own.
CONTROL_STRINGS = (
    BLOCK_START, TURN_BREAK, BLOCK_END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>",
    "<</SYS>>",
)
ESCAPE = "␛"
# ----------------------------------------------------------------------------------------------

TURNS = "array<struct<role:string,text:string>>"
# Running sums and texts are worked out in parts of so many, so that a conversation of n turns costs n times this.
PART = 256
CHUNK = 4_096


def escaped(text: Column) -> Column:
    """The escape sign gets a 0; a control string gets the sign and a 1 after its first character."""
    marked = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    return reduce(
        lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}{ESCAPE}1{c[1:]}")), CONTROL_STRINGS, marked
    )


def unescaped(text: Column) -> Column:
    joined = F.replace(text, F.lit(ESCAPE + "1"), F.lit(""))
    return F.replace(joined, F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def escaped_role(role: Column) -> Column:
    """A role ends with its line, so its line feeds are written as the sign and a 2."""
    return F.replace(escaped(role), F.lit("\n"), F.lit(ESCAPE + "2"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(ESCAPE + "2"), F.lit("\n")))


def collected(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation by ``turn``, equal ones by role and text, a
    null ``turn`` first. Null roles and texts are empty; repeated rows are turns of their own."""
    blank = F.lit("")
    turn = F.struct(
        "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")
    )
    return conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def formatted(conversations: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans): one row per conversation, a null ``conv_id`` being one.

    ``loss_spans`` has a (start, length) in code points for each turn of ``learned_role``: the turn's
    text as it stands in ``formatted``. An empty text has a span of length 0.
    """
    shown = F.transform(
        "turns",
        lambda t: F.struct(
            t["role"].alias("role"), escaped_role(t["role"]).alias("shown"), escaped(t["text"]).alias("body")
        ),
    )
    rows = collected(conversations).select("conv_id", shown.alias("shown"))
    # Each column below is used more than once by the next step, so the engine works it out once.
    roles = F.transform("shown", lambda t: t["role"])
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(roles, F.lit(1), F.size("shown") - 1))

    def piece(turn: Column, role_before: Column) -> Column:
        head = F.concat(F.lit(BLOCK_START), turn["shown"], F.lit("\n"))
        opens = (
            F.when(role_before.isNull(), head)
            .when(role_before == turn["role"], F.lit(TURN_BREAK))
            .otherwise(F.concat(F.lit(BLOCK_END + "\n"), head))
        )
        return F.struct(
            (turn["role"] == learned_role).alias("learned"),
            F.concat(opens, turn["body"]).alias("text"),
            F.char_length(opens).cast("bigint").alias("opening"),
            F.char_length(turn["body"]).cast("bigint").alias("length"),
        )

    rows = rows.select("conv_id", F.zip_with("shown", before, piece).alias("pieces"))
    lengths = F.transform("pieces", lambda p: p["opening"] + p["length"])
    rows = _with_starts(rows.withColumn("_lengths", lengths))
    spans = F.zip_with(
        "pieces",
        "_starts",
        lambda p, at: F.struct(p["learned"].alias("learned"), (at + p["opening"]).alias("start"), p["length"].alias("length")),
    )
    spans = F.transform(
        F.filter(spans, lambda s: s["learned"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))
    )
    text = F.concat(F.array_join(F.transform("pieces", lambda p: p["text"]), ""), F.lit(BLOCK_END + "\n"))
    return rows.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def _starts(lengths: Column) -> Column:
    """(starts, total) of a short array of lengths: the sum of those before each one, and of all."""
    none = F.struct(F.array().cast("array<bigint>").alias("starts"), F.lit(0).cast("bigint").alias("total"))
    return F.aggregate(
        lengths,
        none,
        lambda done, n: F.struct(
            F.array_append(done["starts"], done["total"]).alias("starts"), (done["total"] + n).alias("total")
        ),
    )


def _with_starts(rows: DataFrame) -> DataFrame:
    """``_starts`` for ``_lengths``: the sum of the lengths before each one, part by part."""
    others = [c for c in rows.columns if c != "_lengths"]
    parts = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_lengths") - 1) / PART).cast("int")),
        lambda b: _starts(F.slice("_lengths", b * PART + 1, F.lit(PART))),
    )
    rows = rows.select(*others, parts.alias("_parts"))
    totals = _starts(F.transform("_parts", lambda p: p["total"]))["starts"]
    moved = F.zip_with("_parts", totals, lambda p, at: F.transform(p["starts"], lambda s: s + at))
    return rows.select(*others, F.flatten(moved).alias("_starts"))


def read_back(formatted_rows: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts, formatted): the turns in order and the texts under the loss mask,
    both from the formatted text and its spans alone."""
    def quoted(mark: str) -> str:
        return "\\Q" + mark + "\\E"

    blocks = F.split("formatted", quoted(BLOCK_END + "\n"))
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns_of(block: Column) -> Column:
        inner = F.substr(block, F.lit(len(BLOCK_START) + 1))
        role = F.substring_index(inner, "\n", 1)
        body = F.substr(inner, F.char_length(role) + 2)
        return F.transform(
            F.split(body, quoted(TURN_BREAK)),
            lambda t: F.struct(unescaped_role(role).alias("role"), unescaped(t).alias("text")),
        )

    # A span is cut out of the chunks that it lies in, not counted from the start of the whole text.
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor(F.char_length("formatted") / CHUNK).cast("int")),
        lambda i: F.substr("formatted", i * CHUNK + 1, F.lit(CHUNK)),
    )
    rows = formatted_rows.withColumn("_chunks", chunks)

    def cut(span: Column) -> Column:
        first = F.floor(span["start"] / CHUNK).cast("int")
        last = F.least(F.floor((span["start"] + span["length"]) / CHUNK).cast("int"), F.size("_chunks") - 1)
        near = F.array_join(F.slice("_chunks", first + 1, last - first + 1), "")
        at = span["start"] - first.cast("bigint") * CHUNK
        return unescaped(F.substr(near, (at + 1).cast("int"), span["length"].cast("int")))

    masked = F.transform("loss_spans", cut)
    return rows.select(
        "conv_id", F.flatten(F.transform(blocks, turns_of)).alias("turns"), masked.alias("loss_texts"),
        "formatted",
    )


def digests(read: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)"""
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
