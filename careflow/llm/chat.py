"""Chat formatting: turns of a conversation become one marked-up text with a loss mask.

Template, one block per run of turns of one role::

    ### role: first text<part>second text</turn>

``\\``, ``<`` and ``#`` inside texts (``:`` too inside roles) are written ``\\b``, ``\\l``, ``\\h``
(``\\c``), so that no text can hold a control string and reading back gives every turn as it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, PART, END = "### ", "<part>", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
#: Turns that are merged before those of a whole conversation come together.
CHUNK = 256
#: A running sum goes over groups of so many, whose sums are added up the same way; this many levels.
GROUP, LEVELS = 64, 2
#: Characters of the pieces that a formatted text is read in.
PIECE = 1024
_SPANS = "array<struct<start:int,chars:int>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, x: total + x)


def _before(values: Column, levels: int = LEVELS) -> Column:
    """The sum of all values before each, in time that is linear for up to millions of them."""
    def plain(all_: Column) -> Column:
        return F.transform(all_, lambda _, i: _sum(F.slice(all_, F.lit(1), i)))

    def grouped(all_: Column) -> Column:
        groups = F.transform(
            F.sequence(F.lit(0), ((F.size(all_) - 1) / GROUP).cast("int")),
            lambda g: _sum(F.slice(all_, g * GROUP + 1, F.lit(GROUP))))

        def element(earlier: Column, i: Column) -> Column:
            group = (i / GROUP).cast("int")
            return F.get(earlier, group) + _sum(F.slice(all_, group * GROUP + 1, i - group * GROUP))

        return _let(_before(groups, levels - 1), lambda earlier: F.transform(all_, lambda _, i: element(earlier, i)))

    if levels == 0:
        return _let(values, plain)
    return _let(values, lambda all_: F.when(F.size(all_) > GROUP, grouped(all_)).otherwise(plain(all_)))


def escape(text: Column, escapes=ESCAPES) -> Column:
    for raw, mark in escapes:
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for raw, mark in reversed(escapes):
        text = F.replace(text, F.lit(mark), F.lit(raw))
    return text


def _merge(items: Column, parts: Callable[[Column], Column]) -> Column:
    """Blocks of ``role`` and ``parts``: neighbouring items of one role become one, with the parts of all.

    The places where the role changes are found first; each block is one slice.
    """
    def blocks(all_: Column) -> Column:
        starts = F.filter(F.when(F.size(all_) > 0, F.sequence(F.lit(0), F.size(all_) - 1)), lambda i: (
            (i == 0) | (F.get(all_, i)["role"] != F.get(all_, i - 1)["role"])))

        def block(places: Column, start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(places, k + 1), F.size(all_))
            return F.struct(
                F.get(all_, start)["role"].alias("role"), parts(F.slice(all_, start + 1, end - start)).alias("parts"))

        return _let(starts, lambda places: F.transform(places, lambda start, k: block(places, start, k)))

    return _let(items, blocks)


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, n_blocks, formatted, loss_spans``.

    ``turns`` has ``conv_id, turn, role, text``; other columns are ignored.  Turns are ordered by
    turn, then role and text (null turns first); repeated rows stay as turns of their own.  Null
    text or role counts as empty; rows without a conversation id form one conversation with null
    id.  An empty table gives no row.  ``loss_spans`` are (start from 1, chars) of the escaped
    texts of ``loss_role``, one per turn, in ``formatted``.  A conversation becomes one string, so
    it may hold up to 2 GB; chunks of its turns are merged before they meet.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chunks = (
        turns.select("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk"), turn.alias("turn"))
        .groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
        .select("conv_id", "chunk", F.size("turns").alias("n"), _merge(
            F.col("turns"), lambda some: F.transform(some, lambda t: escape(t["text"]))).alias("blocks"))
        .withColumn("blocks", F.transform("blocks", lambda b: b.withField("role", escape(b["role"], ROLE_ESCAPES))))
    )
    mark = F.lit(escape_text(loss_role, ROLE_ESCAPES))

    def shaped(block: Column) -> Column:
        """Where the parts of a block start, counted from the block, and its size."""
        head, n = F.length(block["role"]) + len(TURN) + 2, F.size(block["parts"])
        lengths = F.transform(block["parts"], F.length)
        size = head + _sum(lengths) + (n - 1) * len(PART) + len(END)
        starts = _let(_before(lengths), lambda before: F.transform(block["parts"], lambda part, i: F.struct(
            (head + F.get(before, i) + i * len(PART)).cast("int").alias("start"), F.length(part).alias("chars"))))
        return F.struct(
            size.cast("int").alias("size"), F.when(block["role"] == mark, starts).otherwise(F.array().cast(_SPANS)).alias("spans"))

    def spans(shapes: Column) -> Column:
        return _let(_before(F.transform(shapes, lambda s: s["size"])), lambda before: F.flatten(F.transform(
            shapes, lambda s, i: F.transform(s["spans"], lambda x: F.struct(
                (F.get(before, i) + x["start"] + 1).alias("start"), x["chars"].alias("chars"))))))

    whole = F.transform("blocks", lambda b: F.concat(
        F.lit(TURN), b["role"], F.lit(": "), F.array_join(b["parts"], PART), F.lit(END)))
    return (
        chunks.groupBy("conv_id")
        .agg(F.sum("n").alias("n_turns"),
             F.array_sort(F.collect_list(F.struct("chunk", "blocks"))).alias("chunks"))
        .select("conv_id", "n_turns", _merge(
            F.flatten(F.col("chunks.blocks")),
            lambda some: F.flatten(F.transform(some, lambda b: b["parts"]))).alias("blocks"))
        .select("conv_id", "n_turns", F.size("blocks").cast("long").alias("n_blocks"),
                F.array_join(whole, "").alias("formatted"),
                _let(F.transform("blocks", shaped), spans).alias("loss_spans"))
    )


def escape_text(text: str, escapes=ESCAPES) -> str:
    for raw, mark in escapes:
        text = text.replace(raw, mark)
    return text


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text was made of."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")

    def parts(block: Column) -> Column:
        colon = F.instr(block, ": ")
        role = unescape(block.substr(F.lit(len(TURN) + 1), colon - len(TURN) - 1), ROLE_ESCAPES)
        body = F.split(block.substr(colon + 2, F.length(block)), PART)
        return F.transform(body, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, parts))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order.

    The text is cut into pieces once, so that no span needs a walk from its beginning.
    """
    def cut(pieces: Column, span: Column) -> Column:
        first, last = F.floor((span["start"] - 1) / PIECE), F.floor((span["start"] + span["chars"] - 2) / PIECE)
        near = F.array_join(F.slice(pieces, (first + 1).cast("int"), F.greatest(last - first + 1, F.lit(1)).cast("int")), "")
        return near.substr((span["start"] - first * PIECE).cast("int"), span["chars"])

    return _let(F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda pieces: F.array_join(
        F.transform(spans, lambda span: unescape(cut(pieces, span))), ""))
