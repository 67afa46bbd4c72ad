"""Chat conversations as single training texts with a loss mask.

Relational formatting in Spark expressions only: the turns of a conversation
are collected as structs and sorted, adjacent turns of one role are merged
into blocks by array functions, and blocks are concatenated.

Template (fixed)::

    ### Role: first text</turn>second text</turn>\\n### Other role: ...</turn>\\n

Every block starts with a header that names its role; every turn of it ends
with the end mark; a line feed ends the block.  In texts and roles ``\\``
becomes ``\\b``, ``#`` ``\\h`` and ``<`` ``\\l`` (in roles ``:`` becomes ``\\c``), so
the signs that control strings start with never occur inside a text, and
roles and texts of all turns can be read back from the output alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEADER, AFTER_ROLE, END, BLOCK_END = "### ", ": ", "</turn>", "\n"
LEARNED_ROLE = "assistant"


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


ESCAPES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c")]  # the backslash goes first


def escape(text: Column, role: bool = False) -> Column:
    return _replaced(text, ESCAPES if role else ESCAPES[:3])


def unescape(text: Column) -> Column:
    return _replaced(text, [(new, old) for old, new in reversed(ESCAPES)])


def format_conversations(conversations: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` (its text) and
    ``loss_spans``, an array of (start, end) code point ranges of
    ``formatted`` that hold the texts of ``learned_role``, in order.

    Turns are sorted by turn, role and text, null first.  Null text or role:
    empty.  A null conv_id is a conversation of its own.  Repeated rows are
    repeated turns.  Empty texts have empty spans.  Empty table: no rows.
    Other columns are ignored.  A conversation is one output row, so its rows
    meet in one task.
    """
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    turns = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))
    n = F.size("turns")
    at = lambda i: F.element_at("turns", i)
    # Where a block of adjacent turns of one role starts (1-based).
    starts = F.filter(F.sequence(F.lit(1), n),
                      lambda i: (i == 1) | (at(i)["role"] != F.coalesce(F.get("turns", i - 2)["role"], F.lit(""))))
    blocks = F.transform("starts", lambda s, k: F.struct(
        at(s)["role"].alias("role"),
        F.transform(F.slice("turns", s, F.coalesce(F.get("starts", k + 1), n + 1) - s),
                    lambda t: escape(t["text"])).alias("texts")))
    # Pieces of the output in order, those of learned turns marked.
    header = lambda b: F.concat(F.lit(HEADER), escape(b["role"], role=True), F.lit(AFTER_ROLE))
    piece = lambda text, learned: F.struct(text.alias("text"), learned.alias("learned"))
    pieces = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(piece(header(b), F.lit(False))),
        F.flatten(F.transform(b["texts"], lambda x: F.array(
            piece(x, b["role"] == learned_role), piece(F.lit(END), F.lit(False))))),
        F.array(piece(F.lit(BLOCK_END), F.lit(False))))))
    # Where pieces end: a running sum over the pieces as rows, so a long
    # conversation costs no more a turn than a short one.  The rows of a
    # conversation are in one task already.
    placed = turns.withColumn("starts", starts).withColumn("blocks", blocks).select(
        "conv_id", F.posexplode(pieces).alias("nth", "p"))
    upto = Window.partitionBy("conv_id").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = placed.select("conv_id", F.struct(
        "nth", "p.text", "p.learned", F.sum(F.length("p.text").cast("bigint")).over(upto).alias("end")).alias("p"))
    whole = ended.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("p"))
    spans = F.transform(F.filter("p", lambda x: x["learned"]), lambda x: F.struct(
        (x["end"] - F.length(x["text"])).alias("start"), x["end"].alias("end")))
    return whole.select(
        "conv_id", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, read from it alone."""
    blocks = F.split(formatted, HEADER, -1)  # what stands before the first header is empty
    role = lambda b: unescape(F.substring_index(b, AFTER_ROLE, 1))
    body = lambda b: F.substr(b, F.instr(b, F.lit(AFTER_ROLE)) + len(AFTER_ROLE))
    texts = lambda b: F.split(body(b), END, -1)  # noqa: E731  after the last end mark stands the line feed
    return F.flatten(F.transform(F.slice(blocks, 2, F.size(blocks)), lambda b: F.transform(
        F.slice(texts(b), 1, F.size(texts(b)) - 1),
        lambda t: F.struct(role(b).alias("role"), unescape(t).alias("text")))))


CUT = 4_096  # code points


def learned_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order.  The text is cut
    into strips once, and a span is looked for in its own strips only."""
    strips = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))

    def text(strips: Column, s: Column) -> Column:
        first = F.floor(s["start"] / CUT).cast("int")
        last = F.floor(F.greatest(s["end"] - 1, s["start"]) / CUT).cast("int")
        own = F.array_join(F.slice(strips, first + 1, last - first + 1), "")
        return F.substring(own, (s["start"] % CUT + 1).cast("int"), (s["end"] - s["start"]).cast("int"))

    # one value for all spans: strips of a whole text are cut only once
    return F.flatten(F.transform(F.array(strips), lambda a: F.transform(spans, lambda s: unescape(text(a, s)))))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, learned`` (array of texts), ``formatted`` of the
    output of :func:`format_conversations`."""
    return formatted.select("conv_id", read_turns(F.col("formatted")).alias("turns"),
                            learned_texts(F.col("formatted"), F.col("loss_spans")).alias("learned"), "formatted")
