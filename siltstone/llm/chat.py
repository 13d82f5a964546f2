"""Chat formatting in budgeted windows, and reading it back, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import name, ready
from siltstone.llm.order import with_place

#: A turn is OPEN role NEWLINE text CLOSE; a window is such turns one after the other.
OPEN, CLOSE = "<turn>", "\n</turn>\n"
#: Tokens of a window, and how many of them repeated turns may take.
BUDGET, FOR_HISTORY = 2048, 256
#: Turns that may be repeated before a window.
HISTORY_TURNS = 2
#: Turns of a conversation whose windows are worked out together.
SEGMENT = 256
#: Characters of a text by which turns with one number and role are dealt to tasks.
HEAD = 1024


def escaped(text: Column) -> Column:
    """Texts cannot hold a mark: a backslash is put before ``<turn``, ``</turn`` and every backslash."""
    return F.regexp_replace(text, r"\\|<(?=/?turn)", r"\\$0")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def most_tokens(role: Column, text: Column) -> Column:
    """No byte-level or byte-fallback tokenizer makes more tokens of a formatted turn: its bytes."""
    marks = len(OPEN) + 1 + len(CLOSE)
    return (F.octet_length(escaped(text)) + F.octet_length(F.url_encode(role)) + marks).cast("long")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Each turn with ``n``, its number in its conversation from 0, and ``rows``, the number of turns there;
    ``sys_n`` and ``sys_tokens`` are those of the first system turn.

    Turns are numbered over the whole table, dealt by ranges, so a conversation of any length spreads.
    """
    head = F.substring("text", 1, HEAD)
    spread = F.when(F.length("text") <= HEAD, F.rand(7))
    first = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
    placed = with_place(turns, [*first, head.asc(), spread.asc()], "place", "chat-turns", [*first, F.col("text").asc()])
    system = F.when(F.col("role") == "system", F.struct("place", "tokens"))
    heads = placed.groupBy(F.col("conv_id").alias("conv_h")).agg(
        F.min("place").alias("first"), F.count("*").alias("rows"), F.min(system).alias("sys")
    )
    joined = placed.join(heads, F.col("conv_id").eqNullSafe(F.col("conv_h")))
    return joined.select(
        *turns.columns,
        (F.col("place") - F.col("first")).alias("n"),
        "rows",
        (F.col("sys.place") - F.col("first")).alias("sys_n"),
        F.col("sys.tokens").alias("sys_tokens"),
    )


def segments(numbered: DataFrame) -> DataFrame:
    """(conv_id, segment, turns, sys_n, sys_tokens): SEGMENT turns in order, behind the last HISTORY_TURNS of the
    segment before, which are marked ``ghost``."""
    own = F.floor(F.col("n") / SEGMENT)
    seam = (F.col("n") % SEGMENT >= SEGMENT - HISTORY_TURNS) & ((own + 1) * SEGMENT < F.col("rows"))
    here = F.struct(own.alias("segment"), F.lit(False).alias("ghost"))
    there = F.when(seam, F.struct((own + 1).alias("segment"), F.lit(True).alias("ghost")))
    dealt = numbered.withColumn("to", F.explode(F.array_compact(F.array(here, there))))
    turn = F.struct("n", F.col("to.ghost").alias("ghost"), "role", "text", "tokens")
    return dealt.groupBy("conv_id", F.col("to.segment").alias("segment")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"),
        F.first("sys_n").alias("sys_n"),
        F.first("sys_tokens").alias("sys_tokens"),
    )


def window_starts(budget: int) -> Column:
    """(at, again) for each window of a segment: the place of its first own turn, and how many turns before
    it are repeated.

    A window takes turns as long as they fit. What does not fit begins the next one, behind the system
    turn and as many of the turns before as fit FOR_HISTORY and the budget.
    """
    long, start = "bigint", "struct<at:int,again:int>"
    zero = F.struct(
        F.lit(0).alias("i"),
        F.lit(None).cast(long).alias("room"),
        F.lit(None).cast(long).alias("last1"),
        F.lit(None).cast(long).alias("last2"),
        F.array().cast(f"array<{start}>").alias("starts"),
    )

    def step(acc: Column, turn: Column) -> Column:
        def opened(again: int, history: Column) -> Column:
            """Room in a window that begins here and repeats so many turns."""
            system = F.when(F.col("sys_n") < turn.n - again, F.col("sys_tokens")).otherwise(0)
            return F.lit(budget) - F.coalesce(system, F.lit(0)) - history - turn.tokens

        one, two = acc.last1, acc.last1 + acc.last2
        both = F.coalesce((two <= FOR_HISTORY) & (opened(2, two) >= 0), F.lit(False))
        single = F.coalesce((one <= FOR_HISTORY) & (opened(1, one) >= 0), F.lit(False))
        none = opened(0, F.lit(0))
        again = F.when(both, 2).when(single, 1).otherwise(0)
        fresh = F.when(both, opened(2, two)).when(single, opened(1, one)).otherwise(none)
        fits = F.coalesce(acc.room >= turn.tokens, F.lit(False))
        begins = F.array(F.struct(acc.i.alias("at"), again.cast("int").alias("again")))
        room = F.when(turn.ghost, acc.room).when(fits, acc.room - turn.tokens).otherwise(fresh)
        return F.struct(
            (acc.i + 1).alias("i"),
            room.cast(long).alias("room"),
            turn.tokens.alias("last1"),
            acc.last1.alias("last2"),
            F.when(turn.ghost | fits, acc.starts).otherwise(F.concat(acc.starts, begins)).alias("starts"),
        )

    return F.aggregate("turns", zero, step, lambda acc: acc.starts)


def cut_windows(parts: DataFrame, budget: int) -> DataFrame:
    """(conv_id, segment, window, turns) with ``again`` for repeated turns."""
    found = parts.withColumn("starts", window_starts(budget))

    def window(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("starts"), k + 1).at, F.size("turns"))
        taken = F.slice("turns", start.at - start.again + 1, end - start.at + start.again)
        marked = F.transform(
            taken,
            lambda t, i: F.struct(t.n.alias("n"), t.role.alias("role"), t.text.alias("text"), (i < start.again).alias("again"), t.tokens.alias("tokens")),
        )
        return F.struct(k.cast("long").alias("window"), marked.alias("turns"))

    return found.select("conv_id", "segment", F.explode(F.transform("starts", window)).alias("w")).select(
        "conv_id", "segment", "w.window", "w.turns"
    )


def formatted(conversations: DataFrame, budget: int = BUDGET, tokens: str | None = None) -> DataFrame:
    """Windows of conversations (conv_id, turn, role, text) as training texts.

    Columns: conv_id, segment, window (numbers that ascend), text, loss_spans (start from 0 and length, in
    code points, of the escaped assistant texts to be learned here), n_context (turns at the head that
    stand elsewhere too: the first system turn and repeated history, never learned), n_tokens, over_budget.

    ``tokens`` names a column with the tokens of each formatted turn; without it the bytes of the turn stand for
    them, which no byte-level or byte-fallback tokenizer exceeds. Windows follow from the order of the turns, not
    from their numbers. Every turn is learned from in exactly one window. The first system turn stands at the
    head of each later window. Turns are never cut: a window is over its budget only if one turn with the
    system turn is, and then says so. NULL text and role: empty. Turns with one number are ordered by role
    and text, NULL numbers come first. NULL is a conversation of its own. A long conversation is spread by
    segments of SEGMENT turns, at whose ends windows end, so no conversation is gathered in one place.
    Other columns are ignored; no rows give no windows.
    """
    ready(conversations.sparkSession)
    turns = conversations.select(
        name("conv_id").alias("conv_id"),
        name("turn").cast("long").alias("turn"),
        F.coalesce(name("role"), F.lit("")).alias("role"),
        F.coalesce(name("text"), F.lit("")).alias("text"),
        *([F.coalesce(name(tokens).cast("long"), F.lit(0).cast("long")).alias("tokens")] if tokens else []),
    )
    if not tokens:
        turns = turns.withColumn("tokens", most_tokens(F.col("role"), F.col("text")))
    numbered = numbered_turns(turns)
    systems = numbered.where(F.col("n") == F.col("sys_n")).select(
        F.col("conv_id").alias("conv_s"), F.struct("n", "role", "text", F.lit(True).alias("again"), "tokens").alias("sys")
    )
    windows = cut_windows(segments(numbered), budget)
    windows = windows.join(systems, F.col("conv_id").eqNullSafe(F.col("conv_s")), "left")
    later = F.col("sys").isNotNull() & (F.col("sys.n") < F.col("turns")[0].n)
    windows = windows.withColumn("turns", F.when(later, F.concat(F.array("sys"), "turns")).otherwise(F.col("turns")))
    # The text of each turn, and where in the window it starts.
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), F.url_encode(t.role), F.lit("\n")).alias("head"),
            escaped(t.text).alias("body"),
            ((t.role == "assistant") & ~t.again).alias("learned"),
        ),
    )
    windows = windows.withColumn("parts", parts)

    def walk(acc: Column, p: Column) -> Column:
        start = acc.at + F.length(p["head"])
        span = F.struct(start.alias("start"), F.length(p.body).alias("length"))
        return F.struct(
            (start + F.length(p.body) + len(CLOSE)).alias("at"),
            F.when(p.learned, F.concat(acc.spans, F.array(span))).otherwise(acc.spans).alias("spans"),
        )

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    total = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t.tokens)
    return windows.select(
        "conv_id",
        "segment",
        "window",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p.body, F.lit(CLOSE))), "").alias("text"),
        F.aggregate("parts", none, walk).spans.alias("loss_spans"),
        F.size(F.filter("turns", lambda t: t.again)).alias("n_context"),
        total.alias("n_tokens"),
        (total > budget).alias("over_budget"),
    )


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted window."""
    pieces = F.split(text, CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            F.url_decode(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
            unescaped(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
        ),
    )


def learned_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    found = F.transform(spans, lambda s: unescaped(F.substr(text, s.start + 1, s.length)))
    return F.array_join(found, "")


def digests(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from windows.

    A digest of a whole conversation needs its text in one value; the windows themselves do not.
    """
    own = F.col("turns_")
    read = windows.withColumn("turns_", read_turns(F.col("text"))).withColumn(
        "turns_", F.slice(own, F.col("n_context") + 1, F.greatest(F.size(own) - F.col("n_context"), F.lit(0)))
    )
    body = F.array_join(F.transform(own, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    parts = read.select(
        "conv_id",
        F.struct(
            "segment", "window", body.alias("body"), learned_text(F.col("text"), F.col("loss_spans")).alias("loss")
        ).alias("part"),
        F.size(own).alias("n"),
        F.length("text").alias("chars"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("part")).alias("parts"),
        F.sum("n").cast("long").alias("n_turns"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    text = F.array_join(F.transform("parts", lambda p: p.body), "")
    loss = F.array_join(F.transform("parts", lambda p: p.loss), "")
    return whole.withColumn("loss_", loss).select(
        "conv_id",
        "n_turns",
        F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss_").cast("long").alias("loss_chars"),
        F.sha2("loss_", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def probe(conversations: DataFrame) -> DataFrame:
    """A conversation whose texts look like marks, with the types of the given table."""
    spark = conversations.sparkSession
    text = "\\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    values = {"conv_id": F.lit(-7), "turn": F.col("id"), "role": role, "text": F.lit(text)}
    return spark.range(2).select(
        *(v.cast(conversations.schema[c].dataType).alias(c) for c, v in values.items())
    )
