"""Linking quotations to the messages they quote, in DataFrame functions only.

A line that begins with ``>`` marks is quoted; the number of marks is its
level. Neighbouring lines of one level are a passage. A message holds a passage
if that is its whole own text, a paragraph, or consecutive sentences or lines
of it, all normalised: lower case, single spaces. Lines that were wrapped anew
count where they are cut at ends of sentences or paragraphs. Each passage's
first sentence or line is hashed and joined to those of messages; from there
as many as the passage has are compared.

Passages of every level link. Inside its conversation a message links with the
latest earlier one that holds a passage of its lowest level that any holds; if
there is none, with the first message of any other conversation that does, by
conversation and turn, again of the lowest level first.

A message that links inside its conversation is a reply. Its thread is named
by the turn at the root of the chain of replies, so that
``order by conv_id, thread_turn, turn`` is a conversation in reply order: each
thread as it went on. Chains are followed by joins that double their reach.

Own text is what remains without quotations and without the line that
announces one ("... wrote:"). Null texts are empty. Messages without
conversation or turn are formatted but link with nothing. Repeated messages
are kept, a row each; they share their links. Empty passages link with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.session import pin

# No repeated groups: on long lines Java would match them by recursion until its stack is full.
_MARKS = r"(?s)^([ \t]{0,3}>[> \t]*)(.*)$"
_QUOTED = r"(?m)^[ \t]{0,3}>"
#: The line before a quotation that names its author.
_ANNOUNCED = r"(?i)(?:^|\n)[^\n]*\b(?:wrote|writes|said|schrieb|a écrit|escribió)[ \t]*:[ \t]*$"
#: Chains of replies double in reach each round.
ROUNDS = 40
_SENTENCE = r"(?<=[.!?])\s+"


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def formatted(role: Column, text: Column) -> Column:
    """A chat message between its marks; marks in the text itself are broken up."""
    def clean(value: Column) -> Column:
        return F.replace(F.coalesce(value, F.lit("")), F.lit("<|"), F.lit("< |"))

    return F.concat(F.lit("<|im_start|>"), clean(role), F.lit("\n"), clean(text), F.lit("<|im_end|>"))


def _lines(text: Column) -> Column:
    """Lines as (level, text), level 0 being a message's own."""
    return F.transform(F.split(text, r"\r\n|\r|\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", "")).alias("level"),
        F.when(line.rlike(_MARKS), F.regexp_extract(line, _MARKS, 2)).otherwise(line).alias("text"),
    ))


def parsed(messages: DataFrame) -> DataFrame:
    """``messages`` with ``own`` text and ``passages`` (level, text) of what they quote."""
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = messages.withColumn("_lines", F.when(text.rlike(_QUOTED), _lines(text)))
    # A passage ends where the level changes: its number counts the changes so far.
    starts = F.transform("_lines", lambda line, i: F.when(
        (i == 0) | (line["level"] != F.get(F.col("_lines"), i - 1)["level"]), i))
    marked = marked.withColumn("_cuts", F.array_compact(starts))
    passages = F.transform("_cuts", lambda start, k: F.struct(
        F.get(F.col("_lines"), start)["level"].alias("level"),
        F.array_join(F.transform(
            F.slice("_lines", start + 1, F.coalesce(F.get(F.col("_cuts"), k + 1), F.size("_lines")) - start),
            lambda line: line["text"]), "\n").alias("text"),
    ))
    marked = marked.withColumn("_passages", passages)
    last = F.size("_passages") - 1
    own = F.transform(
        F.filter(F.transform("_passages", lambda p, k: F.struct(p["level"].alias("level"), p["text"].alias("text"), (k < last).alias("leads"))),
                 lambda p: p["level"] == 0),
        lambda p: F.regexp_replace(
            F.when(p["leads"], F.regexp_replace(p["text"], _ANNOUNCED, "")).otherwise(p["text"]), r"^\s+|\s+$", ""),
    )
    joined = F.array_join(F.filter(own, lambda t: t != ""), "\n")
    return marked.withColumn("own", F.when(F.col("_lines").isNull(), text).otherwise(joined)).withColumn(
        "passages", F.coalesce(F.filter("_passages", lambda p: p["level"] > 0), F.array().cast("array<struct<level:int,text:string>>"))
    ).drop("_lines", "_cuts", "_passages")


def _held(own: Column) -> Column:
    """Normalised forms under which a message may be quoted."""
    parts = F.concat(F.array(own), F.split(own, r"\n[ \t]*\n"), F.split(own, r"\n"))
    return F.array_distinct(F.filter(F.transform(parts, normal), lambda t: t != ""))


def _units(text: Column) -> Column:
    """Normalised sentences of a text in order: once cut at line ends too, once of the text as one line."""
    by_line = F.filter(F.transform(F.split(text, rf"[\r\n]+|{_SENTENCE}"), normal), lambda t: t != "")
    running = F.filter(F.split(normal(text), _SENTENCE), lambda t: t != "")
    return F.array_distinct(F.array(by_line, running))


def _starts(text: Column) -> Column:
    """Hash of a passage's first unit and number of units, either way of cutting."""
    return F.transform(F.filter(_units(text), lambda u: F.size(u) > 0), lambda u: F.struct(
        F.xxhash64(F.get(u, F.lit(0))).alias("first"), F.size(u).alias("length")))


def _runs(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """Consecutive units of messages that begin and are as long as a passage in ``starts``: conv_id, turn, passage."""
    cut = messages.select("conv_id", "turn", _units(F.col("own")).alias("units"))
    each = cut.select("conv_id", "turn", F.posexplode("units").alias("way", "u"))
    each = each.select("conv_id", "turn", "way", F.posexplode(F.transform("u", lambda t: F.xxhash64(t))).alias("at", "first"))
    hits = each.join(starts, "first").groupBy("conv_id", "turn").agg(F.collect_set(F.struct("way", "at", "lengths")).alias("hits"))

    def texts(hit: Column) -> Column:
        units = F.get(F.col("units"), hit["way"])
        fitting = F.filter(hit["lengths"], lambda n: hit["at"] + n <= F.size(units))
        return F.transform(fitting, lambda n: F.array_join(F.slice(units, hit["at"] + 1, n), " "))

    found = F.array_distinct(F.flatten(F.transform("hits", texts)))
    return cut.join(hits, ["conv_id", "turn"]).select("conv_id", "turn", F.explode(found).alias("passage"))


def link_quotations(messages: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, text without quotations, n_quotes, reply_conv, reply_turn,
    thread_turn, depth and chat."""
    rows = messages.select(F.col(f"`{conversation}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
                           F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    every = pin(parsed(rows).drop("text"), "messages")
    quoting = every.filter((F.size("passages") > 0) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    quotes = quoting.select("conv_id", "turn", F.explode("passages").alias("p")).select(
        "conv_id", "turn", F.col("p.level").alias("level"), normal(F.col("p.text")).alias("passage"), _starts(F.col("p.text")).alias("starts"))
    quotes = quotes.filter("passage != ''").groupBy("conv_id", "turn", "passage").agg(
        F.min("level").alias("level"), F.array_distinct(F.flatten(F.collect_set("starts"))).alias("starts"))
    quotes = pin(quotes.withColumn("hash", F.xxhash64("passage")), "quoted-passages")
    starts = quotes.select(F.explode("starts").alias("s")).select("s.first", "s.length").distinct()
    starts = pin(starts.groupBy("first").agg(F.collect_list("length").alias("lengths")), "quoted-starts")
    quotes = quotes.drop("starts")
    # Only what is quoted somewhere is looked for in messages.
    wanted = quotes.select("hash").distinct()
    placed = every.filter("conv_id is not null and turn is not null")
    held = placed.select("conv_id", "turn", F.explode(_held(F.col("own"))).alias("passage")).unionByName(_runs(placed, starts))
    held = held.select("conv_id", "turn", F.xxhash64("passage").alias("hash"), "passage").join(wanted, "hash", "left_semi").distinct()
    held = pin(held, "quoted-originals")
    # The latest earlier holder of a passage in a conversation, by one pass over both in order of turns.
    both = held.withColumn("holder", F.col("turn")).withColumn("level", F.lit(None).cast("int")).withColumn("asks", F.lit(False)).unionByName(
        quotes.withColumn("holder", F.lit(None).cast("long")).withColumn("asks", F.lit(True))
    )
    earlier = Window.partitionBy("conv_id", "hash", "passage").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    inside = both.withColumn("from", F.max("holder").over(earlier)).filter("asks and from is not null")
    # Of the lowest level that links, the latest.
    inside = inside.groupBy("conv_id", "turn").agg(F.max(F.struct((-F.col("level")).alias("near"), F.col("from"))).alias("l"))
    inside = inside.select("conv_id", "turn", F.col("l.from").alias("reply_turn"), F.col("conv_id").alias("reply_conv"))
    # The first two conversations of a passage: one of them is another than the quoting one's.
    of_conv = held.groupBy("hash", "passage", "conv_id").agg(F.min("turn").alias("turn"))
    in_order = Window.partitionBy("hash", "passage").orderBy("conv_id")
    earliest = of_conv.withColumn("k", F.row_number().over(in_order)).filter("k <= 2").select(
        "hash", "passage", F.struct("conv_id", "turn").alias("o"))
    alone = quotes.join(inside.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti")
    outside = alone.join(earliest, ["hash", "passage"]).filter(F.col("o.conv_id") != F.col("conv_id"))
    outside = outside.groupBy("conv_id", "turn").agg(F.min(F.struct("level", "o")).alias("l")).select(
        "conv_id", "turn", F.col("l.o.turn").alias("reply_turn"), F.col("l.o.conv_id").alias("reply_conv")
    )
    links = pin(inside.select("conv_id", "turn", "reply_turn", "reply_conv").unionByName(outside), "replies")

    # Roots of chains inside a conversation: each round a message takes over what its goal has reached.
    chain = pin(links.filter("reply_conv = conv_id").select("conv_id", "turn", F.col("reply_turn").alias("thread_turn"), F.lit(1).cast("long").alias("depth")), "chains")
    for _ in range(ROUNDS):
        goal = chain.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("further"), F.col("depth").alias("more"))
        longer = chain.join(goal, ["conv_id", "thread_turn"], "left")
        moved = longer.agg(F.count("further").alias("n")).first().n
        if not moved:
            break
        chain = pin(longer.select("conv_id", "turn", F.coalesce("further", "thread_turn").alias("thread_turn"),
                                  (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "chains")
    else:
        raise RuntimeError(f"chains of replies go on after {ROUNDS} rounds")
    linked = every.join(links, ["conv_id", "turn"], "left").join(chain, ["conv_id", "turn"], "left")
    return linked.select(
        "conv_id", "turn", "role", F.col("own").alias("text"), F.size("passages").cast("long").alias("n_quotes"), "reply_conv", "reply_turn",
        F.coalesce("thread_turn", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        formatted(F.col("role"), F.col("own")).alias("chat"),
    )
