"""Conversations in reply order, with quoted passages linked and taken out.

Only DataFrame functions run here. A line that begins with ``>`` marks is a
quote; the number of marks is its level. Lines are normalised (case, white
space, marks); lines of one level in a row form a passage, which ends at a blank
line. A passage, each of its lines and each WINDOW words of it in a row are
hashed and join by equality the nearest earlier message of the conversation that
has them as its own, so a quote that is cut or wrapped at another width links
too. Of the levels that link, the shallowest decides, since deeper ones quote
what the answered message quotes: a message replies to the earlier message that
holds most of the whole passages of that level, then most of its parts, then the
later of equals; without a link, to the last turn before it that the conversation
has, whatever its number. Messages are ordered
within a conversation by the turn they reply to and then by their own, so none
comes before the message it answers. Text is left without its quotes.

Parts move only for conversations with a quote, once a message; the nearest
owner is a running maximum over the messages that share a part, never a pairing
of them.

Defined cases: a null text is empty; a message of quotes alone has an empty
text; a line of marks alone is a quote with no content and links to nothing; a
quote of a later or of no message is taken out and links to nothing; the first
turn of a conversation, or one without a number, replies to nothing; repeated rows each stay, with the same reply; null
keys form conversations of their own by equality of nulls; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.llm.common import stage

WINDOW = 8
RUN = 1024  # numbers of turns whose predecessors are looked for together
_MARKS = r"^\s*>[>\s]*"
# A line with a quote mark. Each line is looked at once, however many are blank.
HAS_QUOTE = r"(?md)^[^\S\n]*+>"


def quote_level(line: Column) -> Column:
    """Number of leading ``>`` marks, white space between them aside."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), r"\s", ""))


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, _MARKS, "")), r"\s+", " "))


def _key() -> Column:
    """The message's text, as a key beside conversation and turn."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def passages(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, key, level, lines`` for every run of lines of one level."""
    lines = F.transform(
        F.split(F.coalesce("text", F.lit("")), r"\r?\n"),
        lambda x: F.struct(quote_level(x).alias("level"), normal_line(x).alias("line")),
    )
    rows = messages.select("conv_id", "turn", _key().alias("key"), lines.alias("all"))
    # Places where a passage begins and ends; as many of each, in order.
    edge = lambda i, j: (F.get("all", i)["line"] != "") & (
        F.get("all", j).isNull()
        | (F.get("all", j)["line"] == "")
        | (F.get("all", j)["level"] != F.get("all", i)["level"])
    )
    places = F.sequence(F.lit(0), F.size("all") - 1)
    begins = F.filter(places, lambda i: edge(i, i - 1))
    ends = F.filter(places, lambda i: edge(i, i + 1))
    rows = rows.withColumn("at", F.explode(F.arrays_zip(begins.alias("begin"), ends.alias("end"))))
    own = F.slice("all", F.col("at.begin") + 1, F.col("at.end") - F.col("at.begin") + 1)
    return rows.select(
        "conv_id", "turn", "key", F.get("all", F.col("at.begin"))["level"].alias("level"),
        F.transform(own, lambda x: x["line"]).alias("lines"),
    )


def _parts(rows: DataFrame) -> DataFrame:
    """The passage, its lines and windows as ``part``, with the lines it touches."""
    line_of = F.flatten(
        F.transform("lines", lambda x, i: F.transform(F.split(x, " "), lambda _: i))
    )
    rows = rows.withColumns({"words": F.split(F.array_join("lines", " "), " "), "line_of": line_of})
    part = lambda text, whole, lines: F.struct(
        text.alias("part"), F.lit(whole).alias("whole"), lines.alias("touched")
    )
    windows = F.when(
        F.size("words") > WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW),
            lambda i: part(
                F.array_join(F.slice("words", i + 1, WINDOW), " "),
                False,
                F.slice("lines", F.get("line_of", i) + 1, F.get("line_of", i + WINDOW - 1) - F.get("line_of", i) + 1),
            ),
        ),
    )
    each = F.transform("lines", lambda x: part(x, False, F.array(x)))
    first = F.array(part(F.array_join("words", " "), True, F.col("lines")))
    parts = F.concat(first, each, F.coalesce(windows, F.slice(each, 1, 0)))
    rows = rows.select("conv_id", "turn", "key", "level", F.explode(parts).alias("p"))
    return rows.select("conv_id", "turn", "key", "level", "p.*").withColumn("hash", F.xxhash64("part"))


def quote_links(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, key, reply_to, n_linked`` for messages whose quotes are found.

    ``n_linked`` counts the distinct quoted lines, of any level, with a linked part.
    """
    quoting = messages.filter(F.col("text").rlike(HAS_QUOTE)).select("conv_id").distinct()
    rows = _parts(passages(messages.join(quoting, "conv_id", "left_semi")))
    columns = ["conv_id", "turn", "key", "level", "hash", "part", "touched"]
    quoted = rows.filter("level > 0").groupBy(columns).agg(F.max("whole").alias("whole"))
    own = rows.filter("level = 0").select("conv_id", "hash", "part", "turn").distinct()
    earlier = Window.partitionBy("conv_id", "hash", "part").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    linked = (
        quoted.unionByName(own.withColumn("owner", F.col("turn")), allowMissingColumns=True)
        .withColumn("origin", F.max("owner").over(earlier))
        .filter("level > 0 and origin is not null")
    )
    counted = linked.groupBy("conv_id", "turn", "key", "level", "origin").agg(
        F.countDistinct(F.when(F.col("whole"), F.col("part"))).alias("n_whole"),
        F.countDistinct("part").alias("n"),
        F.array_distinct(F.flatten(F.collect_set("touched"))).alias("touched"),
    )
    best = F.max(F.struct((-F.col("level")).alias("shallow"), "n_whole", "n", "origin")).alias("best")
    of_level = F.transform("touched", lambda x: F.struct("level", x.alias("line")))
    return (
        counted.groupBy("conv_id", "turn", "key")
        .agg(best, F.size(F.array_distinct(F.flatten(F.collect_list(of_level)))).cast("long").alias("n_linked"))
        .select("conv_id", "turn", "key", F.col("best.origin").alias("reply_to"), "n_linked")
    )


def _number_before() -> Column:
    return F.when(F.col("turn") > 0, F.col("turn") - 1)


def gaps(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, previous`` of the turns that do not follow the number before them.

    A conversation is looked at in runs of RUN numbers and then run by run, so
    a conversation with a third of all turns is sorted by many tasks.
    """
    turns = messages.select("conv_id", "turn").dropna(subset=["turn"]).distinct()
    turns = turns.withColumn("run", F.expr(f"turn div {RUN}"))
    inside = F.lag("turn").over(Window.partitionBy("conv_id", "run").orderBy("turn"))
    runs = turns.groupBy(F.col("conv_id").alias("c"), F.col("run").alias("r")).agg(F.max("turn").alias("last"))
    runs = runs.withColumn("last", F.lag("last").over(Window.partitionBy("c").orderBy("r")))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r"))
    previous = F.coalesce("inside", "last").alias("previous")
    found = turns.withColumn("inside", inside).join(runs, same).select("conv_id", "turn", previous)
    return found.filter(~F.col("previous").eqNullSafe(_number_before()))


def reply_ordered(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, reply_to, max_level, n_quoted, n_linked``, in order."""
    messages = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    links = quote_links(messages)
    lines = F.split("text", r"\r?\n")
    own = F.filter(lines, lambda x: quote_level(x) == 0)
    levels = F.filter(F.transform(lines, quote_level), lambda n: n > 0)
    has_quote = F.col("text").rlike(HAS_QUOTE)
    plain = messages.filter(~has_quote).withColumns(
        {
            "linked": F.lit(None).cast("long"),
            "max_level": F.lit(0),
            "n_quoted": F.lit(0),
            "n_linked": F.lit(0).cast("long"),
        }
    )
    quoting = messages.filter(has_quote).withColumn("key", _key())
    quoting = quoting.join(links, ["conv_id", "turn", "key"], "left").select(
        "conv_id",
        "turn",
        "role",
        F.trim(F.array_join(own, "\n")).alias("text"),
        F.col("reply_to").alias("linked"),
        F.coalesce(F.array_max(levels), F.lit(0)).alias("max_level"),
        F.size(levels).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )
    # Written first, so that its size, most often none, decides how it is joined.
    late = stage(messages.sparkSession, "chat").cut(gaps(messages), "gaps")
    late = late.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.lit(True).alias("late"), "previous")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t"))
    before = F.when(F.col("late"), F.col("previous")).otherwise(_number_before())
    return (
        plain.unionByName(quoting)
        .join(late, same, "left")
        .select(
            "conv_id", "turn", "role", "text", F.coalesce("linked", before).alias("reply_to"),
            "max_level", "n_quoted", "n_linked",
        )
        .orderBy("conv_id", F.col("reply_to").asc_nulls_first(), "turn", "role", "text")
    )
