"""Chat formatting by quotation linking, with SQL functions only.

Quoted lines are told by their ``>`` marks, whose number is the level.  Runs of
quoted lines and their single lines are normalised and hashed, and joined with
the lines, paragraphs and whole texts of earlier messages of the conversation.
A message answers the message that its first-level quotes come from, else the
one before it.  The result has each message without quotes, with its place in
the reply order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import spill

#: Quote marks at the start of a line.
MARKS = r"^[ \t]*((?:>[ \t]?)+)"
#: A line that announces a quote.
ANNOUNCES = r"(?i)^[ \t]*(on .+ wrote|am .+ schrieb .*|le .+ a écrit|el .+ escribió)[ \t]*:[ \t]*$"
#: Turns of a conversation that are ordered together; beyond, totals are carried from chunk to chunk.
CHUNK = 1024


def level(line: Column) -> Column:
    """Number of quote marks before a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def normal(text: Column) -> Column:
    """Letters, digits and characters beyond ASCII, in lower case, with single blanks between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def own_text(text: Column) -> Column:
    """A text without quoted lines and the lines that announce them."""
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda x, i: (level(x) == 0) & ~(
        x.rlike(ANNOUNCES) & (level(F.coalesce(F.get(lines, i + 1), F.lit(""))) > 0)))
    return F.regexp_replace(F.array_join(kept, "\n"), r"^\s+|\s+$", "")


def _carried(rows: DataFrame, value: str, how, name: str) -> DataFrame:
    """Add the maximum (of a value that grows with the turn) or the sum of ``value`` over all earlier rows of the conversation.

    Rows of a chunk are ordered together; what earlier chunks hold is one number each.
    """
    inside = Window.partitionBy("conv", "chunk").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    total = rows.groupBy("conv", "chunk").agg(how(value).alias("_v"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    total = total.withColumn("_before", how("_v").over(before)).select("conv", "chunk", "_before")
    out = rows.withColumn(name, how(value).over(inside)).join(spill(total, "chunks"), ["conv", "chunk"])
    both = F.coalesce(name, F.lit(0)) + F.coalesce("_before", F.lit(0)) if how is F.sum else F.coalesce(name, "_before")
    return out.withColumn(name, both).drop("_before")


def _units(lines: DataFrame) -> DataFrame:
    """Hashes of what a message quotes: each quoted line and each run of quoted lines of one level."""
    by = Window.partitionBy("conv", "turn").orderBy("pos")
    runs = lines.withColumn("new", (F.col("level") != F.lag("level", 1, -1).over(by)).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0))).filter("level > 0")
    whole = runs.groupBy("conv", "turn", "run").agg(
        F.first("level").alias("level"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "content"))),
                                                                  lambda x: x["content"]), " ").alias("content"))
    both = runs.select("conv", "turn", "level", "content").union(whole.select("conv", "turn", "level", "content"))
    both = both.withColumn("content", normal(F.col("content"))).filter("content <> ''")
    return both.select("conv", "turn", "level", F.sha2("content", 256).alias("hash"),
                       F.size(F.split("content", " ")).alias("words")).distinct()


def _links(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, source, words): the latest earlier message that each quoted passage comes from."""
    quoting = messages.filter(F.col("text").rlike("(?m)" + MARKS))
    lines = quoting.select("conv", "turn", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.select("conv", "turn", "pos", level(F.col("line")).alias("level"), F.regexp_replace("line", MARKS, "").alias("content"))
    wanted = spill(_units(lines), "quotes")
    own = messages.select("conv", "turn", F.explode(F.array_distinct(F.transform(F.concat(
        F.split("own", "\n", -1), F.split("own", r"\n[ \t]*\n", -1), F.array("own")), normal))).alias("content"))
    own = own.filter("content <> ''").select("conv", "turn", F.sha2("content", 256).alias("hash"))
    # only conversations that quote matter
    own = own.join(wanted.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi")
    marks = own.select("conv", "hash", "turn", F.col("turn").alias("source")).distinct().unionByName(
        wanted.select("conv", "hash", "turn").distinct(), allowMissingColumns=True)
    marks = marks.groupBy("conv", "hash", "turn").agg(F.max("source").alias("source"))
    marks = marks.withColumn("passage", F.struct("conv", "hash")).withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    seen = _carried(marks.drop("conv", "hash").withColumnRenamed("passage", "conv"), "source", F.max, "latest")
    seen = seen.select("conv.conv", "conv.hash", "turn", F.col("latest").alias("from")).filter("from IS NOT NULL")
    return wanted.join(seen, ["conv", "hash", "turn"]).select("conv", "turn", "level", F.col("from").alias("source"), "words")


def _branch_depths(heads: DataFrame) -> DataFrame:
    """Depth of the first message of every branch, from (conv, branch, up, steps), by pointer doubling."""
    now = spill(heads, "branches")
    while now.filter("up IS NOT NULL").limit(1).count():
        above = now.select("conv", F.col("branch").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        now = spill(now.join(above, ["conv", "up"], "left").select(
            "conv", "branch", F.col("next").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "branches")
    return now.select("conv", "branch", F.col("steps").alias("base"))


def reply_order(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each message: conv_id, turn, role, text, reply_to, quoted_turns, branch, depth.

    ``text`` is the message without quotes.  ``reply_to`` is the turn it answers:
    that from which most words of its first-level quotes come (of equal ones the
    latest), else the turn before it, null for the first.  ``quoted_turns`` are the
    turns that its quotes of any level come from.  A message that answers another
    than the one before it begins a branch, named by its turn; ``depth`` is the
    number of messages above it.  The conversation of a branch, in reply order,
    is what stands above its first message, then its rows by depth.

    Passages are looked for in the own text of earlier messages as a line, a
    paragraph or a whole text, without regard to case, marks and blanks; of
    several places the latest counts.  A quote found nowhere links nothing; its
    lines are removed all the same.  A null text is empty.  Rows that share
    conversation and turn are one message: the smallest role and text.  Rows
    without conversation or turn come with null in the last four columns.  No
    conversation has to fit in a task: turns are ordered in chunks of ``CHUNK``.
    """
    rows = df.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), F.col(f"`{role}`").alias("role"),
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    apart = rows.filter("conv IS NULL OR turn IS NULL").select(
        "conv", "turn", "role", own_text(F.col("text")).alias("text"), F.lit(None).cast("long").alias("reply_to"),
        F.lit(None).cast("array<long>").alias("quoted_turns"), F.lit(None).cast("long").alias("branch"), F.lit(None).cast("long").alias("depth"))
    messages = rows.dropna(subset=["conv", "turn"]).groupBy("conv", "turn").agg(F.min(F.struct("role", "text")).alias("m"))
    messages = spill(messages.select("conv", "turn", "m.*").withColumn("own", own_text(F.col("text"))), "messages")

    links = spill(_links(messages), "quote-links")
    first = links.filter("level = 1").groupBy("conv", "turn", "source").agg(F.sum("words").alias("words"))
    first = first.groupBy("conv", "turn").agg(F.max(F.struct("words", "source")).alias("best")).select(
        "conv", "turn", F.col("best.source").alias("answered"))
    quoted = links.groupBy("conv", "turn").agg(F.array_sort(F.collect_set("source")).alias("quoted_turns"))

    line = messages.select("conv", "turn").withColumn("chunk", F.floor(F.col("turn") / CHUNK)).withColumn("one", F.lit(1).cast("long"))
    line = _carried(line.withColumn("at", F.col("turn")), "at", F.max, "previous")
    line = _carried(line, "one", F.sum, "place")
    line = line.join(first, ["conv", "turn"], "left").withColumn("reply_to", F.coalesce("answered", "previous"))
    opens = F.col("reply_to").isNull() | (F.col("reply_to") != F.col("previous"))
    line = line.withColumn("head", F.when(opens, F.col("turn")))
    line = _carried(line, "head", F.max, "branch").withColumn("branch", F.coalesce("head", "branch"))
    line = spill(line.select("conv", "turn", "reply_to", "head", "branch", "place"), "order")

    place = line.select("conv", F.col("turn").alias("reply_to"), F.col("branch").alias("up"), F.col("place").alias("above"))
    start = line.filter("head IS NOT NULL").select("conv", "branch", "reply_to", F.col("place").alias("start"))
    start = spill(start, "heads")
    heads = start.join(place, ["conv", "reply_to"], "left").join(
        start.select("conv", F.col("branch").alias("up"), F.col("start").alias("up_start")), ["conv", "up"], "left")
    heads = heads.select("conv", "branch", "up", F.when(F.col("up").isNull(), F.lit(0)).otherwise(
        F.col("above") - F.col("up_start") + 1).cast("long").alias("steps"))
    depth = _branch_depths(heads).join(start.select("conv", "branch", "start"), ["conv", "branch"])
    out = messages.join(line, ["conv", "turn"]).join(spill(depth, "depths"), ["conv", "branch"]).join(quoted, ["conv", "turn"], "left").select(
        "conv", "turn", "role", F.col("own").alias("text"), "reply_to", F.coalesce("quoted_turns", F.array().cast("array<long>")).alias("quoted_turns"),
        "branch", (F.col("base") + F.col("place") - F.col("start")).cast("long").alias("depth"))
    return out.unionByName(apart).withColumnRenamed("conv", "conv_id")
