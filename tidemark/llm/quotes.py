"""Chat formatting by quotation linking.

Messages quote earlier ones with nested ``>`` marks.  Lines are parsed into quote
levels; passages of one level are normalised and hashed as a whole, by paragraph
and by line; hashes are joined to an index of what messages say in their own
words; what links decide is each message's parent, its thread's root and its depth
(by pointer jumping), and its text without quotes.  Ordering a thread by
conversation and turn puts every message after the one it replies to.

The index keeps one message per hash, the earliest, so a line that very many
messages share joins to one row, and no pairs arise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Lines that announce a quote, in the languages of the corpus.
ATTRIBUTION = r"(?i)(?:wrote|schrieb|a écrit|escribió|ha scritto)(?: [^:]{0,60})?\s?:\s*$"
_MARK = r"^(?:[ \t]{0,3}>)+"


def normal(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parse(messages: DataFrame) -> DataFrame:
    """Add ``own`` (text without quotes) and ``passages`` (level, text), in page order."""
    rows = messages.select("*", F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"\r?\n").alias("__l"))
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, _MARK, 0), "[^>]", ""))
    body = lambda x: F.regexp_replace(F.regexp_replace(x, _MARK, ""), r"^ |\s+$", "")
    rows = rows.select("*", F.transform("__l", lambda x: F.struct(level(x).alias("v"), body(x).alias("t"))).alias("__m")).drop("__l")
    after = lambda i: F.get(F.col("__m"), i + 1)["v"]
    tagged = F.transform("__m", lambda x, i: F.struct(x["v"].alias("v"), x["t"].alias("t"), (x["t"].rlike(ATTRIBUTION) & (F.coalesce(after(i), F.lit(0)) > x["v"])).alias("a"), i.alias("i")))
    rows = rows.select("*", F.filter(tagged, lambda x: ~x["a"]).alias("__n")).drop("__m")
    own = F.array_join(F.transform(F.filter("__n", lambda x: x["v"] == 0), lambda x: x["t"]), "\n")
    rows = rows.select("*", F.regexp_replace(F.regexp_replace(own, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "").alias("own"), F.filter("__n", lambda x: x["v"] > 0).alias("__q")).drop("__n")
    # a passage starts where the level changes or a line is left out in between
    start = lambda x, i: F.coalesce((F.get(F.col("__q"), i - 1)["v"] != x["v"]) | (F.get(F.col("__q"), i - 1)["i"] != x["i"] - 1), F.lit(True))
    # one string, so that a long quote grows by no copies; its marks are no text
    line = lambda x, i: F.concat(F.when(start(x, i), F.concat(F.lit("\x02"), x["v"].cast("string"), F.lit("\x03"))).otherwise(""), F.translate(x["t"], "\x02\x03", ""))
    parts = F.filter(F.split(F.array_join(F.transform("__q", line), "\n"), "\n?\x02"), lambda p: p != "")
    passage = lambda p: F.struct(F.substring_index(p, "\x03", 1).cast("int").alias("v"), F.substr(p, F.instr(p, F.lit("\x03")) + 1).alias("t"))
    return rows.select("*", F.transform(parts, passage).alias("passages")).drop("__q")


def _units(text: Column, least: int) -> Column:
    """Hashes of a text: whole, paragraphs, lines; only of ``least`` words or more."""
    parts = F.concat(F.array(text), F.split(text, r"\n\s*\n"), F.split(text, "\n"))
    said = F.filter(F.transform(parts, normal), lambda x: F.size(F.split(x, " ")) >= least)
    return F.array_distinct(F.transform(said, lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("n"))))


def link(messages: DataFrame, least: int = 3) -> DataFrame:
    """Reply structure of messages.

    ``messages`` has ``conv_id``, ``turn``, ``role`` and ``text``.  Returns
    ``conv_id``, ``turn``, ``role``, ``content`` (own words), ``n_quotes``, ``quoted``
    (level, conversation and turn of the message that every level quotes),
    ``reply_conv`` and ``reply_turn`` (that of the lowest level that links, null if none
    does), ``root_conv``, ``root_turn`` and ``depth``.

    A passage links to the earliest message that says its whole, a paragraph or a
    line of it in its own words, within the conversation if there is one, else
    anywhere; only to messages before (by conversation and turn).  Per level messages
    of the conversation come first, then most quoted characters, then the latest
    message.  Null texts are empty; messages with a null conversation or turn get no
    link and are roots of their own; rows that repeat a conversation and turn are
    linked alike; an empty table gives an empty one; other columns are ignored.
    """
    own = parse(messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")))
    own = cut(own.drop("text"), "quote-parsed")
    said = own.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.inline(_units(F.col("own"), least)))
    near = cut(said.groupBy("conv_id", "h").agg(F.min("turn").alias("turn")), "quote-index")
    wide = cut(near.groupBy("h").agg(F.min(F.struct("conv_id", "turn")).alias("m")), "quote-index-all")
    asked = own.where("size(passages) > 0 and conv_id is not null and turn is not null")
    asked = asked.select("conv_id", "turn", F.explode("passages").alias("p")).select("conv_id", "turn", F.col("p.v").alias("v"), F.inline(_units(F.col("p.t"), least))).distinct()
    inside = asked.join(near.withColumnRenamed("turn", "__t"), ["conv_id", "h"], "left")
    inside = inside.select("conv_id", "turn", "v", "h", "n", F.when(F.col("__t") < F.col("turn"), F.col("__t")).alias("t"))
    before = F.struct(F.col("m.conv_id"), F.col("m.turn")) < F.struct("conv_id", "turn")
    outside = inside.where("t is null").join(wide, "h").where(before & (F.col("m.conv_id") != F.col("conv_id")))
    votes = inside.where("t is not null").select("conv_id", "turn", "v", F.lit(1).alias("near"), "n", F.col("conv_id").alias("c"), "t").unionByName(outside.select("conv_id", "turn", "v", F.lit(0).alias("near"), "n", F.col("m.conv_id").alias("c"), F.col("m.turn").alias("t")))
    summed = votes.groupBy("conv_id", "turn", "v", "near", "c", "t").agg(F.sum("n").alias("n"))
    levels = summed.groupBy("conv_id", "turn", "v").agg(F.max(F.struct("near", "n", "c", "t")).alias("b"))
    parents = levels.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(F.struct(F.col("v").alias("level"), F.col("b.c").alias("conv"), F.col("b.t").alias("turn")))).alias("quoted"))
    lowest = F.get("quoted", F.lit(0))
    parents = cut(parents.select("conv_id", "turn", "quoted", lowest["conv"].alias("pc"), lowest["turn"].alias("pt")), "quote-parents")
    known = _roots(parents)
    known = known.join(parents.select("conv_id", "turn", "quoted"), ["conv_id", "turn"])
    known = known.select(F.col("conv_id").alias("__c"), F.col("turn").alias("__t"), "quoted", "pc", "pt", "rc", "rt", "depth")
    rows = own.join(known, (F.col("conv_id") == F.col("__c")) & (F.col("turn") == F.col("__t")), "left")
    return rows.select(
        "conv_id", "turn", "role", F.col("own").alias("content"), F.size("passages").alias("n_quotes"),
        F.coalesce("quoted", F.array().cast("array<struct<level:int,conv:bigint,turn:bigint>>")).alias("quoted"), F.col("pc").alias("reply_conv"), F.col("pt").alias("reply_turn"),
        F.coalesce("rc", "conv_id").alias("root_conv"), F.coalesce("rt", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
    )


def _roots(parents: DataFrame) -> DataFrame:
    """Root and depth of every message with a parent, in rounds that halve what is left; who has a root rests."""
    now = parents.select("conv_id", "turn", "pc", "pt", F.col("pc").alias("rc"), F.col("pt").alias("rt"), F.lit(1).cast("long").alias("depth"), F.lit(False).alias("done"))
    while not now.where("not done").isEmpty():
        up = now.select(F.col("conv_id").alias("__c"), F.col("turn").alias("__t"), F.col("rc").alias("__rc"), F.col("rt").alias("__rt"), F.col("depth").alias("__d"))
        step = now.where("not done").join(up, (F.col("rc") == F.col("__c")) & (F.col("rt") == F.col("__t")), "left")
        more = F.col("__c").isNotNull()
        step = step.select("conv_id", "turn", "pc", "pt", F.coalesce("__rc", "rc").alias("rc"), F.coalesce("__rt", "rt").alias("rt"), F.when(more, F.col("depth") + F.col("__d")).otherwise(F.col("depth")).alias("depth"), (~more).alias("done"))
        now = cut(step.unionByName(now.where("done")), "quote-roots")
    return now.drop("done")


def threads(linked: DataFrame) -> DataFrame:
    """``linked`` with ``place``, from 1: where a message stands in its thread, across conversations.

    Replies come after what they reply to, as they are later by conversation and turn;
    rows that repeat a conversation and turn share a place.  Messages with a null
    conversation or turn stand alone.  Places are counted per conversation and offset
    by the conversations before it, so a thread's messages don't meet in one task.
    """
    root, known = ["root_conv", "root_turn"], F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    rows = linked.where(known)
    sizes = cut(rows.groupBy(*root, "conv_id").agg(F.count("*").alias("__n")), "thread-sizes")
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*root).orderBy("conv_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cut(sizes.select(*root, "conv_id", before.alias("__before")), "thread-offsets")
    own = F.rank().over(Window.partitionBy(*root, "conv_id").orderBy("turn"))
    placed = rows.withColumn("__own", own).join(offsets, [*root, "conv_id"])
    placed = placed.select(*linked.columns, (F.col("__own") + F.col("__before")).cast("long").alias("place"))
    return placed.unionByName(linked.where(~known).withColumn("place", F.lit(1).cast("long")))


def chats(linked: DataFrame, chunk: int = 64) -> DataFrame:
    """Reply-ordered conversations: ``root_conv``, ``root_turn``, ``part`` and ``messages`` (place,
    conversation, turn, role, content), parents before replies, across conversations.

    A thread is as many parts of ``chunk`` places as it needs, so none is too large for a
    row.  Messages without a conversation or a turn are in no thread."""
    part = F.floor((F.col("place") - 1) / chunk)
    rows = threads(linked.where("conv_id is not null and turn is not null"))
    return rows.groupBy("root_conv", "root_turn", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("place", "conv_id", "turn", "role", "content"))).alias("messages"))
