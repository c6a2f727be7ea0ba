"""Chat formatting by quotation linking: quoted passages lead to the message that they are from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import write_once
from lexmill.operators.scale import with_order_index

#: The marks of quotation at the start of a line.
MARKS = r"^[ \t]*((?:>[ \t]*)+)"
#: How a quoted passage says that it breaks off.
ELLIPSIS = r"(?: ?(?:\.\.\.|…|\[\.\.\.\]|\[…\]))+$"
#: Words of the sequences by which passages that break off are searched for; a passage must have one more.
GRAM = 3


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def _normal(text: Column) -> Column:
    """Lower case, runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _lines(messages: DataFrame) -> DataFrame:
    """(message, conv, turn, at, level, line): one row per line, without its marks."""
    rows = messages.select("message", "conv", "turn", F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    return rows.select("message", "conv", "turn", "at", _level(F.col("raw")).alias("level"), F.regexp_replace("raw", MARKS, "").alias("line"))


def _quoted(lines: DataFrame) -> DataFrame:
    """(message, conv, turn, k, level, hash, lines) of each quoted passage: neighbouring lines of one level.

    A line's passage starts at the last line before it of another level; levels of a message are compared within
    its own lines, which the message bounds.
    """
    per = lines.groupBy("message", "conv", "turn").agg(F.sort_array(F.collect_list(F.struct("at", "level", "line"))).alias("rows"))
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(F.col("rows"), i - 1)["level"])
    starts = F.filter(F.transform("rows", lambda r, i: F.when(r["level"] != before(i), i)), lambda i: i.isNotNull())
    per = per.withColumn("starts", starts).select("*", F.posexplode("starts").alias("k", "start"))
    end = F.coalesce(F.get("starts", F.col("k") + 1), F.size("rows"))
    own = F.slice("rows", F.col("start") + 1, end - F.col("start"))
    own = F.transform(own, lambda r: r["line"])
    runs = per.select("message", "conv", "turn", "k", F.get("rows", "start")["level"].alias("level"), _normal(F.array_join(own, " ")).alias("passage"), F.array_join(own, "\n").alias("lines"))
    return runs.where((F.col("level") > 0) & (F.col("passage") != "")).select("message", "conv", "turn", "k", "level", F.md5("passage").alias("hash"), "lines")


def _parts(messages: DataFrame) -> DataFrame:
    """(conv, hash, turn) of each message's own text, paragraphs and lines."""
    own = F.col("content")
    parts = F.array_distinct(F.flatten(F.array(F.array(own), F.split(own, r"\n[ \t]*\n"), F.split(own, "\n"))))
    rows = messages.select("conv", "turn", F.explode(parts).alias("part")).select("conv", "turn", _normal(F.col("part")).alias("part"))
    return rows.where(F.col("part") != "").select("conv", F.md5("part").alias("hash"), "turn")


def _originals(messages: DataFrame) -> DataFrame:
    """(conv, hash, original): the first turn of a conversation whose own words hold a passage.

    A passage is a message's own text, a paragraph or a line of it. The minimum is combined before the shuffle, so a
    line that many messages share costs one row per task.
    """
    return _parts(messages).groupBy("conv", "hash").agg(F.min("turn").alias("original"))


def _partly(passages: DataFrame, messages: DataFrame) -> DataFrame:
    """(message, k, partly): for passages without an original, the earlier turn that holds most of their lines, by length.

    A turn holds a line if the line, or its paragraph of the passage, is the turn's own text, a paragraph or a line of it. It must hold
    more than half; of several the one that holds most, then the first.
    """
    paragraphs = passages.select("message", "conv", "turn", "k", F.posexplode(F.split("lines", r"\n[ \t]*\n")).alias("p", "paragraph"))
    lines = paragraphs.select("message", "conv", "turn", "k", "p", F.md5(_normal(F.col("paragraph"))).alias("whole"), F.posexplode(F.split("paragraph", "\n")).alias("at", "line"))
    lines = lines.withColumn("line", _normal(F.col("line"))).where(F.col("line") != "")
    lines = write_once(lines.select("message", "conv", "turn", "k", "p", "at", "whole", F.md5("line").alias("hash"), F.length("line").alias("size")), "quoted-lines")
    sizes = lines.groupBy("message", "k").agg(F.sum("size").alias("total"))
    asked = lines.select("message", "conv", "turn", "k", "p", "at", "size", F.explode(F.array_distinct(F.array("hash", "whole"))).alias("hash"))
    held = asked.join(_parts(messages).withColumnRenamed("turn", "original").distinct(), ["conv", "hash"]).where(F.col("original") < F.col("turn"))
    held = held.select("message", "k", "p", "at", "size", "original").distinct().groupBy("message", "k", "original").agg(F.sum("size").alias("held"))
    most = held.join(sizes, ["message", "k"]).where(2 * F.col("held") > F.col("total"))
    return most.groupBy("message", "k").agg(F.min(F.struct((-F.col("held")).alias("h"), "original")).alias("b")).select("message", "k", F.col("b.original").alias("partly"))


def _grams(words: Column, less: int = 0) -> Column:
    """Hashes of the sequences of ``GRAM`` words in the list, but for its last ``less`` words."""

    def hashes(w: Column) -> Column:
        last = F.size(w) - less - GRAM
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(GRAM)])))

    # The one-element array binds the words to a variable, so that a text is split once.
    return F.get(F.transform(F.array(words), hashes), 0)


def _broken_off(passages: DataFrame, messages: DataFrame) -> DataFrame:
    """(conv, lines, broken): for passages without an original, the first turn whose own words run through them.

    The passage stands within the turn's normalised words, from the start of a word on; its last word may break off, and
    marks of omission at its end do not count. Equal passages and equal texts of a conversation are one. A passage is looked up by its rarest
    sequence of words in its conversation, and what holds that is compared as a whole.
    """
    text = F.regexp_replace(_normal(F.col("lines")), ELLIPSIS, "")
    asked = passages.select("conv", "lines", text.alias("passage")).distinct().withColumn("words", F.split("passage", " "))
    asked = asked.where(F.size("words") > GRAM)
    sought = asked.select("conv", "passage", F.explode(_grams(F.col("words"), 1)).alias("gram")).distinct()
    sought = write_once(sought, "sought")
    told = messages.select("conv", "turn", _normal(F.col("content")).alias("told")).groupBy("conv", "told").agg(F.min("turn").alias("original"))
    told = write_once(told.withColumn("text", F.xxhash64("conv", "told")), "told")
    held = told.select("conv", "text", F.explode(_grams(F.split("told", " "))).alias("gram"))
    held = write_once(held.join(sought.select("conv", "gram").distinct(), ["conv", "gram"], "left_semi"), "held")
    counts = held.groupBy("conv", "gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = sought.join(counts, ["conv", "gram"], "left").groupBy("conv", "passage").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r"))
    rarest = rarest.where(F.col("r.n") > 0).select("conv", "passage", F.col("r.gram").alias("gram"))
    within = F.contains(F.concat(F.lit(" "), F.col("told")), F.concat(F.lit(" "), F.col("passage")))
    near = rarest.join(held, ["conv", "gram"]).join(told, ["conv", "text"]).where(within)
    first = near.groupBy("conv", "passage").agg(F.min("original").alias("broken"))
    return asked.join(first, ["conv", "passage"]).select("conv", "lines", "broken")


def _roots(parents: DataFrame) -> DataFrame:
    """(conv, turn, thread, depth): follow replies to a message that is none, by doubling the steps."""
    steps = write_once(parents.select("conv", "turn", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")), "steps")
    while True:
        further = steps.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("_next"), F.col("depth").alias("_more"))
        joined = steps.join(further, ["conv", "thread"], "left")
        moved = F.col("_next").isNotNull()
        steps = joined.select("conv", "turn", F.coalesce("_next", "thread").alias("thread"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"), moved.alias("_moved"))
        steps = write_once(steps, "steps")
        if steps.where("_moved").isEmpty():
            return steps.drop("_moved")
        steps = steps.drop("_moved")


def link_quotes(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content, n_quotes, n_linked, reply_to, thread, depth, position) for each message.

    ``conversations`` has conv_id, turn, role and text. Lines that start with ``>`` are quoted, as deep as they have such
    marks; content is the text without them, and without white space at its ends. Neighbouring lines of one level are a passage; it is linked to the first
    message of the conversation whose own text, paragraph or line is the same but for case and white space, if that is an
    earlier turn. A passage without such an original is linked to the earlier turn that holds most of its lines, singly or as
    paragraphs, if these are more than half of it, else (from four words on) to the first message whose words run through it, if that is an
    earlier turn: so lines may be wrapped anew, and a passage may start and break off anywhere. A message replies to the original of its shallowest linked passage, the latest of several. thread is the turn
    that the replies lead back to, depth the number of replies, position the message's place (from 0) in its conversation by
    thread, then turn, so an original comes before its replies.

    Null text is empty. Messages with a null conv_id are one conversation; null turns come first and have no links. Messages
    that repeat a turn share their links, and stand in the order of role and text. Only built-in functions are used, and no conversation
    is gathered in a row or a task.
    """
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    text = F.coalesce(F.regexp_replace("text", "\r\n?", "\n"), F.lit(""))
    rows = conversations.select("conv_id", conv.alias("conv"), F.col("turn").cast("bigint").alias("turn"), "role", text.alias("text"))
    kept = F.filter(F.split("text", "\n"), lambda line: _level(line) == 0)
    has = F.col("text").rlike(r"(?m)" + MARKS)
    content = F.when(has, F.regexp_replace(F.array_join(kept, "\n"), r"^\s+|\s+$", "")).otherwise(F.col("text"))
    key = F.xxhash64("conv", "turn", "role", "text")
    rows = write_once(rows.withColumns({"quotes": has, "content": content, "message": key}), "messages")
    asking = rows.where(F.col("quotes") & F.col("turn").isNotNull()).select("message", "conv", "turn", "text").distinct()
    passages, told = write_once(_quoted(_lines(asking)), "passages"), rows.where(F.col("turn").isNotNull())
    found = passages.join(_originals(told), ["conv", "hash"], "left")
    linked = F.when(F.col("original") < F.col("turn"), F.col("original"))
    found = write_once(found.withColumn("original", linked), "found")
    rest = found.where(F.col("original").isNull())
    if not rest.isEmpty():
        found = found.join(_partly(rest, told), ["message", "k"], "left").withColumn("original", F.coalesce("original", "partly"))
        found = write_once(found.drop("partly"), "found")
        broken = _broken_off(found.where(F.col("original").isNull()), told)
        earlier = F.when(F.col("broken") < F.col("turn"), F.col("broken"))
        found = found.join(broken, ["conv", "lines"], "left").withColumn("original", F.coalesce("original", earlier))
    best = F.min(F.when(F.col("original").isNotNull(), F.struct("level", (-F.col("original")).alias("back"), "original")))
    counts = found.groupBy("message").agg(F.count(F.lit(1)).alias("n_quotes"), F.count("original").alias("n_linked"), best["original"].alias("reply_to"))
    counts = write_once(counts, "replies")
    rows = rows.drop("text", "quotes").join(counts, "message", "left")
    rows = write_once(rows, "linked")
    parents = rows.where(F.col("reply_to").isNotNull()).groupBy("conv", "turn").agg(F.max("reply_to").alias("reply_to"))
    rows = rows.join(_roots(parents), ["conv", "turn"], "left")
    rows = rows.withColumns({"thread": F.coalesce("thread", "turn"), "depth": F.coalesce("depth", F.lit(0))})
    order = [F.col("thread"), F.col("turn"), F.col("role"), F.col("content"), F.col("message")]
    placed = with_order_index(rows, "position", order, ["conv"])
    whole = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_quotes", "n_linked")]
    return placed.select("conv_id", "turn", "role", "content", *whole, "reply_to", "thread", F.col("depth").cast("bigint").alias("depth"), F.col("position").cast("bigint").alias("position"))
