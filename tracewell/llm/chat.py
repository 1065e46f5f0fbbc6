"""Chat formatting by quotation linking: replies that quote are joined to what they quote.

Only DataFrame functions. Lines that begin with '>' marks are quoted, to the depth of their marks. Runs of lines of one depth are passages.
Passages and their single lines are normalised (lower case, runs of white space as one space) and hashed, and joined to the hashes of
whole messages and of their lines, written without quotes. A message replies to the one that holds most of the characters that it
quotes at depth 1, in its own conversation and before it if there is one, else the first message anywhere that has them.

Conversations are in reply order: a message that quotes nothing of its conversation begins a thread, threads come by their first turns,
and a reply comes after the message that it quotes and the replies to earlier siblings, depth first. A message carries its thread's first turn,
its depth and its position in the thread. They are found by doubling steps over parents: sizes of subtrees, then sums of offsets among siblings on
the way to the first turn. A conversation of any length needs no collected list or path, and siblings are summed in stretches of STRETCH
turns. The text is the message without quotes and attribution lines.

The index has all holders of what is quoted, as sets of quoted hashes: messages of a conversation that hold the same set are one entry with the
smallest turn, and for quotes from elsewhere the first two conversations of a set are enough. Quotes of the same lines are scored once.

Defined results: a null text is an empty message; a null role is 'user'; rows with a null conversation or turn stand alone. Of equal
matches the earliest counts. Repeated rows get the same result. Lines of under SHORT characters aren't looked up alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewell.llm.spark_util import cut

SHORT, STRETCH = 12, 1024
_MARKS = r"^(\s*(?:>[ \t]?)+)"
_WROTE = r"(?i)^.{0,200}\b(?:wrote|schrieb|a écrit|escribió)\s*:\s*$"


def _normal(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content, lines, own): lines with their depths, and the text without quotes."""
    given = messages.select("conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    line = lambda x: F.struct(F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 1), "[^>]", "")).alias("depth"), F.regexp_replace(x, _MARKS, "").alias("t"))
    quoting = F.col("text").rlike(r"(?m)^\s*>")
    given = given.withColumn("lines", F.when(quoting, F.transform(F.split("text", "\n"), line)))
    kept = F.filter("lines", lambda x: (x["depth"] == 0) & ~x["t"].rlike(_WROTE))
    own = F.when(quoting, F.array_join(F.transform(kept, lambda x: x["t"]), "\n")).otherwise(F.col("text"))
    return given.select("conv_id", "turn", "role", F.xxhash64("text").alias("content"), "lines", F.regexp_replace(own, r"^\s+|\s+$", "").alias("own"))


def links(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, content, depth, to_conv, to_turn, chars): for each message and depth of quoting, the message quoted."""
    me = ["conv_id", "turn", "content"]
    quoted = rows.where("lines IS NOT NULL").select(*me, F.posexplode("lines").alias("i", "x")).select(*me, "i", "x.depth", "x.t").where("depth > 0")
    order = W.partitionBy(*me, "depth").orderBy("i")
    quoted = quoted.withColumn("run", F.col("i") - F.row_number().over(order))
    runs = quoted.groupBy(*me, "depth", "run").agg(F.sort_array(F.collect_set(F.struct("i", "t"))).alias("ts"))
    whole = runs.select(*me, "depth", _normal(F.array_join(F.transform("ts", lambda x: x["t"]), "\n")).alias("q")).where("q <> ''")
    single = quoted.select(*me, "depth", _normal(F.col("t")).alias("q")).where(F.length("q") >= SHORT)
    wanted = whole.unionByName(single).where("conv_id IS NOT NULL AND turn IS NOT NULL").distinct().select(*me, "depth", F.xxhash64("q").alias("key"), F.length("q").alias("n"))

    wanted = cut(wanted)

    # All holders of quoted keys, as the sets of these keys: messages that hold the same set score the same for every quote.
    line_keys = F.filter(F.transform(F.split("own", "\n"), _normal), lambda x: F.length(x) >= SHORT)
    keys = F.array_distinct(F.concat(F.filter(F.array(_normal(F.col("own"))), lambda x: x != ""), line_keys))
    index = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.explode(F.transform(keys, lambda x: F.xxhash64(x))).alias("key"))
    held = index.join(wanted.select("key").distinct(), "key", "left_semi").groupBy("conv_id", "turn").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    held = held.groupBy(F.xxhash64("keys").alias("held"), F.col("conv_id").alias("to_conv")).agg(F.min("turn").alias("to_turn"), F.first("keys").alias("keys"))
    held = cut(held)

    near = wanted.join(held.select(F.col("to_conv").alias("conv_id"), "held", "to_turn", F.explode("keys").alias("key")), ["conv_id", "key"]).where("to_turn < turn")
    near = near.groupBy(*me, "depth", "held", "to_turn").agg(F.sum("n").alias("chars")).select(*me, "depth", F.lit(False).alias("far"), "chars", F.col("conv_id").alias("to_conv"), "to_turn")

    # Elsewhere, for each set of quoted keys: the best place, and the best in another conversation for those who quote from the first one.
    first_two = lambda df, key, *by: df.withColumn("_k", F.row_number().over(W.partitionBy(key).orderBy(*by))).where("_k <= 2").drop("_k")
    sets = wanted.groupBy(*me, "depth").agg(F.sort_array(F.collect_set(F.struct("key", "n"))).alias("q")).withColumn("asked", F.xxhash64("q"))
    asked = sets.groupBy("asked").agg(F.first("q").alias("q")).select("asked", F.explode("q").alias("q")).select("asked", "q.key", "q.n")
    places = first_two(held, "held", "to_conv").select("held", "to_conv", "to_turn", F.explode("keys").alias("key"))
    scored = asked.join(places, "key").groupBy("asked", "held", "to_conv", "to_turn").agg(F.sum("n").alias("chars"))
    scored = scored.groupBy("asked", "to_conv").agg(F.min(F.struct((-F.col("chars")).alias("minus"), "to_turn")).alias("b")).select("asked", "to_conv", "b.minus", "b.to_turn")
    far = sets.drop("q").join(first_two(scored, "asked", "minus", "to_conv"), "asked").where("to_conv <> conv_id")
    far = far.select(*me, "depth", F.lit(True).alias("far"), (-F.col("minus")).alias("chars"), "to_conv", "to_turn")

    best = near.unionByName(far).groupBy(*me, "depth").agg(F.min(F.struct("far", (-F.col("chars")).alias("minus"), "to_conv", "to_turn")).alias("b"))
    return best.select(*me, "depth", "b.to_conv", "b.to_turn", (-F.col("b.minus")).alias("chars"))


def _offsets(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, top, place) of replies(conv_id, turn, top): a reply's place after its parent, behind the subtrees of earlier siblings."""
    heads = replies.select("conv_id", F.col("top").alias("turn")).distinct().join(replies, ["conv_id", "turn"], "left_anti").withColumn("top", F.lit(None).cast("long"))
    sizes = cut(replies.select("conv_id", "turn", F.col("top").cast("long").alias("top")).unionByName(heads.select("conv_id", "turn", "top")).select("*", F.col("top").alias("jump"), F.lit(1).cast("long").alias("size")))
    while sizes.where("jump IS NOT NULL").limit(1).count():
        below = sizes.where("jump IS NOT NULL").groupBy("conv_id", F.col("jump").alias("turn")).agg(F.sum("size").alias("more"))
        next_ = sizes.select("conv_id", F.col("turn").alias("jump"), F.col("jump").alias("next"))
        grown = sizes.join(below, ["conv_id", "turn"], "left").join(next_, ["conv_id", "jump"], "left")
        sizes = cut(grown.select("conv_id", "turn", "top", F.col("next").alias("jump"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))

    # Sums over earlier siblings in two steps, over stretches of turns and in them: one message may have a large part of all replies.
    replies = sizes.where("top IS NOT NULL").withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    before = lambda *by: W.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(W.unboundedPreceding, -1)
    whole = replies.groupBy("conv_id", "top", "stretch").agg(F.sum("size").alias("size"))
    whole = whole.select("conv_id", "top", "stretch", F.coalesce(F.sum("size").over(before("conv_id", "top", "stretch")), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("size").over(before("conv_id", "top", "stretch", "turn")), F.lit(0))
    return replies.withColumn("inside", inside).join(whole, ["conv_id", "top", "stretch"]).select("conv_id", "turn", "top", (F.col("base") + F.col("inside") + 1).alias("place"))


def format_messages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, quoted_depth, parent_conv, parent_turn, thread_turn, depth, position, chat) of each row of messages.

    Ordering by conv_id, thread_turn and position gives conversations in reply order.
    """
    rows = cut(parsed(messages))
    found = cut(links(rows))
    me = ["conv_id", "turn", "content"]
    parents = found.where("depth = 1").select(*me, F.col("to_conv").alias("parent_conv"), F.col("to_turn").alias("parent_turn"))

    # Steps over parents within a conversation, doubled in each round; turns that reply to nothing begin threads.
    step = parents.where("conv_id = parent_conv").groupBy("conv_id", "turn").agg(F.min("parent_turn").alias("top"))
    step = cut(_offsets(step).select("conv_id", "turn", "top", "place", F.lit(1).alias("depth"), F.lit(False).alias("done")))
    while step.where("NOT done").limit(1).count():
        above = step.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("next"), F.col("depth").alias("more"), F.col("place").alias("further"), F.col("done").alias("last"))
        live = step.where("NOT done").join(above, ["conv_id", "top"], "left")
        live = live.select("conv_id", "turn", F.coalesce("next", "top").alias("top"), (F.col("place") + F.coalesce("further", F.lit(0))).alias("place"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("last", F.lit(True)).alias("done"))
        step = cut(step.where("done").unionByName(live))

    out = rows.join(parents, me, "left").join(step.select("conv_id", "turn", "top", "place", "depth"), ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", F.col("own").alias("text"), F.coalesce(F.array_max(F.transform("lines", lambda x: x["depth"])), F.lit(0)).alias("quoted_depth"), "parent_conv", "parent_turn",
        F.coalesce("top", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("place", F.lit(0)).alias("position"), F.concat(F.lit("<|"), "role", F.lit("|>\n"), "own", F.lit("\n<|end|>\n")).alias("chat"),
    )


def conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, n_messages, chat): each conversation as one text in reply order, for conversations that fit into a task."""
    rows = format_messages(messages).where("conv_id IS NOT NULL")
    return rows.groupBy("conv_id").agg(F.count("*").alias("n_messages"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("thread_turn", "position", "turn", "chat"))), lambda x: x["chat"]), "").alias("chat"))
