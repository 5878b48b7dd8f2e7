"""Conversations from messages that quote one another, with DataFrame functions only.

A message's lines carry quote levels (``>``, ``> >``, …). Runs of lines of one level are passages.
A quoted passage is linked to the latest earlier message of its conversation that holds an equal
passage of its own, by the hash of the normalised text. Where no message says the whole passage by
itself, paragraphs and lines are compared too, and the longest one that is found links it. The
first linked passage of level 1 names the message that is replied to. Replies, without their
quotes, then stand in reply order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.tables import pick
from marginalia.scratch import Scratch

QUOTE = r"^[ \t]{0,3}((?:>[ \t]?)+)"
TURNS_PER_BLOCK = 4096

# Conversations as mail: from the second turn on each message quotes the turn before it (each
# third turn the one before that), which quotes its own predecessor one level deeper, and
# answers below. Some quotes are spaced unlike the original.
MAIL_SQL = """
SELECT conv_id, turn, role,
  CASE WHEN deep IS NOT NULL AND turn % 2 = 0 THEN '> > ' || replace(deep, chr(10), chr(10) || '> > ') || chr(10) ELSE '' END
  || CASE WHEN near IS NOT NULL THEN '> ' || replace(CASE WHEN turn % 5 = 4 THEN replace(near, ' ', '  ') ELSE near END, chr(10), chr(10) || '>  ') || chr(10) || chr(10) ELSE '' END
  || coalesce(text, '') AS text
FROM (
  SELECT conv_id, turn, role, text,
    CASE WHEN turn % 3 = 2 THEN before_2 ELSE before_1 END AS near,
    CASE WHEN turn % 3 = 2 THEN before_3 ELSE before_2 END AS deep
  FROM (
    SELECT conv_id, turn, role, text,
      lag(text, 1) OVER w AS before_1, lag(text, 2) OVER w AS before_2, lag(text, 3) OVER w AS before_3
    FROM {conversations}
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
  ) a
) b
"""


def normalised(text: Column) -> Column:
    """Lower case, with every run of white space one blank and none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\r\n\f\x0B]+", " "))


def passages(text: Column) -> Column:
    """``array<struct<level, text, spaced>>``: maximal runs of lines of one quote level, level 0 included.

    Lines without any text part no passages and belong to the one before. In ``spaced`` an empty
    line stands wherever they part paragraphs.
    """
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 1), r"[ \t]", "")).alias("level"),
            F.regexp_replace(line, QUOTE, "").alias("body"),
        ),
    )

    def after_gap(of: Column) -> Column:
        gap = lambda i: F.coalesce(~F.get(of, i - 1)["body"].rlike(r"[^ \t\r\f\x0B]"), F.lit(False))
        return F.transform(of, lambda line, i: F.struct(line["level"].alias("level"), line["body"].alias("body"), gap(i).alias("gap")))

    def spaced(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda line, i: F.when(line["gap"] & (i > 0), F.concat(F.lit("\n"), line["body"])).otherwise(line["body"])), "\n")

    def runs(of: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(of))
        starts = F.filter(places, lambda i: (i == 1) | (F.get(of, i - 1)["level"] != F.get(of, i - 2)["level"]))
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(of) + 1))
        return F.transform(
            F.arrays_zip(starts.alias("first"), ends.alias("after")),
            lambda run: F.struct(
                F.get(of, run["first"] - 1)["level"].alias("level"),
                F.array_join(F.transform(F.slice(of, run["first"], run["after"] - run["first"]), lambda line: line["body"]), "\n").alias("text"),
                spaced(F.slice(of, run["first"], run["after"] - run["first"])).alias("spaced"),
            ),
        )

    # The lines are worked out once, as the one element of an array that is transformed.
    marked = F.get(F.transform(F.array(lines), after_gap), F.lit(0))
    spoken = F.filter(marked, lambda line: F.trim(line["body"]) != "")
    found = F.get(F.transform(F.array(spoken), lambda of: F.when(F.size(of) > 0, runs(of))), F.lit(0))
    return F.coalesce(found, F.array().cast("array<struct<level:int,text:string,spaced:string>>"))


def pieces(passage: Column) -> Column:
    """``array<struct<hash, size, whole>>``: the passage itself, its paragraphs and its lines, each text once."""
    texts = F.concat(F.array(passage["text"]), F.split(passage["spaced"], "\n\n"), F.split(passage["text"], "\n"))
    told = F.transform(
        F.array_distinct(F.transform(texts, normalised)),
        lambda text, i: F.struct(F.md5(text).alias("hash"), F.length(text).alias("size"), (i == 0).alias("whole")),
    )
    return F.filter(told, lambda piece: piece["whole"] | (piece["size"] > 0))


def _latest_before(marks: DataFrame) -> DataFrame:
    """For each quoted piece in ``marks(conv_id, hash, turn, at, is_quote, whole, level, place, size)`` the
    latest message of an earlier turn that says the same, if any: ``alone`` as a passage of its
    own, ``among`` as a passage, a paragraph or a line.

    A window over turns finds it without pairing rows. Long groups are cut into blocks of turns:
    a block learns of earlier ones by their latest message, one row per block.
    """
    blocked = marks.withColumn("block", F.floor(F.col("turn") / TURNS_PER_BLOCK))
    said = {"alone": F.when(~F.col("is_quote") & F.col("whole"), F.col("at")), "among": F.when(~F.col("is_quote"), F.col("at"))}
    key = ["conv_id", "hash"]
    earlier = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.groupBy(*key, "block").agg(*[F.max(at).alias(f"last_{name}") for name, at in said.items()])
        .select(*key, "block", *[F.max(f"last_{name}").over(earlier).alias(f"carried_{name}") for name in said])
        .filter(F.col("carried_among").isNotNull())
    )
    within = Window.partitionBy(*key, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = blocked.withColumns({f"near_{name}": F.max(at).over(within) for name, at in said.items()}).filter("is_quote")
    return found.join(carried, [*key, "block"], "left").select(
        "conv_id", "at", "level", "place", "whole", "size", *[F.coalesce(f"near_{name}", f"carried_{name}").alias(name) for name in said]
    )


def _depths(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv_id, at, root, depth)`` by pointer jumping over ``(conv_id, at, parent)``.

    A message whose pointer has reached its root takes no part in further rounds.
    """
    final = F.col("parent").isNull()
    depth = F.when(final, 0).otherwise(1).cast("long").alias("depth")
    start = parents.select("conv_id", "at", F.coalesce("parent", "at").alias("root"), depth, final.alias("final"))
    state = scratch.keep(start, "depths")
    done = state.filter("final")
    while True:
        moving = state.filter("not final")
        if moving.isEmpty():
            return done.drop("final")
        above = done.unionByName(moving).select(
            "conv_id", F.col("at").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more"), F.col("final").alias("above_final")
        )
        step = moving.join(above, ["conv_id", "root"]).select(
            "conv_id", "at", F.col("higher").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), F.col("above_final").alias("final")
        )
        state = scratch.keep(step, "depths")
        done = done.unionByName(state.filter("final"))


def link_quotations(messages: DataFrame, scratch: Scratch, apart: bool = False) -> DataFrame:
    """One row per message of ``messages(conv_id, turn, role, text)``: ``conv_id, turn, role, parent_turn,
    root_turn, depth, n_quotes, n_linked, text``, the text without quotes.

    Sorted by ``conv_id, root_turn, depth, turn`` the rows are the conversations in reply order, every
    message after the one it replies to. A message whose quotes match nothing begins a thread. Equal
    passages link to the latest earlier turn; a message that says the whole passage by itself goes
    before one that says it among other things, and that before paragraphs and lines, the longest
    first. A passage counts once in ``n_linked``, by whatever it is found. Messages without
    conversation or turn take no part; of several with the same conversation and turn the first by
    role and text stays, or with ``apart`` each one that differs in role or text. Null texts are
    empty. A conversation may hold any share of the rows: nothing is grouped by it alone.
    """
    known = messages.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    told = F.struct(F.coalesce("role", F.lit("")).alias("r"), F.coalesce("text", F.lit("")).alias("text"), "role")
    which = F.xxhash64(told["r"], told["text"]) if apart else F.lit(0).cast("long")
    one = known.select("conv_id", F.struct("turn", which.alias("which")).alias("at"), told.alias("m")).groupBy("conv_id", "at").agg(F.min("m").alias("m"))
    parts = one.select("conv_id", "at", F.col("m.role").alias("role"), passages(F.col("m.text")).alias("parts"))
    own = F.filter("parts", lambda p: p["level"] == 0)
    quotes = F.filter("parts", lambda p: p["level"] > 0)

    # What a message says as a whole can be quoted, and each of its passages, paragraphs and lines.
    whole = F.array_join(F.transform(own, lambda p: p["text"]), "\n")
    all_of_it = F.struct(F.md5(normalised(whole)).alias("hash"), F.length(normalised(whole)).alias("size"), F.lit(True).alias("whole"))
    spoken = F.array_union(F.flatten(F.transform(own, pieces)), F.array(all_of_it))
    read = scratch.keep(
        parts.select(
            "conv_id", "at", "role", whole.alias("text"),
            F.transform(quotes, lambda p: F.struct(p["level"].alias("level"), pieces(p).alias("pieces"))).alias("quotes"),
            F.when(F.size(own) > 0, spoken).otherwise(F.array().cast("array<struct<hash:string,size:int,whole:boolean>>")).alias("spoken"),
        ),
        "messages",
    )

    def marks(of: DataFrame, is_quote: bool) -> DataFrame:
        found = of.withColumn("one", F.explode("pieces"))
        return found.select("conv_id", "at.turn", "at", "place", "level", "one.hash", "one.size", "one.whole", F.lit(is_quote).alias("is_quote"))

    quoted = read.select("conv_id", "at", F.posexplode("quotes").alias("place", "q")).select("conv_id", "at", "place", "q.level", "q.pieces")
    own_marks = read.select("conv_id", "at", F.lit(0).alias("place"), F.lit(0).alias("level"), F.col("spoken").alias("pieces"))
    found = _latest_before(marks(quoted, True).unionByName(marks(own_marks, False)))
    alone = F.col("whole") & F.col("alone").isNotNull()
    best = F.struct(alone.alias("as_passage"), "size", F.when(alone, F.col("alone")).otherwise(F.col("among")).alias("source"))
    linked = found.groupBy("conv_id", "at", "level", "place").agg(F.max(F.when(F.col("among").isNotNull(), best))["source"].alias("source"))
    direct = F.when((F.col("level") == 1) & F.col("source").isNotNull(), F.struct("place", "source"))
    replies = linked.groupBy("conv_id", "at").agg(F.min(direct)["source"].alias("parent"), F.count("source").alias("n_linked"))
    threads = scratch.keep(
        read.select("conv_id", "at", "role", "text", F.size("quotes").alias("n_quotes")).join(replies, ["conv_id", "at"], "left"), "threads"
    )
    depths = _depths(threads, scratch)
    return threads.join(depths, ["conv_id", "at"]).select(
        "conv_id", "at.turn", "role", F.col("parent.turn").alias("parent_turn"), F.col("root.turn").alias("root_turn"), "depth",
        "n_quotes", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "text",
    )


def mail(conversations: DataFrame) -> DataFrame:
    """The conversations as messages that quote what they answer."""
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    return conversations.sparkSession.sql(MAIL_SQL, conversations=rows)
