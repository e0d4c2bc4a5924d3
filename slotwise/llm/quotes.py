"""Chat formatting by quotation linking. Only DataFrame functions run here.

Lines that begin with ``>`` are quoted; their number of ``>`` is the quote level.
Neighbouring lines of one level are a passage. Messages and passages are cut into
units (the whole, its paragraphs, its lines, its sentences), normalised (lower case,
runs of anything but letters and digits become one space) and hashed. A quoted unit of
``MIN_CHARS`` normalised characters or more links to the earliest earlier turn
of the same conversation that says it without quoting; a shorter passage links to one
that says nothing else. A unit of ``RUN_WORDS`` words or more that is no unit there
links to the earliest turn whose words hold it as a run, wherever lines break: its
rarest ``RUN_WORDS`` words find the turns, which are then compared whole. The turn with most linked
characters, at the lowest quote level that links, is the parent.

Following parents gives each message's reply path, the turns from the first
message of its thread down to itself, by doubling: each round joins every message
with the one that its pointer leads to. In order of (conversation, reply path)
each reply comes after what it answers, before the next message that answers
nothing; without quotes that is the order of turns. Quotes, and lines that only
announce a quote, are taken out of the text.

Links are aggregated per (conversation, hash) and per message before they are
joined, so a unit said often is one row. Conversations are never collected: each
message is formatted by itself, and the order is a range partitioning.

Null texts count as empty. Messages with a null conversation or turn link with
nothing. Rows that repeat a (conversation, turn) are kept, share the turn's parent
and are parts of one message for others. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.graph import cut

MIN_CHARS = 8
RUN_WORDS = 4
MARK = r"^[ \t]*((?:>[ \t]?)+)"
#: A line that announces a quote, in the corpus' languages.
ANNOUNCES = r"(?i)^\s*(on|le|am|el)\b.*\b(wrote|a écrit|schrieb|escribió)\b.*:\s*$"


def _lines(text: Column) -> Column:
    """(level, body) per line."""
    def one(line):
        mark = F.regexp_extract(line, MARK, 1)
        return F.struct(F.length(F.regexp_replace(mark, "[^>]", "")).alias("level"),
                        F.regexp_replace(line, MARK, "").alias("body"))
    return F.transform(F.split(text, r"\r?\n"), one)


def parse(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv, turn, role, own, passages): the text without quotes, and the
    quoted passages as (level, text)."""
    src = messages.select(messages[conv_col].alias("conv"), messages[turn_col].cast("long").alias("turn"),
                          messages[role_col].cast("string").alias("role"), F.coalesce(messages[text_col], F.lit("")).alias("text"))
    has = F.col("text").rlike("(?m)^[ \\t]*>")
    lines = src.withColumn("lines", F.when(has, _lines(F.col("text"))))

    def own(line, i):
        following = F.get("lines", i + 1)
        return (line["level"] == 0) & ~(line["body"].rlike(ANNOUNCES) & (F.coalesce(following["level"], F.lit(0)) > 0))

    none = F.expr("cast(array() as array<struct<level:int,text:string>>)")

    def join_lines(acc, line):
        last = F.try_element_at(acc, F.lit(-1))
        more = F.struct(line["level"].alias("level"), F.concat_ws("\n", last["text"], line["body"]).alias("text"))
        new = F.struct(line["level"].alias("level"), line["body"].alias("text"))
        return F.when(last["level"] == line["level"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(more))).otherwise(
            F.concat(acc, F.array(new)))

    passages = F.filter(F.aggregate("lines", none, join_lines), lambda p: p["level"] > 0)
    kept = F.array_join(F.transform(F.filter("lines", own), lambda line: line["body"]), "\n")
    return lines.select(
        "conv", "turn", "role",
        F.when(has, F.regexp_replace(F.regexp_replace(kept, r"^\s+|\s+$", ""), r"\n{3,}", "\n\n")).otherwise(F.col("text")).alias("own"),
        F.when(has, passages).otherwise(none).alias("passages"))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def units(text: Column) -> Column:
    """Distinct normalised units of a text, long enough to link or the whole."""
    parts = F.concat(F.array(text), F.split(text, r"\n\s*\n"), F.split(text, r"\n"), F.split(text, r"[.!?]+(?=\s|$)|[。！？]+"))
    return F.array_distinct(F.filter(F.transform(parts, _normal), lambda u, i: (F.length(u) >= MIN_CHARS) | ((i == 0) & (u != ""))))


def _runs(normal: Column) -> Column:
    """The distinct runs of ``RUN_WORDS`` words of a normalised text."""
    words = F.split(normal, " ")
    at = F.sequence(F.lit(1), F.greatest(F.size(words) - RUN_WORDS + 1, F.lit(1)))
    return F.when(F.size(words) >= RUN_WORDS, F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(words, i, RUN_WORDS), " "))))


def contained(rest: DataFrame, spoken: DataFrame) -> DataFrame:
    """``rest`` (conv, turn, level, unit, hash, chars) with ``source``, the
    earliest earlier turn that holds the unit's words as a run. ``spoken``:
    conv, turn, normal."""
    held = spoken.select(F.col("conv").alias("hc"), F.col("turn").alias("ht"), F.explode(_runs(F.col("normal"))).alias("run"))
    held = held.select("hc", "ht", F.md5("run").alias("hr")).distinct()
    often = held.groupBy(F.col("hc").alias("oc"), F.col("hr").alias("o")).agg(F.count(F.lit(1)).alias("n"))
    # the earliest turn that holds a unit is the same for all who quote it: units are looked up once per conversation
    wanted = rest.groupBy("conv", "hash").agg(F.first("unit").alias("unit"))
    asked = wanted.withColumn("run", F.explode(_runs(F.col("unit")))).withColumn("run", F.md5("run"))
    keys = ["conv", "hash", "unit"]
    rarest = (asked.join(often, (F.col("conv") == F.col("oc")) & (F.col("run") == F.col("o")))
              .groupBy(*keys).agg(F.min_by("run", F.struct("n", "run")).alias("run")))
    near = rarest.join(held, (F.col("conv") == F.col("hc")) & (F.col("run") == F.col("hr")))
    texts = spoken.select(F.col("conv").alias("sc"), F.col("turn").alias("st"), "normal")
    whole = near.join(texts, (F.col("conv") == F.col("sc")) & (F.col("ht") == F.col("st"))).where(
        F.contains(F.concat(F.lit(" "), "normal", F.lit(" ")), F.concat(F.lit(" "), "unit", F.lit(" "))))
    first = whole.groupBy(F.col("conv").alias("fc"), F.col("hash").alias("fh")).agg(F.min("ht").alias("source"))
    both = rest.join(first, (F.col("conv") == F.col("fc")) & (F.col("hash") == F.col("fh"))).where("source < turn")
    return both.select("conv", "turn", "level", "unit", "hash", "chars", "source")


def parents(parsed: DataFrame) -> DataFrame:
    """(conv, turn, parent, n_linked): the parent turn of messages whose quotes
    link, and how many units do."""
    quoting = parsed.where((F.size("passages") > 0) & F.col("conv").isNotNull() & F.col("turn").isNotNull())
    quoted = (quoting.select("conv", "turn", F.explode("passages").alias("p"))
              .select("conv", "turn", F.col("p.level").alias("level"), F.explode(units(F.col("p.text"))).alias("unit"))
              .select("conv", "turn", "level", "unit", F.md5("unit").alias("hash"), F.length("unit").alias("chars")))
    convs = quoting.select(F.col("conv").alias("c")).distinct()
    heard = parsed.where("turn is not null").join(convs, F.col("conv") == F.col("c"), "left_semi")
    said = (heard.select("conv", "turn", F.explode(units(F.col("own"))).alias("unit"))
            .groupBy(F.col("conv").alias("sc"), F.md5("unit").alias("sh")).agg(F.min("turn").alias("source")))
    found = cut(quoted.join(said, (F.col("conv") == F.col("sc")) & (F.col("hash") == F.col("sh")), "left"))
    exact = found.where("source < turn").select("conv", "turn", "level", "hash", "chars", "source")
    rest = found.where("source is null or source >= turn").select("conv", "turn", "level", "unit", "hash", "chars").distinct()
    runs = contained(rest, heard.select("conv", "turn", _normal(F.col("own")).alias("normal")))
    links = exact.union(runs.select(*exact.columns))
    votes = links.groupBy("conv", "turn", "source").agg(
        F.min("level").alias("level"), F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n"))
    return votes.groupBy("conv", "turn").agg(
        F.max_by("source", F.struct(-F.col("level"), F.col("chars"), F.col("source"))).alias("parent"),
        F.sum("n").alias("n_linked"))


def reply_paths(linked: DataFrame) -> DataFrame:
    """(conv, turn, above): all messages with a parent, and the turns above
    them, first one first, by pointer doubling."""
    state = cut(linked.select("conv", "turn", F.col("parent").alias("up"), F.array("parent").alias("above")))
    while True:
        upper = state.select(F.col("conv").alias("uc"), F.col("turn").alias("ut"), F.col("up").alias("upper"), F.col("above").alias("more"))
        step = cut(state.join(upper, (F.col("conv") == F.col("uc")) & (F.col("up") == F.col("ut")), "left")
                   .select("conv", "turn", F.coalesce("upper", "up").alias("up"),
                           F.when(F.col("upper").isNull(), F.col("above")).otherwise(F.concat("more", "above")).alias("above"),
                           F.col("upper").isNotNull().alias("moved")))
        state = step.drop("moved")
        if step.where("moved").isEmpty():
            return state.drop("up")


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per message: conversation, ``turn``, ``role``, ``parent_turn``
    (null without a link), ``reply_path`` (array of turns), ``n_quotes``,
    ``n_linked``, ``content`` (text without quotes)."""
    parsed = parse(messages, conv_col, turn_col, role_col, text_col)
    linked = cut(parents(parsed))
    paths = reply_paths(linked).select(F.col("conv").alias("pc"), F.col("turn").alias("pt"), "above")
    found = linked.join(paths, (F.col("conv") == F.col("pc")) & (F.col("turn") == F.col("pt")))
    found = found.select(F.col("conv").alias("fc"), F.col("turn").alias("ft"), "parent", "n_linked", "above")
    both = parsed.join(found, (F.col("conv") == F.col("fc")) & (F.col("turn") == F.col("ft")), "left")
    return both.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
        F.col("parent").alias("parent_turn"),
        F.concat(F.coalesce("above", F.expr("cast(array() as array<bigint>)")), F.array("turn")).alias("reply_path"),
        F.size("passages").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.col("own").alias("content"))


def format_chat(linked: DataFrame, conv_col: str = "conv_id", role_col: str = "role") -> DataFrame:
    """``linked`` with each message as a chat block in ``chat``, in reply order:
    partitions are ranges of (conversation, reply path), sorted inside."""
    chat = F.concat(F.lit("<|"), F.coalesce(F.col(f"`{role_col}`"), F.lit("unknown")), F.lit("|>\n"), F.col("content"), F.lit("\n<|end|>\n"))
    out = linked.withColumn("chat", chat)
    return out.repartitionByRange(F.col(f"`{conv_col}`"), "reply_path").sortWithinPartitions(F.col(f"`{conv_col}`"), "reply_path")
