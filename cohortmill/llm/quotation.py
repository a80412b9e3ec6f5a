"""Quotation linking for message threads: quote levels, hashed passages, originals, and conversations in reply order.

Only DataFrame functions are used. A line's quote level is the number of ``>`` at its start (spaces in between allowed).
Consecutive lines of one level without a blank line are a passage; its normal form is in lower case with white space
collapsed, so re-wrapping does not matter, and its key is the SHA-256 of that. Own passages (level 0) of all messages and
their lines are reduced to the earliest message of the conversation that holds them; quoted passages join on conversation
and key. A quoted passage without an original as a whole, a part of one or several put together, is linked by its lines:
its original is the earlier message that holds its longest line (ties: the earliest).

A message replies to the message that the first linked passage of its lowest quote level comes from. Its thread path is the
turns from the root of that reply chain down to itself, found by doubling (each round joins the paths so far to
themselves). Sorting a conversation by path puts replies below what they answer, in order of turns; ``position`` is the
place in that order from 0, from global ranks, without gathering a conversation in one task.

A line that introduces a quote ("... wrote:", of any length) above it is dropped with it, a blank line in between or not; so
is the line before, where the introduction wraps ("On Monday, Bob" / "wrote:"). Quoted lines are dropped, and the rest of the
text stays as it is but for white space at its ends.

Defined cases: a null text is an empty message; a message whose conversation or turn is null is answered as a root of its own,
links with nothing and has no position; only earlier turns of the same conversation can be originals; rows that repeat
(conversation, turn) share parent and path and have positions each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortmill.llm.sharding import ranked
from cohortmill.llm.staging import staged

_QUOTE = r"^[ \t]*(?:>[ \t]?)+"
_WROTE = r"(?i)^\s*(?:\S.*)?\b(?:wrote|writes|schrieb|escribi\x{f3}|a \x{e9}crit)\b.*:\s*$"
_BEGINS = r"(?i)^\s*(?:on|am|le|el)\b"


def _lines(text: Column) -> Column:
    """Array of (level, content): one element per line."""
    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, _QUOTE, 0)
        level = F.length(F.regexp_replace(marks, r"[^>]", ""))
        return F.struct(level.alias("level"), F.regexp_replace(x, _QUOTE, "").alias("content"))

    return F.transform(F.split(text, r"\r\n|\r|\n"), line)


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _passages(lines: Column) -> Column:
    """Array of (level, words, lines): maximal runs of non-blank lines of one level, in text order."""
    def marked(x: Column, k: Column) -> Column:
        before = F.when(k > 0, F.element_at(lines, k))  # 1-based: the line above
        empty = F.trim(x["content"]) == ""
        starts = (k == 0) | (before["level"] != x["level"]) | (F.trim(before["content"]) == "")
        return F.struct(x["level"].alias("level"), x["content"].alias("content"), empty.alias("empty"), starts.alias("starts"))

    rows = F.filter(F.transform(lines, marked), lambda x: ~x["empty"])
    # Carriage returns cannot occur in lines: one text of all runs, each behind its level, is cut again at these marks.
    joined = F.concat_ws("\n", F.transform(rows, lambda x: F.concat(
        F.when(x["starts"], F.concat(F.lit("\r"), x["level"].cast("string"), F.lit("\r"))).otherwise(F.lit("")), x["content"])))
    runs = F.filter(F.split(joined, r"\n?\r(?=\d+\r)"), lambda x: x != "")

    def named(x: Column) -> Column:
        lines = F.transform(F.split(F.regexp_replace(x, r"^\d+\r", ""), "\n"), _normal)
        words = F.trim(F.array_join(F.filter(lines, lambda line: line != ""), " "))
        return F.struct(F.regexp_extract(x, r"^(\d+)\r", 1).cast("int").alias("level"), words.alias("words"), lines.alias("lines"))

    return F.transform(runs, named)


def _own_text(lines: Column) -> Column:
    """The text without quoted lines and without the lines that introduce a quote."""
    def at(k: Column) -> Column:
        return F.when(k < F.size(lines), F.element_at(lines, k + 1))

    def deeper(x: Column, than: Column) -> Column:
        return F.coalesce(x["level"] > than, F.lit(False))

    def introduces(x: Column, k: Column) -> Column:
        below, next_but_one = at(k + 1), at(k + 2)
        blank = F.coalesce(F.trim(below["content"]) == "", F.lit(False))
        return x["content"].rlike(_WROTE) & (deeper(below, x["level"]) | (blank & deeper(next_but_one, x["level"])))

    def kept(x: Column, k: Column) -> Column:
        below = at(k + 1)
        wraps = x["content"].rlike(_BEGINS) & F.coalesce((below["level"] == x["level"]) & introduces(below, k + 1), F.lit(False))
        return F.when((x["level"] == 0) & ~introduces(x, k) & ~wraps, x["content"])

    return F.regexp_replace(F.concat_ws("\n", F.filter(F.transform(lines, kept), lambda x: x.isNotNull())), r"^\s+|\s+$", "")


def passages(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """The messages with ``own_text`` and ``passages`` (level, words, key, lines)."""
    lines = F.col("__lines")
    keyed = F.transform(_passages(lines), lambda p: F.struct(
        p["level"].alias("level"), p["words"].alias("words"), F.sha2(p["words"].cast("binary"), 256).alias("key"),
        p["lines"].alias("lines")))
    return (
        messages.withColumn("__lines", _lines(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
        .withColumn("own_text", _own_text(lines)).withColumn("passages", keyed).drop("__lines")
    )


def reply_paths(replies: DataFrame) -> DataFrame:
    """(conv, turn, path) of the messages in ``replies`` (conv, turn, parent): turns from the root to the message.

    Doubling: a path that ends at an open ancestor is extended by that ancestor's own path, so a chain of n replies takes
    log n rounds of joins."""
    paths = staged(replies.select("conv", "turn", F.col("parent").alias("open"), F.array("turn").alias("path")), "paths")
    while paths.where("open is not null").limit(1).count():
        above = paths.select("conv", F.col("turn").alias("open"), F.col("open").alias("next"), F.col("path").alias("front"),
                             F.lit(True).alias("found"))
        paths = staged(
            paths.join(above, ["conv", "open"], "left").select(
                "conv", "turn",
                F.when(F.col("found"), F.col("next")).alias("open"),
                F.when(F.col("found"), F.concat("front", "path"))
                .when(F.col("open").isNotNull(), F.concat(F.array("open"), "path")).otherwise(F.col("path")).alias("path"),
            ),
            "paths",
        )
    return paths.select("conv", "turn", "path")


def _by_lines(open_quotes: DataFrame, flat: DataFrame) -> DataFrame:
    """The quoted passages without an original as a whole, with the one that their longest known line comes from."""
    def keyed(rows: DataFrame, lines: str, *columns: str) -> DataFrame:
        return rows.select(*columns, F.explode(lines).alias("line")).where("line <> ''").withColumn(
            "line_key", F.sha2(F.col("line").cast("binary"), 256))

    wanted = keyed(open_quotes, "lines", "conv", "turn", "nth")
    own = keyed(flat.where("p.level = 0"), "p.lines", "conv", "turn").groupBy("conv", "line_key").agg(F.min("turn").alias("from"))
    found = wanted.join(own, ["conv", "line_key"]).where(F.col("from") < F.col("turn")).groupBy("conv", "turn", "nth").agg(
        F.max_by("from", F.struct(F.length("line").alias("size"), (-F.col("from")).alias("early"))).alias("line_original"))
    return open_quotes.drop("lines", "original").join(found, ["conv", "turn", "nth"], "left").withColumnRenamed(
        "line_original", "original")


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """Per message: conv, turn, role, own_text, quote_levels (deepest), n_quotes, n_linked (quoted passages and those with
    an original), parent_turn, root_turn, depth, path, position."""
    named = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    parsed = staged(passages(named), "messages")
    placed = parsed.where("conv is not null and turn is not null")
    flat = placed.select("conv", "turn", F.posexplode("passages").alias("nth", "p"))
    originals = staged(
        flat.where("p.level = 0 and p.words <> ''").groupBy("conv", F.col("p.key").alias("key"))
        .agg(F.min("turn").alias("original")), "originals")
    quoted = flat.where("p.level > 0").select(
        "conv", "turn", F.col("p.key").alias("key"), F.col("p.level").alias("level"), "nth", F.col("p.lines").alias("lines"))
    whole = staged(quoted.join(originals, ["conv", "key"], "left").withColumn(
        "original", F.when(F.col("original") < F.col("turn"), F.col("original"))), "quoted")
    linked = whole.where("original is not null").drop("lines").unionByName(_by_lines(whole.where("original is null"), flat))
    first = F.min(F.when(F.col("original").isNotNull(), F.struct("level", "nth", "original")))
    replies = staged(
        linked.groupBy("conv", "turn").agg(
            F.max("level").alias("quote_levels"), F.count("*").alias("n_quotes"), F.count("original").alias("n_linked"),
            first["original"].alias("parent")),
        "replies",
    )
    paths = reply_paths(replies.where("parent is not null").select("conv", "turn", "parent"))
    linked_rows = parsed.select("conv", "turn", "role", "own_text").join(replies, ["conv", "turn"], "left").join(
        paths, ["conv", "turn"], "left").withColumn("path", F.coalesce("path", F.array("turn")))
    order = ranked(linked_rows.withColumn("__one", F.lit(1)), ["conv", "path"], "__one", "threads").drop("before", "__one")
    first_rank = staged(order.where("conv is not null and turn is not null").groupBy("conv").agg(F.min("rank").alias("__first")), "first")
    return order.join(first_rank, "conv", "left").select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "own_text",
        F.coalesce("quote_levels", F.lit(0)).alias("quote_levels"), F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("parent").alias("parent_turn"),
        F.element_at("path", 1).alias("root_turn"), (F.size("path") - 1).alias("depth"), "path",
        F.when(F.col("turn").isNotNull(), F.col("rank") - F.col("__first")).alias("position"))
