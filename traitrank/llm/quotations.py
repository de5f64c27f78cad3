"""Conversations in reply order, told from quoted passages.

Lines behind ``>`` signs are quoted, their number is the level; nesting deeper means quoting what
was quoted already. Neighbouring lines of one level form a passage. Its words, without case and
punctuation, are hashed and joined to the paragraphs, lines and whole bodies that earlier
messages of the conversation wrote themselves. A message answers the message that its first
linked passage, of the lowest level, was written in; without one, the message before it. Depths
come from pointer doubling over numbers only, one join per power of two, so neither a long chain
nor a large conversation is ever gathered. Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitrank.operators.ordering import positions
from traitrank.sources.staging import Staging

_QUOTE = r"^[ \t]*(?:>[ \t]*)*"
_ATTRIBUTION = r"(?i)^[ \t]*(?:on|am|le|el) .*(?:wrote|schrieb|a écrit|escribió)[^:]*:[ \t\r]*$"
_BLANK = " \t\r\n"
_NO_WORD = r"[^\p{L}\p{N}]+"


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def parsed_lines(text: Column) -> Column:
    """array<struct<level int, content string, line string>> of a text, null for null."""
    return F.transform(
        F.split(text, "\n", -1),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, _QUOTE, 0), "[^>]", "")).alias("level"),
            F.trim(F.regexp_replace(line, _QUOTE, ""), F.lit(_BLANK)).alias("content"),
            line.alias("line"),
        ),
    )


def normal(passage: Column) -> Column:
    """Words of a passage in lower case, single spaces between them."""
    return F.trim(F.regexp_replace(F.lower(passage), _NO_WORD, " "))


def passages(lines: Column) -> Column:
    """array<struct<level, passage>>: runs of filled lines of one level, 0 included, in order."""

    def of(p: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(p))
        filled = F.filter(places, lambda i: F.get(p, i - 1)["content"] != "")

        def breaks(i: Column, step: int) -> Column:
            """Whether nothing of the same run lies at the line before or after."""
            other, own = F.get(p, i - 1 + step), F.get(p, i - 1)
            return other.isNull() | (other["content"] == "") | (other["level"] != own["level"])

        starts = F.filter(filled, lambda i: breaks(i, -1))
        ends = F.filter(filled, lambda i: breaks(i, 1))
        return F.transform(
            F.arrays_zip(starts.alias("s"), ends.alias("e")),
            lambda r: F.struct(
                F.get(p, r["s"] - 1)["level"].alias("level"),
                F.array_join(F.transform(F.slice(p, r["s"], r["e"] - r["s"] + 1), lambda x: x["content"]), " ").alias("passage"),
            ),
        )

    return F.when(F.size(lines) > 0, _let(lines, of))


def own_body(lines: Column) -> Column:
    """What a message says itself: its unquoted lines without the line that announces a quote."""

    def of(p: Column) -> Column:
        said = F.filter(
            p,
            lambda x, i: (x["level"] == 0)
            & ~(F.coalesce(F.get(p, i + 1)["level"] > 0, F.lit(False)) & x["line"].rlike(_ATTRIBUTION)),
        )
        return F.trim(F.array_join(F.transform(said, lambda x: x["line"]), "\n"), F.lit(_BLANK))

    return _let(lines, of)


def _depths(nodes: DataFrame, staging: Staging) -> DataFrame:
    """(conv_id, pos, depth) from (conv_id, pos, parent); the parent lies before.

    Every step doubles how far up a message has looked. Messages that reached the opening one
    take no further part, so a long conversation costs steps for its own messages only.
    """
    known = staging.write(
        nodes.select("conv_id", "pos", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth")),
        "depths",
    )
    done, climbing = known.filter("up IS NULL"), known.filter("up IS NOT NULL")
    while not climbing.isEmpty():
        above = done.unionByName(climbing).select(
            "conv_id", F.col("pos").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more")
        )
        known = staging.write(
            climbing.join(above.hint("merge"), ["conv_id", "up"]).select(
                "conv_id", "pos", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth")
            ),
            "depths",
        )
        done, climbing = done.unionByName(known.filter("up IS NULL")), known.filter("up IS NOT NULL")
    return done.drop("up")


def reply_order(
    messages: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, body, n_quoted, n_linked, reply_to, depth, position), one row per row.

    ``body`` is the text without quotations, ``n_quoted`` and ``n_linked`` count its quoted
    passages, ``reply_to`` is the turn it answers, ``depth`` its distance from the opening message,
    ``position`` its place from 1 when messages follow those that they answer, level by level and
    by turn within a level. Rows that repeat a turn share its place. Without conversation or turn a
    row has no place (nulls) and links nothing. Null texts have a null body, empty ones ''. An empty
    table gives an empty result; further columns are not looked at.
    """
    staging = Staging.of(messages)
    given = messages.select(
        F.col(conversation).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    parsed = given.withColumn("lines", parsed_lines(F.col("text"))).withColumn("runs", passages(F.col("lines")))
    said = F.array_union(
        F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["passage"]),
        F.array_append(
            F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["content"]),
            F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["content"]), " "),
        ),
    )
    quoted = F.transform(
        F.filter("runs", lambda r: r["level"] > 0), lambda r: F.struct(r["level"].alias("level"), F.md5(normal(r["passage"])).alias("hash"))
    )
    placed = parsed.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    quotes = staging.write(
        placed.select("conv_id", "turn", F.posexplode(quoted).alias("nth", "q"))
        .select("conv_id", "turn", "nth", "q.level", "q.hash"),
        "quotes",
    )
    quoting = quotes.select("conv_id").distinct()
    written = (
        placed.join(quoting.hint("merge"), "conv_id", "left_semi")
        .select("conv_id", "turn", F.explode(F.array_distinct(F.transform(said, normal))).alias("words"))
        .filter("words <> ''")
        .groupBy("conv_id", F.md5("words").alias("hash")).agg(F.min("turn").alias("origin"))
    )
    linked = quotes.join(written.hint("merge"), ["conv_id", "hash"]).filter(F.col("origin") < F.col("turn"))
    answers = linked.groupBy("conv_id", "turn").agg(
        F.min_by("origin", F.struct("level", "nth")).alias("origin"), F.count(F.lit(1)).alias("n_linked")
    )
    turns = staging.write(
        positions(placed.select("conv_id", "turn").distinct(), ["conv_id"], [F.col("turn")], "pos", staging=staging), "turns"
    )
    origins = turns.select("conv_id", F.col("turn").alias("origin"), F.col("pos").alias("origin_pos"))
    before = turns.select("conv_id", (F.col("pos") + 1).alias("pos"), F.col("turn").alias("previous"))
    nodes = staging.write(
        turns.join(answers.hint("merge"), ["conv_id", "turn"], "left")
        .join(origins.hint("merge"), ["conv_id", "origin"], "left")
        .join(before.hint("merge"), ["conv_id", "pos"], "left")
        .select(
            "conv_id", "turn", "pos", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            F.coalesce("origin", "previous").alias("reply_to"),
            F.coalesce("origin_pos", F.when(F.col("pos") > 1, F.col("pos") - 1)).alias("parent"),
        ),
        "replies",
    )
    deep = nodes.drop("parent").join(_depths(nodes, staging).hint("merge"), ["conv_id", "pos"])
    ordered = positions(deep, ["conv_id"], [F.col("depth"), F.col("turn")], "position", staging=staging)
    n_quoted = F.coalesce(F.size(F.filter("runs", lambda r: r["level"] > 0)), F.lit(0)).cast("long")
    return (
        parsed.select("conv_id", "turn", "role", own_body(F.col("lines")).alias("body"), n_quoted.alias("n_quoted"))
        .join(ordered.select("conv_id", "turn", "n_linked", "reply_to", "depth", "position").hint("merge"), ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "role", "body", "n_quoted", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            "reply_to", "depth", "position",
        )
    )


ORACLE = rf"""
WITH RECURSIVE lines AS (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM conversations
), parsed AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '{_QUOTE}'), '[^>]', '', 'g')) AS level,
    trim(regexp_replace(line, '{_QUOTE}', ''), ' ' || chr(9) || chr(13)) AS content
  FROM lines
), told AS (
  SELECT *, CASE WHEN level = lag(level) OVER w AND lag(content) OVER w <> '' AND content <> '' THEN 0 ELSE 1 END AS breaks,
    level = 0 AND NOT (coalesce(lead(level) OVER w, 0) > 0 AND regexp_matches(line, '{_ATTRIBUTION}')) AS said
  FROM parsed WINDOW w AS (PARTITION BY conv_id, turn ORDER BY i)
), runs AS (
  SELECT *, sum(breaks) OVER (PARTITION BY conv_id, turn ORDER BY i) AS run FROM told
), passages AS (
  SELECT conv_id, turn, level, run, string_agg(content, ' ' ORDER BY i) AS passage FROM runs WHERE content <> '' GROUP BY ALL
), quotes AS (
  SELECT conv_id, turn, level, run, trim(regexp_replace(lower(passage), '{_NO_WORD}', ' ', 'g')) AS words FROM passages WHERE level > 0
), own AS (
  SELECT conv_id, turn, passage FROM passages WHERE level = 0
  UNION ALL SELECT conv_id, turn, content FROM parsed WHERE level = 0
  UNION ALL SELECT conv_id, turn, string_agg(content, ' ' ORDER BY i) FROM parsed WHERE level = 0 GROUP BY ALL
), written AS (
  SELECT conv_id, words, min(turn) AS origin FROM (
    SELECT conv_id, turn, trim(regexp_replace(lower(passage), '{_NO_WORD}', ' ', 'g')) AS words FROM own
  ) WHERE words <> '' GROUP BY conv_id, words
), answers AS (
  SELECT q.conv_id, q.turn, arg_min(origin, (level, run)) AS origin, count(*) AS n_linked
  FROM quotes q JOIN written o ON q.conv_id = o.conv_id AND q.words = o.words AND o.origin < q.turn GROUP BY ALL
), replies AS (
  SELECT c.conv_id, c.turn, coalesce(n_linked, 0) AS n_linked,
    coalesce(origin, lag(c.turn) OVER (PARTITION BY c.conv_id ORDER BY c.turn)) AS reply_to
  FROM conversations c LEFT JOIN answers a ON c.conv_id = a.conv_id AND c.turn = a.turn
), deep AS (
  SELECT conv_id, turn, 0 AS depth FROM replies WHERE reply_to IS NULL
  UNION ALL
  SELECT r.conv_id, r.turn, d.depth + 1 FROM deep d JOIN replies r ON r.conv_id = d.conv_id AND r.reply_to = d.turn
), bodies AS (
  SELECT conv_id, turn, trim(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (said), ''), ' ' || chr(9) || chr(13) || chr(10)) AS body
  FROM told GROUP BY ALL
), counted AS (
  SELECT conv_id, turn, count(*) AS n_quoted FROM quotes GROUP BY ALL
)
SELECT c.conv_id, c.turn, c.role, b.body, coalesce(n_quoted, 0) AS n_quoted, r.n_linked, r.reply_to, d.depth::INTEGER AS depth,
  row_number() OVER (PARTITION BY c.conv_id ORDER BY d.depth, c.turn)::INTEGER AS position
FROM conversations c JOIN replies r USING (conv_id, turn) JOIN deep d USING (conv_id, turn)
LEFT JOIN bodies b USING (conv_id, turn) LEFT JOIN counted USING (conv_id, turn)
"""
