"""Chat formatting by quotation linking.

Messages may quote earlier ones with `>` marks, nested to any level. Lines are parsed
into levels; the own lines of a message (level 0) and its quoted lines are hashed in
a normal form (lower case, runs of other characters than letters and digits as one
space). Each quoted line is joined to the latest earlier message of its conversation
that has this line as its own. A message replies to the message that most of its
lines at the lowest linked level come from (the later one on a tie); without a link,
to the message before it. Conversations come out in order of their turns, in which
every message follows the one it replies to, without quotes and the lines that
announce them, as text with a mark for each role.

A conversation may hold a third of all messages, so none is gathered whole. Rows are
handled in blocks of `BLOCK` turns: a block's own lines are ordered within the block,
and of earlier blocks only the last turn of each line counts. Results are segments of
at most `SEGMENT` messages.

Defined results: a null text is empty; a null role is `unknown`; a message with
nothing but quotes keeps its place with an empty text; messages of one turn are
ordered by role and text, and do not quote each other; repeated rows are repeated
messages; messages without a conversation form one of their own; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import registered, table, written

BLOCK = 1024
SEGMENT = 256
KEY = ["conv_id", "turn"]

MARKS = r"'^(\\s*>)+'"
LINES = r"split(text, '\\r?\\n')"


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, h) of every line that has letters or digits."""
    return (
        messages.selectExpr(*KEY, f"explode({LINES}) AS line")
        .selectExpr(
            *KEY,
            rf"length(regexp_replace(regexp_extract(line, {MARKS}, 0), '[^>]', '')) AS level",
            rf"trim(lower(regexp_replace(regexp_replace(line, {MARKS}, ''), '[^\\p{{L}}\\p{{N}}]+', ' '))) AS plain",
        )
        .where("plain <> ''")
        .selectExpr(*KEY, "level", "xxhash64(plain) AS h")
    )


def quote_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, h, source): the turn that each quoted line comes from, if any."""
    lines = parsed(messages).withColumn("block", F.expr(f"floor(turn / {BLOCK})"))
    lines = written(lines.groupBy("conv_id", "turn", "block", "level", "h").agg(F.count("*").alias("n")), "lines")
    quoted = lines.where("level > 0")
    # only lines that are quoted somewhere take part
    asked = quoted.select("conv_id", "h").distinct()
    own = lines.where("level = 0").join(asked, ["conv_id", "h"], "left_semi")
    earlier = Window.partitionBy("conv_id", "h").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    both = own.withColumn("own", F.col("turn")).unionByName(quoted.withColumn("own", F.lit(None).cast(own.schema["turn"].dataType)))
    blocks = (
        both.groupBy("conv_id", "h", "block")
        .agg(F.max("own").alias("top"))
        .withColumn("before", F.max("top").over(earlier))
        .drop("top")
    )
    inside = Window.partitionBy("conv_id", "h", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    return (
        both.withColumn("inside", F.max("own").over(inside))
        .where("level > 0")
        .join(blocks, ["conv_id", "h", "block"], "left")
        .selectExpr(*KEY, "level", "h", "n", "coalesce(inside, before) AS source")
    )


def replies(links: DataFrame) -> DataFrame:
    """(conv_id, turn, quoted, linked, source) of every message that quotes."""
    counted = links.groupBy(*KEY, "level", "source").agg(F.sum("n").alias("n"))
    return counted.groupBy(*KEY).agg(
        F.sum("n").alias("quoted"),
        F.sum(F.expr("IF(source IS NULL, 0L, n)")).alias("linked"),
        F.expr("max_by(source, IF(source IS NULL, NULL, struct(-level, n, source))) AS source"),
    )


def positions(messages: DataFrame) -> DataFrame:
    """`messages` with `position` from 0 in their conversation and the turn before."""
    messages = messages.withColumn("block", F.expr(f"floor(turn / {BLOCK})"))
    blocks = messages.groupBy("conv_id", "block").agg(F.count("*").alias("n"), F.max("turn").alias("top"))
    order = Window.partitionBy("conv_id").orderBy("block")
    blocks = (
        blocks.withColumn("base", F.sum("n").over(order) - F.col("n"))
        .withColumn("last", F.lag("top").over(order))
        .select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "base", "last")
    )
    own = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    earlier = Window.partitionBy("conv_id", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    return (
        messages.withColumn("own", F.row_number().over(own) - 1)
        .withColumn("inside", F.max("turn").over(earlier))
        .join(blocks, F.expr("conv_id <=> c AND block <=> b"))
        .withColumn("position", F.expr("own + base"))
        .withColumn("before", F.expr("coalesce(inside, last)"))
        .drop("block", "c", "b", "own", "inside", "last", "base")
    )


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, position, turn, role, content, reply_to, quoted, linked."""
    messages = messages.selectExpr(*KEY, "coalesce(role, 'unknown') AS role", "coalesce(text, '') AS text")
    announced = r"l RLIKE '^\\s*On .*wrote:\\s*$' AND coalesce(get(lines, i + 1) RLIKE '^\\s*>', false)"
    content = (
        f"get(transform(array({LINES}), lines -> trim(BOTH '\n ' FROM array_join(filter(lines,"
        rf" (l, i) -> NOT (l RLIKE '^\\s*>' OR {announced})), '\n'))), 0)"
    )
    quoting = replies(quote_links(messages)).withColumnsRenamed({"conv_id": "c", "turn": "t"})
    return (
        positions(messages)
        .join(quoting, F.expr("conv_id <=> c AND turn <=> t"), "left")
        .selectExpr(
            "conv_id",
            "position",
            "turn",
            "role",
            f"{content} AS content",
            "coalesce(source, before) AS reply_to",
            "coalesce(quoted, 0L) AS quoted",
            "coalesce(linked, 0L) AS linked",
        )
    )


def segments(chats: DataFrame) -> DataFrame:
    """Conversations as text, at most `SEGMENT` messages in a row."""
    message = "named_struct('position', position, 'turn', turn, 'role', role, 'content', content, 'reply_to', reply_to)"
    return (
        chats.withColumn("segment", F.expr(f"BIGINT(position DIV {SEGMENT})"))
        .groupBy("conv_id", "segment")
        .agg(
            F.count("*").alias("n_messages"),
            F.sum("quoted").alias("n_quoted"),
            F.sum("linked").alias("n_linked"),
            F.expr(f"array_sort(collect_list({message})) AS messages"),
        )
        .selectExpr(
            "conv_id",
            "segment",
            "n_messages",
            "n_quoted",
            "n_linked",
            "array_join(transform(messages, m -> concat(m.turn, '<', coalesce(STRING(m.reply_to), ''))), ',') AS replies",
            "array_join(transform(messages, m -> concat('<|', m.role, '|>\n', m.content)), '\n') AS text",
        )
    )


SQL = r"""
WITH messages AS (
  SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations),
raw AS (
  SELECT id, conv_id, turn, unnest(regexp_split_to_array(text, '\r?\n')) AS line,
         generate_subscripts(regexp_split_to_array(text, '\r?\n'), 1) AS pos
  FROM messages),
lines AS (
  SELECT id, conv_id, turn, pos, line,
         length(regexp_replace(regexp_extract(line, '^(\s*>)+'), '[^>]', '', 'g')) AS level,
         trim(lower(regexp_replace(regexp_replace(line, '^(\s*>)+', ''), '[^\p{L}\p{N}]+', ' ', 'g'))) AS plain
  FROM raw),
linked AS (
  SELECT q.conv_id, q.turn, q.level, q.pos, q.id, max(o.turn) AS source
  FROM lines q LEFT JOIN lines o
  ON o.conv_id = q.conv_id AND o.level = 0 AND o.plain = q.plain AND o.turn < q.turn
  WHERE q.level > 0 AND q.plain <> '' GROUP BY ALL),
counted AS (SELECT conv_id, turn, level, source, count(*) AS n FROM linked GROUP BY ALL),
quoting AS (
  SELECT conv_id, turn, sum(n) AS quoted, sum(CASE WHEN source IS NULL THEN 0 ELSE n END) AS linked,
         max_by(source, CASE WHEN source IS NULL THEN NULL ELSE {'l': -level, 'n': n, 's': source} END) AS source
  FROM counted GROUP BY ALL),
shown AS (
  SELECT id, trim(string_agg(line, E'\n' ORDER BY pos) FILTER (WHERE NOT (line ~ '^\s*>.*'
           OR (line ~ '^\s*On .*wrote:\s*$' AND coalesce(follows ~ '^\s*>.*', false)))), E'\n ') AS content
  FROM (SELECT *, lead(line) OVER (PARTITION BY id ORDER BY pos) AS follows FROM lines) GROUP BY id),
placed AS (
  SELECT m.conv_id, m.turn, m.role, coalesce(s.content, '') AS content,
         row_number() OVER (PARTITION BY m.conv_id ORDER BY m.turn, m.role, m.text) - 1 AS position,
         coalesce(q.source, max(m.turn) OVER (PARTITION BY m.conv_id ORDER BY m.turn
           RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS reply_to,
         coalesce(q.quoted, 0) AS quoted, coalesce(q.linked, 0) AS linked
  FROM messages m LEFT JOIN shown s ON s.id = m.id
  LEFT JOIN quoting q ON q.conv_id IS NOT DISTINCT FROM m.conv_id AND q.turn IS NOT DISTINCT FROM m.turn)
SELECT conv_id, CAST(position // 256 AS BIGINT) AS segment, count(*) AS n_messages,
       CAST(sum(quoted) AS BIGINT) AS n_quoted, CAST(sum(linked) AS BIGINT) AS n_linked,
       string_agg(turn || '<' || coalesce(CAST(reply_to AS VARCHAR), ''), ',' ORDER BY position) AS replies,
       string_agg('<|' || role || '|>' || E'\n' || content, E'\n' ORDER BY position) AS text
FROM placed GROUP BY ALL
"""


@registered("op6_chat_format", SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(format_chats(table(spark, sf_dir, "conversations")))
