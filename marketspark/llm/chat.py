"""Quotation linking: who answers whom in a conversation, from quoted passages; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import prepare, stage, text_or_empty

#: Digits of a turn in the order key, so that text order is number order.
TURN_DIGITS = 12


def _normal(text: Column) -> Column:
    """Letters and digits in lower case, one space between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _line(raw: Column) -> Column:
    """(level, body): how many marks open the line, and what follows them."""
    marks = F.regexp_extract(raw, r"^((?:[ \t]*>)*)", 1)
    return F.struct(F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
                    F.regexp_replace(raw, r"^(?:(?:[ \t]*>)+[ \t]?)?", "").alias("body"))


def parsed(messages: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """``messages`` with content, n_quoted, and the normalised units it says and quotes.

    A passage is a run of lines of one level. A message says its whole text, each passage and each line of level 0; it quotes each
    passage and each line of the other levels. A line that ends in a colon before a quoted line introduces it and is dropped.
    """
    lines = F.transform(F.split(text_or_empty(text), "\n"), _line)
    df = messages.withColumn("_l", lines)
    size = F.size("_l")
    at = lambda i: F.get(F.col("_l"), i)
    own = F.filter("_l", lambda x, i: (x["level"] == 0) & ~(
        (i + 1 < size) & (F.coalesce(at(i + 1)["level"], F.lit(0)) > 0) & F.rtrim(x["body"]).endswith(":")))
    starts = F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (at(i)["level"] != at(i - 1)["level"]))
    df = df.withColumn("_own", F.transform(own, lambda x: x["body"])).withColumn("_s", starts)
    runs = F.transform("_s", lambda s, k: F.slice(
        "_l", s + 1, F.coalesce(F.get("_s", k + 1), size) - s))
    joined = lambda run: _normal(F.array_join(F.transform(run, lambda x: x["body"]), " "))
    df = df.withColumn("_r", runs)
    said = F.concat(
        F.array(_normal(F.array_join("_own", " "))), F.transform("_own", _normal),
        F.transform(F.filter("_r", lambda r: F.get(r, 0)["level"] == 0), joined))
    quoted = F.concat(
        F.transform(F.filter("_r", lambda r: F.get(r, 0)["level"] > 0), lambda r: F.struct(
            F.get(r, 0)["level"].alias("level"), joined(r).alias("unit"))),
        F.transform(F.filter("_l", lambda x: x["level"] > 0), lambda x: F.struct(
            x["level"].alias("level"), _normal(x["body"]).alias("unit"))))
    return df.withColumns({
        "content": F.regexp_replace(F.array_join("_own", "\n"), r"^\s+|\s+$", ""),
        "n_quoted": F.size(F.filter("_l", lambda x: x["level"] > 0)).cast("long"),
        "_said": F.array_distinct(said), "_quoted": F.array_distinct(quoted)}).drop("_l", "_own", "_s", "_r")


def replies(said: DataFrame) -> DataFrame:
    """(conv, turn, parent): for each turn that quotes, the earlier turn it answers, from (conv, turn, _said, _quoted).

    A unit's original is the first turn of the conversation that says it: one row per unit after a pre-aggregated minimum, so a
    passage that everyone repeats or quotes joins to one row. The parent is the original of the shallowest level, then of most
    units, then the latest.
    """
    hashed = [F.xxhash64("unit").alias("h"), F.length("unit").alias("n")]
    first = said.select("conv", "turn", F.explode("_said").alias("unit")).where("unit <> ''").select(
        "conv", "turn", *hashed).groupBy("conv", "h", "n").agg(F.min("turn").alias("parent"))
    quotes = said.select("conv", "turn", F.explode("_quoted").alias("q")).select(
        "conv", "turn", "q.level", F.col("q.unit").alias("unit")).where("unit <> ''").select(
        "conv", "turn", "level", *hashed)
    links = quotes.join(first, ["conv", "h", "n"]).where("parent < turn").groupBy(
        "conv", "turn", "level", "parent").agg(F.count("*").alias("units"))
    best = F.min(F.struct("level", (-F.col("units")).alias("u"), (-F.col("parent")).alias("p"), "parent"))
    return links.groupBy("conv", "turn").agg(best.alias("b")).select("conv", "turn", "b.parent")


def paths(links: DataFrame) -> DataFrame:
    """(conv, turn, path): turns from the thread's first message down to each that answers one, from (conv, turn, parent).

    Pointers double: a round joins every path to that of the message it starts from, so a thread of depth d takes log2(d)
    rounds, each one written out.
    """
    own = lambda c: F.lpad(F.col(c).cast("string"), TURN_DIGITS, "0")
    now = stage(links.select("conv", "turn", F.col("parent").alias("top"), own("turn").alias("path")), "paths")
    # A top that answers nobody is the first message.
    while True:
        up = now.select("conv", F.col("turn").alias("top"), F.col("top").alias("above"), F.col("path").alias("head"))
        joined = now.join(up, ["conv", "top"], "left")
        more = joined.select("conv", "turn", F.coalesce("above", "top").alias("top"), F.when(
            F.col("above").isNotNull(), F.concat_ws(".", "head", "path")).otherwise(F.col("path")).alias("path"),
            F.col("above").isNotNull().alias("moved"))
        more = stage(more, "paths")
        if more.where("moved").isEmpty():
            return more.select("conv", "turn", F.concat_ws(".", own("top"), "path").alias("path"))
        now = more.drop("moved")


def conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_col, turn_col, role_col, content, reply_to, depth, order_key, n_quoted): one row per message, without quotes.

    Sorting a conversation by ``order_key`` puts every message after the one it answers, in reply order; a message that quotes no
    earlier one starts a thread at its turn. Rows of equal conversation and turn count as one message said in several rows. NULL text
    counts as empty; rows with NULL conversation or turn are returned unlinked, with an empty key for a NULL turn. An empty table
    gives no rows; other columns are ignored.
    """
    prepare(messages.sparkSession)
    slim = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                           F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    said = stage(parsed(slim, "conv", "turn", "text"), "messages")
    links = stage(replies(said.select("conv", "turn", "_said", "_quoted")), "replies")
    placed = links.join(paths(links), ["conv", "turn"])
    own = F.coalesce(F.lpad(F.col("turn").cast("string"), TURN_DIGITS, "0"), F.lit(""))
    return said.join(placed, ["conv", "turn"], "left").select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "content",
        F.col("parent").alias("reply_to"),
        F.coalesce(F.size(F.split("path", r"\.")) - 1, F.lit(0)).cast("long").alias("depth"),
        F.coalesce("path", own).alias("order_key"), "n_quoted")


ORACLE = rf"""
WITH RECURSIVE l AS (
  SELECT m.*, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {{
    'level': length(regexp_replace(regexp_extract(x, '^((?:[ \t]*>)*)', 1), '[^>]', '', 'g')),
    'body': regexp_replace(x, '^(?:(?:[ \t]*>)+[ \t]?)?', '')}}) AS l FROM conversations m),
o AS (SELECT *, list_filter(l, lambda x, i: x.level = 0 AND NOT (
        i < len(l) AND coalesce(l[i + 1].level, 0) > 0 AND rtrim(x.body) LIKE '%:')) AS own,
      list_filter(range(1, len(l) + 1), lambda i: i = 1 OR l[i].level <> l[i - 1].level) AS s FROM l),
r AS (SELECT *, list_transform(s, lambda b, k: list_slice(l, b, coalesce(s[k + 1] - 1, len(l)))) AS r FROM o),
units AS (SELECT conv_id, turn, own,
    list_concat(list_concat([list_aggregate(list_transform(own, lambda x: x.body), 'string_agg', ' ')],
      list_transform(own, lambda x: x.body)),
      list_transform(list_filter(r, lambda p: p[1].level = 0), lambda p: list_aggregate(list_transform(p, lambda x: x.body), 'string_agg', ' '))) AS said,
    list_concat(list_transform(list_filter(r, lambda p: p[1].level > 0), lambda p: {{'level': p[1].level, 'unit':
        list_aggregate(list_transform(p, lambda x: x.body), 'string_agg', ' ')}}),
      list_transform(list_filter(l, lambda x: x.level > 0), lambda x: {{'level': x.level, 'unit': x.body}})) AS quoted FROM r),
said AS (SELECT conv_id, min(turn) AS parent, unit FROM (SELECT conv_id, turn,
    trim(regexp_replace(lower(unnest(said)), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS unit FROM units) WHERE unit <> '' GROUP BY ALL),
quoted AS (SELECT DISTINCT conv_id, turn, q.level AS level, trim(regexp_replace(lower(q.unit), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS unit
    FROM (SELECT conv_id, turn, unnest(quoted) AS q FROM units)),
votes AS (SELECT q.conv_id, q.turn, level, parent, count(*) AS n FROM quoted q JOIN said s ON q.conv_id = s.conv_id AND q.unit = s.unit
    WHERE q.unit <> '' AND parent < q.turn GROUP BY ALL),
links AS (SELECT conv_id, turn, parent FROM votes
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, parent DESC) = 1),
tree AS (SELECT DISTINCT c.conv_id, c.turn, CAST(NULL AS BIGINT) AS parent, 0 AS depth, lpad(CAST(c.turn AS VARCHAR), {TURN_DIGITS}, '0') AS k
    FROM conversations c ANTI JOIN links USING (conv_id, turn)
  UNION ALL SELECT l.conv_id, l.turn, l.parent, t.depth + 1, t.k || '.' || lpad(CAST(l.turn AS VARCHAR), {TURN_DIGITS}, '0')
    FROM links l JOIN tree t ON l.conv_id = t.conv_id AND l.parent = t.turn)
SELECT o.conv_id, o.turn, o.role,
  regexp_replace(coalesce(list_aggregate(list_transform(own, lambda x: x.body), 'string_agg', chr(10)), ''), '^\s+|\s+$', '', 'g') AS content,
  parent AS reply_to, CAST(depth AS BIGINT) AS depth, k AS order_key,
  CAST(len(list_filter(l, lambda x: x.level > 0)) AS BIGINT) AS n_quoted
FROM o JOIN tree t ON o.conv_id = t.conv_id AND o.turn = t.turn"""
