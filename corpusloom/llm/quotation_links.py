"""Quotation linking: from messages that quote each other to reply-ordered conversations without quotes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

LINE = re.compile(r"\r\n|\r|\n")
QUOTE = re.compile(r"[ \t]*((>[ \t]?)+)")
BLANKS = re.compile(r"[ \t\r\f]+")
ATTRIBUTION = re.compile(r"\s*on .+ wrote:\s*", re.IGNORECASE)
ENDS = " \t\r\n\f"

_PARSED = "conv bigint, turn bigint, role string, own string, sources array<binary>, asked array<struct<level:int,n:int,hash:binary>>"
_ASKED = pa.list_(pa.struct([("level", pa.int32()), ("n", pa.int32()), ("hash", pa.binary())]))


def parse_message(text: str | None) -> tuple[str, list[bytes], list[dict]]:
    """(own text, hashes of own passages, quoted passages as level, length and hash) of a message, in one pass over its lines.

    A line's level is its number of quote marks. Passages are normalised: lower case, single blanks, empty lines left out. Own
    passages are the whole own text, its runs of lines between quotes, and its lines; quoted ones the runs of lines of one level,
    and their lines. The own text lacks quotes and an attribution line ("On ... wrote:") just before one, and is trimmed.
    """
    own: list[str] = []
    runs: list[tuple[int, list[str]]] = []
    for line in LINE.split(text or ""):
        m = QUOTE.match(line)
        level, body = (m.group(1).count(">"), line[m.end() :]) if m else (0, line)
        if not runs or runs[-1][0] != level:
            if level and runs and runs[-1][0] == 0 and ATTRIBUTION.fullmatch(own[-1]):
                own.pop()
            runs.append((level, []))
        if not level:
            own.append(body)
        norm = BLANKS.sub(" ", body).strip(" ").lower()
        if norm:
            runs[-1][1].append(norm)
    told = {" ".join(x for level, lines in runs if not level for x in lines), *(" ".join(lines) for level, lines in runs if not level), *(x for level, lines in runs if not level for x in lines)}
    asked = {(level, p) for level, lines in runs if level for p in (" ".join(lines), *lines)}
    key = lambda p: md5(p.encode()).digest()
    return "\n".join(own).strip(ENDS), [key(p) for p in sorted(told) if p], [{"level": level, "n": len(p), "hash": key(p)} for level, p in sorted(asked) if p]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 512):
            part = b.slice(lo, 512)
            own, sources, asked = zip(*map(parse_message, part.column(3).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(own, pa.string()), pa.array(sources, pa.list_(pa.binary())), pa.array(asked, _ASKED)], ["conv", "turn", "role", "own", "sources", "asked"])


def quote_links(parsed: DataFrame) -> DataFrame:
    """(conv, turn, parent): the message that each quoting message replies to.

    Quoted and own passages meet by their hash within a conversation: for each quoted one the latest earlier message that holds
    it is found by a running maximum over the passage's messages in order of turn, so no pairs are made. Of these, the parent is
    the one quoted at the lowest level, then by the longest passage, then the latest.
    """
    told = parsed.select("conv", F.explode("sources").alias("hash"), "turn", F.lit(1).alias("is_source"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("int").alias("n"))
    asked = parsed.select("conv", "turn", F.explode("asked").alias("q")).select("conv", "q.hash", "turn", F.lit(0).alias("is_source"), "q.level", "q.n")
    w = Window.partitionBy("conv", "hash").orderBy("turn", "is_source").rowsBetween(Window.unboundedPreceding, -1)
    hits = told.union(asked).withColumn("source", F.max(F.when(F.col("is_source") == 1, F.col("turn"))).over(w)).where("is_source = 0 and source is not null")
    best = F.max(F.struct((-F.col("level")).alias("l"), "n", "source"))
    return hits.groupBy("conv", "turn").agg(best.alias("best")).select("conv", "turn", F.col("best.source").alias("parent"))


def _reply_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[tuple[int, int, int, int, int]] = []
        for conv, members in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            children: dict[int | None, list[int]] = {}
            parent = {}
            for m in sorted(members, key=lambda m: m["turn"]):
                parent[m["turn"]] = m["parent"]
                children.setdefault(m["parent"], []).append(m["turn"])
            stack = [(t, 0) for t in reversed(children.get(None, []))]
            at = 0
            while stack:
                t, depth = stack.pop()
                out.append((conv, t, t if parent[t] is None else parent[t], at, depth))
                at += 1
                stack += [(c, depth + 1) for c in reversed(children.get(t, []))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["o_conv", "o_turn", "parent_turn", "position", "depth"])


def _up(t: DataFrame, *values: str) -> DataFrame:
    """Each row's ancestor as a side to join: (u_conv, u_turn, u_anc, u_<values>)."""
    return t.select(F.col("conv").alias("u_conv"), F.col("turn").alias("u_turn"), F.col("anc").alias("u_anc"), *(F.col(v).alias(f"u_{v}") for v in values))


def _reply_order_by_doubling(tree: DataFrame) -> DataFrame:
    """What _reply_order() gives, of (conv, turn, parent) rows of conversations of any size.

    Ancestors at distance 1, 2, 4, ... give every message's depth and the size of its subtree; a message's place is one after its
    parent's, beyond the subtrees of its earlier siblings, and these distances are summed up along ancestors in the same way.
    Rounds grow with the logarithm of the depth; each is written to the shared folder.
    """
    t = tree.select("conv", "turn", "parent", F.col("parent").alias("anc"), F.col("parent").isNotNull().cast("bigint").alias("depth"), F.lit(1).cast("bigint").alias("size"))
    above = lambda t: (F.col("conv") == F.col("u_conv")) & (F.col("anc") == F.col("u_turn"))
    while not t.where("anc is not null").isEmpty():
        below = t.where("anc is not null").groupBy(F.col("conv").alias("b_conv"), F.col("anc").alias("b_turn")).agg(F.sum("size").alias("more"))
        wide = t.join(below, (F.col("conv") == F.col("b_conv")) & (F.col("turn") == F.col("b_turn")), "left").join(_up(t, "depth"), above(t), "left")
        t = materialize(wide.select("conv", "turn", "parent", F.col("u_anc").alias("anc"), (F.col("depth") + F.coalesce("u_depth", F.lit(0))).alias("depth"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
    earlier = F.sum("size").over(Window.partitionBy("conv", "parent").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    t = materialize(t.select("conv", "turn", "parent", F.col("parent").alias("anc"), "depth", (F.coalesce(earlier, F.lit(0)) + F.col("parent").isNotNull().cast("bigint")).alias("at")))
    while not t.where("anc is not null").isEmpty():
        t = materialize(t.join(_up(t, "at"), above(t), "left").select("conv", "turn", "parent", F.col("u_anc").alias("anc"), "depth", (F.col("at") + F.coalesce("u_at", F.lit(0))).alias("at")))
    return t.select(F.col("conv").alias("o_conv"), F.col("turn").alias("o_turn"), F.coalesce("parent", "turn").alias("parent_turn"), F.col("at").alias("position"), "depth")


def link_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", task_messages: int = 1_000_000) -> DataFrame:
    """(conv_id, position, turn, parent_turn, depth, role, text): every message in reply order, without what it quotes.

    Parents come from quote_links(); they are looked for in the message's own conversation. A message without a parent starts a
    thread; replies follow their parent depth first, by turn; parent_turn of a message that starts a thread is its own turn. text
    is the message's own lines (parse_message()). A conversation of up to task_messages messages is put in order by one task,
    a greater one by rounds over all of them.

    Messages of a null conversation or turn are left out. Of rows that repeat a conversation and turn, the least by (role,
    text) stays. Null and empty texts, and messages that hold quotes only, have the text ''. A quote of nothing earlier
    in its conversation links nothing. Of equally good parents the latest wins. Ids and turns are whole numbers. Other columns are
    not looked at. An empty table gives no rows.
    """
    picked = messages.select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    one = picked.where("conv is not null and turn is not null").groupBy("conv", "turn").agg(F.min(F.struct("role", "text")).alias("m")).select("conv", "turn", "m.role", "m.text")
    parsed = materialize(one.mapInArrow(_parse, _PARSED))
    large = parsed.groupBy(F.col("conv").alias("l_conv")).agg(F.count("*").alias("n")).where(F.col("n") > task_messages).drop("n")
    tree = parsed.select("conv", "turn").join(quote_links(parsed), ["conv", "turn"], "left")
    some_large = not large.isEmpty()
    if some_large:
        tree = materialize(tree)
    small = tree.join(large, F.col("conv") == F.col("l_conv"), "left_anti") if some_large else tree
    ordered = small.groupBy("conv").agg(F.collect_list(F.struct("turn", "parent")).alias("members")).mapInArrow(_reply_order, "o_conv bigint, o_turn bigint, parent_turn bigint, position bigint, depth bigint")
    if some_large:
        ordered = ordered.unionByName(_reply_order_by_doubling(tree.join(large, F.col("conv") == F.col("l_conv"), "left_semi")))
    joined = parsed.select("conv", "turn", "role", "own").join(ordered, (F.col("conv") == F.col("o_conv")) & (F.col("turn") == F.col("o_turn")))
    return joined.select(F.col("conv").alias("conv_id"), "position", "turn", "parent_turn", "depth", "role", F.col("own").alias("text"))


def with_quotes(messages: DataFrame) -> DataFrame:
    """messages, whose table holds no quotes, as their writers' programs would have sent them: each third turn quotes the message
    before it, each third that one and (at level 2) the one before, and each third the first line of the conversation."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    before, second, first = F.lag("text", 1).over(w), F.lag("text", 2).over(w), F.substring_index(F.first("text").over(w), "\n", 1)
    quoted = lambda c, mark: F.concat(F.lit(mark), F.replace(c, F.lit("\n"), F.lit("\n" + mark)), F.lit("\n"))
    kind = F.col("turn") % 3
    text = (
        F.when(kind == 1, F.concat(F.lit("On a day they wrote:\n"), quoted(before, "> "), "text"))
        .when(kind == 2, F.concat(quoted(second, ">> "), quoted(before, "> "), "text"))
        .when(F.col("turn") > 0, F.concat(quoted(first, "> "), "text"))
    )
    return messages.withColumn("text", F.coalesce(text, "text"))


def op5_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_conversations(with_quotes(table(spark, sf_dir, "conversations")))


QUERIES = {"op5_quotation_linking": op5_quotation_linking}
ORACLE_SQL = {
    "op5_quotation_linking": r"""
WITH RECURSIVE quoting AS (
  SELECT conv_id, turn, role, coalesce(CASE
    WHEN turn % 3 = 1 THEN 'On a day they wrote:' || chr(10) || '> ' || replace(lag(text) OVER w, chr(10), chr(10) || '> ') || chr(10) || text
    WHEN turn % 3 = 2 THEN '>> ' || replace(lag(text, 2) OVER w, chr(10), chr(10) || '>> ') || chr(10) || '> ' || replace(lag(text) OVER w, chr(10), chr(10) || '> ') || chr(10) || text
    WHEN turn > 0 THEN '> ' || string_split(first_value(text) OVER w, chr(10))[1] || chr(10) || text END, text) AS text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
one AS (
  SELECT conv_id AS conv, turn, role, text FROM quoting WHERE conv_id IS NOT NULL AND turn IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) = 1),
cut AS (SELECT conv, turn, regexp_split_to_array(coalesce(text, ''), '\r\n|\r|\n') AS parts FROM one),
raw AS (SELECT conv, turn, unnest(range(len(parts))) AS line_no, unnest(parts) AS line FROM cut),
lined AS (
  SELECT conv, turn, line_no, length(regexp_replace(regexp_extract(line, '^[ \t]*((>[ \t]?)+)', 1), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^[ \t]*((>[ \t]?)+)', '') AS body FROM raw),
normed AS (
  SELECT *, lower(trim(regexp_replace(body, '[ \t\r\f]+', ' ', 'g'))) AS norm,
         CASE WHEN level = lag(level) OVER w THEN 0 ELSE 1 END AS turned, lead(level) OVER w AS next_level
  FROM lined WINDOW w AS (PARTITION BY conv, turn ORDER BY line_no)),
lines AS (SELECT *, sum(turned) OVER (PARTITION BY conv, turn ORDER BY line_no) AS run FROM normed),
source AS (
  SELECT conv, turn, string_agg(norm, ' ' ORDER BY line_no) AS passage FROM lines WHERE level = 0 AND norm <> '' GROUP BY conv, turn
  UNION SELECT conv, turn, string_agg(norm, ' ' ORDER BY line_no) FROM lines WHERE level = 0 AND norm <> '' GROUP BY conv, turn, run
  UNION SELECT conv, turn, norm FROM lines WHERE level = 0 AND norm <> ''),
asked AS (
  SELECT conv, turn, level, string_agg(norm, ' ' ORDER BY line_no) AS passage FROM lines WHERE level > 0 AND norm <> '' GROUP BY conv, turn, run, level
  UNION SELECT conv, turn, level, norm FROM lines WHERE level > 0 AND norm <> ''),
links AS (
  SELECT a.conv, a.turn, s.turn AS parent FROM asked a JOIN source s ON a.conv = s.conv AND md5(a.passage) = md5(s.passage) AND s.turn < a.turn
  QUALIFY row_number() OVER (PARTITION BY a.conv, a.turn ORDER BY a.level, length(a.passage) DESC, s.turn DESC) = 1),
tree AS (
  SELECT o.conv, o.turn, o.turn AS parent_turn, 0::BIGINT AS depth, [o.turn] AS path FROM one o ANTI JOIN links l USING (conv, turn)
  UNION ALL
  SELECT l.conv, l.turn, l.parent, t.depth + 1, list_append(t.path, l.turn) FROM links l JOIN tree t ON l.conv = t.conv AND l.parent = t.turn),
own AS (
  SELECT conv, turn, string_agg(body, chr(10) ORDER BY line_no) AS own FROM lines
  WHERE level = 0 AND NOT (coalesce(next_level > 0, false) AND regexp_matches(body, '(?i)^\s*on .+ wrote:\s*$')) GROUP BY conv, turn)
SELECT o.conv AS conv_id, row_number() OVER (PARTITION BY o.conv ORDER BY t.path) - 1 AS position, o.turn, t.parent_turn, t.depth, o.role,
       regexp_replace(coalesce(w.own, ''), '^[ \t\r\n\f]+|[ \t\r\n\f]+$', '', 'g') AS text
FROM one o JOIN tree t ON o.conv = t.conv AND o.turn = t.turn LEFT JOIN own w ON o.conv = w.conv AND o.turn = w.turn
"""
}
