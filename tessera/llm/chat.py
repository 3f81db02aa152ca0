"""Operator 4: chat formatting with a grammar round trip.

A conversation is rendered as ``<s>role[INST]text[/INST]</s>`` for each turn,
one after the other. A deterministic parser reads the rendered string back: a
turn ends at the first ``[/INST]</s>``, its role at the first ``[INST]``, no
control string may be inside either, and one backslash is taken out of every
escaped one. The recovered turns are compared with the source; a conversation that does not come back
identical is rendered again with its control strings escaped, in which form it
does, because escaping n backslashes gives n+1 and the parser takes one away.
``verified`` says that the accepted string was read back to the source.

Everything is DataFrame expressions; turns meet their conversation by one
shuffle on its id and are escaped before it.

Defined results: null role or text -> empty; turns in order of (turn, role,
text); rows that repeat a turn are all rendered; a null conv_id is a
conversation of its own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Control strings of the template (fixed values).
OPEN, TEXT, END_TEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
#: A control string, possibly with backslashes behind its first character.
_CONTROL = r"(<|\[)(\\*)(/?s>|/?INST\])"
_ESCAPED = r"(<|\[)\\(\\*)(/?s>|/?INST\])"
_RAW = r"(<|\[)(/?s>|/?INST\])"
_TURN = r"(?s)<s>(.*?)\[INST\](.*?)\[/INST\]</s>"

LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(TEXT), text, F.lit(END_TEXT + CLOSE))


def parse(formatted: Column) -> Column:
    """Turns of a rendered string: array<struct<role, text>>. The grammar has no
    control string inside a role or text: such a one is read as null."""
    roles = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))

    def read(field: Column) -> Column:
        return F.when(~field.rlike(_RAW), unescape(field))

    return F.transform(F.arrays_zip(roles.alias("role"), texts.alias("text")), lambda t: F.struct(read(t["role"]).alias("role"), read(t["text"]).alias("text")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start and length, in characters, of each
    learned text in ``formatted``), escaped, verified."""
    empty = F.lit("")
    rows = turns.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    rows = rows.withColumn("safe_role", escape(F.col("role"))).withColumn("safe_text", escape(F.col("text")))
    # escaped strings are sent only where they differ
    rows = rows.withColumn("safe", F.when((F.col("safe_role") != F.col("role")) | (F.col("safe_text") != F.col("text")), F.struct("safe_role", "safe_text")))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "safe"))).alias("turns"))
    plain = F.array_join(F.transform("turns", lambda t: _render(t["role"], t["text"])), "")
    grouped = grouped.withColumn("plain", plain)
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    first = grouped.withColumn("as_is", parse(F.col("plain")) == source)
    chosen = F.transform("turns", lambda t: F.when(F.col("as_is") | t["safe"].isNull(), F.struct(t["role"].alias("role"), t["text"].alias("text")))
                         .otherwise(F.struct(t["safe"]["safe_role"].alias("role"), t["safe"]["safe_text"].alias("text"))))
    second = first.withColumn("sent", chosen).withColumn(
        "formatted", F.when(F.col("as_is"), F.col("plain")).otherwise(F.array_join(F.transform("sent", lambda t: _render(t["role"], t["text"])), "")))
    verified = F.col("as_is") | (parse(F.col("formatted")) == source)
    around = len(OPEN + TEXT + END_TEXT + CLOSE)
    # where each turn starts: running total over the lengths before it
    starts = F.aggregate("sent", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
                         lambda s, t: F.struct((s["at"] + around + F.length(t["role"]) + F.length(t["text"])).alias("at"),
                                               F.concat(s["starts"], F.array(s["at"] + len(OPEN + TEXT) + F.length(t["role"]))).alias("starts")))["starts"]
    spans = F.transform(F.filter(F.arrays_zip("sent", F.col("starts")), lambda z: z["sent"]["role"] == LEARNED_ROLE),
                        lambda z: F.struct(z["starts"].alias("start"), F.length(z["sent"]["text"]).alias("length")))
    return (second.withColumn("starts", starts)
            .select("conv_id", "formatted", spans.alias("loss_spans"), (~F.col("as_is")).alias("escaped"), verified.alias("verified")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what a rendered string holds: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars, escaped, verified."""
    turns = formatted.withColumn("turns", parse(F.col("formatted"))).withColumn(
        "learned", F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), ""))
    listing = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listing, 256).alias("turns_sha256"),
                        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"), "escaped", "verified")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts consist of control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")


ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
safe AS (
  SELECT *, regexp_replace(role, '(<|\\[)(\\\\*)(/?s>|/?INST\\])', '\\1\\\\\\2\\3', 'g') AS r, regexp_replace(text, '(<|\\[)(\\\\*)(/?s>|/?INST\\])', '\\1\\\\\\2\\3', 'g') AS t FROM turns),
conv AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS listing,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
    bool_or(r <> role OR t <> text) AS escaped,
    sum(length(role) + length(text) + 20) AS plain, sum(length(r) + length(t) + 20) AS safe
  FROM safe GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(listing) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  CAST(CASE WHEN escaped THEN safe ELSE plain END AS BIGINT) AS formatted_chars, escaped, true AS verified FROM conv"""
