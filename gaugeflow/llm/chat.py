"""Chat formatting with a grammar round trip, in DataFrame functions only.

Template (grammar), one rule per role, without anything between turns::

    user       [INST] text [/INST]
    assistant  <s>text</s>
    any other  <<role>>\\ntext\\n<</role>>

A deterministic parser reads turns back: at each place the opening mark tells
the rule, and the turn ends at the first closing mark of that rule. Texts are
first rendered as they are, always decoded when read; a text that holds a mark
of any rule, or whose own round trip does not return its role and text, is
escaped (``&``, ``<`` and ``[`` as character references), after which no mark
can stand inside. Each whole
conversation is then parsed again and compared with its source; should any
differ, all its turns are escaped.

Defined results:

* null text: empty; null role: an empty role name (``<<>>``);
* turns are ordered by turn, nulls first, then role and text, so repeated
  rows all stay, in a defined order; a null conv_id is one conversation;
* a conversation without assistant turns: nothing under the loss mask;
* empty table: only the added conversations; other columns are ignored.

A conversation is one output text, so its turns meet in one row; that row is
bounded by the size of a conversation, not by the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import pick, stage

# (character, its reference), in the order of escaping.
REFERENCES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]
# What marks begin with, in texts of whatever role.
CONTROL = r"\[/?INST\]|</?s>|<<"
SEGMENT = r"(?s)\G(?:\[INST\] .*? \[/INST\]|<s>.*?</s>|<<([^<>]*)>>\n.*?\n<</\1>>)"


def escape(text: Column) -> Column:
    for plain, ref in REFERENCES:
        text = F.replace(text, F.lit(plain), F.lit(ref))
    return text


def unescape(text: Column) -> Column:
    for plain, ref in reversed(REFERENCES):
        text = F.replace(text, F.lit(ref), F.lit(plain))
    return text


def _role_name(role: Column) -> Column:
    """Role names are always escaped, ``>`` too, so any name can be a mark."""
    return F.replace(escape(role), F.lit(">"), F.lit("&gt;"))


def render(role: Column, text: Column) -> Column:
    """One turn in the template; ``text`` already escaped if need be."""
    name = _role_name(role)
    return (F.when(role == "user", F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
            .when(role == "assistant", F.concat(F.lit("<s>"), text, F.lit("</s>")))
            .otherwise(F.concat(F.lit("<<"), name, F.lit(">>\n"), text, F.lit("\n<</"), name, F.lit(">>"))))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation, as an array of (role, text)."""
    def turn(s: Column) -> Column:
        name = F.regexp_extract(s, "^<<([^<>]*)>>", 1)
        cut = F.char_length(name)
        role = (F.when(F.startswith(s, F.lit("[INST] ")), F.lit("user")).when(F.startswith(s, F.lit("<s>")), F.lit("assistant"))
                .otherwise(unescape(F.replace(name, F.lit("&gt;"), F.lit(">")))))
        text = (F.when(role == "user", F.substring(s, F.lit(8), F.char_length(s) - 15))
                .when(role == "assistant", F.substring(s, F.lit(4), F.char_length(s) - 7))
                .otherwise(F.substring(s, cut + 6, F.char_length(s) - 2 * cut - 11)))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(SEGMENT), F.lit(0)), turn)


def format_chats(conversations: DataFrame) -> DataFrame:
    """A row per conversation: ``conv_id``, ``formatted`` (the template text),
    ``source`` and ``turns`` (arrays of role and text: as given and as read
    back from ``formatted``) and ``exact`` (both equal)."""
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # Turn by turn: does the unescaped rendering come back as it was?
    alone = parse(render(F.col("role"), F.col("text")))
    rows = rows.withColumn("back", alone).withColumn("safe", (F.size("back") == 1) & (
        F.get("back", F.lit(0))["role"] == F.col("role")) & (F.get("back", F.lit(0))["text"] == F.col("text")) & ~F.rlike(
            "text", F.lit(CONTROL)))
    turns = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "safe"))),
                        lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"), x["safe"].alias("safe")))
    convs = stage(rows.groupBy("conv_id").agg(turns.alias("t")), "chat-turns")

    def whole(force: bool) -> Column:
        return F.array_join(F.transform("t", lambda x: render(x["role"], escape(x["text"]) if force else F.when(
            x["safe"], x["text"]).otherwise(escape(x["text"])))), "")

    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    convs = convs.select("conv_id", source.alias("source"), whole(False).alias("first"), whole(True).alias("second"))
    convs = convs.withColumn("formatted", F.when(parse(F.col("first")) == F.col("source"), F.col("first")).otherwise(F.col("second")))
    return convs.withColumn("turns", parse(F.col("formatted"))).select(
        "conv_id", "formatted", "source", "turns", (F.col("turns") == F.col("source")).alias("exact"))


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests of the turns read back from the formatted text."""
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda x: x["role"] == "assistant"), lambda x: x["text"]), "")
    return chats.withColumns({"_said": said, "_loss": loss}).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2("_said", 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
names AS (
  SELECT *, replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), '>', '&gt;') AS name,
         replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS escaped,
         replace(replace(replace(text, '&#91;', '['), '&lt;', '<'), '&amp;', '&') <> text AS refs FROM rows),
marks AS (
  SELECT *, CASE role WHEN 'user' THEN '[INST] ' WHEN 'assistant' THEN '<s>' ELSE '<<' || name || '>>' || chr(10) END AS a,
         CASE role WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN '</s>' ELSE chr(10) || '<</' || name || '>>' END AS b
  FROM names),
turns AS (
  SELECT *, a || CASE WHEN refs OR strpos(text || b, b) <> length(text) + 1 OR regexp_matches(text, '\[/?INST\]|</?s>|<<')
                          THEN escaped ELSE text END || b AS f FROM marks)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(f))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
