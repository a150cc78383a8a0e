"""Chat formatting in budgeted windows, column expressions only.

A conversation becomes one or more windows, each at most ``budget`` tokens
unless a single turn is longer. Prefix sums of the turns' tokens choose the
windows: the running total is divided into cells of ``budget - history``
tokens (less the system turn's). A turn that lies in one cell belongs to that
cell's window; a turn that crosses a cell border is a window of its own. Both
are runs of whole turns in order, and no window's new turns exceed the cell
unless they are one longer turn. The leading system turn is repeated in every
window, and so are the turns that began at most ``history`` tokens before the
window (a RANGE frame over the prefix sums). Only assistant turns that are new
in a window are under its loss mask, so each is a target exactly once.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. ``&``, ``<`` and
``[`` inside texts and roles (line ends too inside roles) are written as
character references, so no control string of this or of the usual bracket
templates (``</s>``, ``[INST]``, ``<<SYS>>``) can occur in a text, and
``unescape`` gives the text back. A turn's tokens are estimated as the
formatted characters divided by ``chars_per_token``, rounded up.

Defined results: null texts and roles count as empty; turns are ordered by
(turn, role, text), null turns first; repeated rows are turns of their own; a
null conversation id is a conversation. An empty table gives no windows. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartstreak.llm.common import quoted, table, text_of

START, END = "<|im_start|>", "<|im_end|>\n"
# The characters that control strings begin with, and the line end that ends a role.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "&#10;")]
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"


def escape(text: Column, pairs=None) -> Column:
    for plain, written in pairs or ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, pairs=None) -> Column:
    for plain, written in reversed(pairs or ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", budget: int = 2048, history: int = 512,
                         chars_per_token: int = 4) -> DataFrame:
    """Windows: conv_id, window, formatted, loss (array of start and length in code points), repeated, n_tokens.

    ``repeated`` is the number of leading turns that earlier windows hold too;
    ``loss`` marks the escaped assistant texts.
    """
    src = turns.select(F.col(quoted(conv_col)).alias("conv_id"), F.col(quoted(turn_col)).alias("turn"),
                       text_of(role_col).alias("role"), text_of(text_col).alias("text"))
    head = F.concat(F.lit(START), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    src = (src.withColumn("head", F.length(head)).withColumn("body", escape(F.col("text")))
           .withColumn("part", F.concat(head, "body", F.lit(END)))
           .withColumn("chars", F.length("part"))
           .withColumn("tokens", F.ceil(F.col("chars") / chars_per_token).cast("long")))
    turn_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = turn_order.rowsBetween(Window.unboundedPreceding, -1)
    src = src.withColumn("n", F.row_number().over(turn_order))
    first = (F.col("n") == 1) & (F.col("role") == SYSTEM_ROLE)
    src = (src.withColumn("system", F.first(F.when(first, F.col("part"))).over(turn_order))
           .withColumn("system_tokens", F.coalesce(F.first(F.when(first, F.col("tokens"))).over(turn_order), F.lit(0)))
           .withColumn("own", F.when(first, F.lit(0)).otherwise(F.col("tokens")))
           .withColumn("begin", F.coalesce(F.sum("own").over(before), F.lit(0))))
    cell = F.greatest(F.lit(1), F.lit(budget - history) - F.col("system_tokens"))
    first_cell = F.floor(F.col("begin") / cell)
    last_cell = F.floor((F.col("begin") + F.greatest(F.col("own"), F.lit(1)) - 1) / cell)
    src = src.withColumn("cell", first_cell * 2 + F.when(first_cell == last_cell, 0).otherwise(1))
    # turns that began up to `history` tokens earlier; the system turn has no tokens here and stays out
    past = Window.partitionBy("conv_id").orderBy("begin").rangeBetween(-history, -1)
    src = src.withColumn("past", F.collect_list(F.when(F.col("own") > 0, F.struct("begin", "part", "tokens"))).over(past))
    in_window = Window.partitionBy("conv_id", "cell").orderBy("n")
    src = src.withColumn("place", F.coalesce(
        F.sum("chars").over(in_window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    target = F.when(F.col("role") == TARGET_ROLE, F.struct(
        (F.col("place") + F.col("head")).alias("start"), F.length("body").alias("length")))
    rows = src.groupBy("conv_id", "cell").agg(
        F.array_sort(F.collect_list(F.struct("n", "part"))).alias("new"),
        F.array_sort(F.collect_list(target)).alias("targets"),
        F.min_by(F.struct("past", "system", "system_tokens", "n"), "n").alias("f"), F.sum("tokens").alias("own_tokens"))
    again = (F.col("f.n") > 1) & F.col("f.system").isNotNull()
    past_parts = F.transform("f.past", lambda p: p["part"])
    lead = F.concat(F.when(again, F.col("f.system")).otherwise(""), F.array_join(past_parts, ""))
    rows = (rows.withColumn("lead", lead)
            .withColumn("repeated", F.size("f.past") + again.cast("int"))
            .withColumn("n_tokens", F.col("own_tokens") + F.when(again, F.col("f.system_tokens")).otherwise(0)
                        + F.aggregate("f.past", F.lit(0).cast("long"), lambda a, p: a + p["tokens"])))
    shift = F.length("lead")
    return rows.select(
        "conv_id", F.col("cell").alias("window"),
        F.concat("lead", F.array_join(F.transform("new", lambda t: t["part"]), "")).alias("formatted"),
        F.transform("targets", lambda t: F.struct((t["start"] + shift).alias("start"), t["length"].alias("length")))
        .alias("loss"), "repeated", "n_tokens")


def read_turns(formatted: Column, repeated: Column) -> Column:
    """array<struct<role, text>> of a window's new turns, unescaped."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>", -1), repeated + 2, F.length(formatted) + 1)

    def turn(part):
        at = F.locate("\n", part)
        role = F.substring(part, F.lit(1), at - 1)
        text = F.substring(part, at + 1, F.length(part) - at - len(END))
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(text).alias("text"))
    return F.transform(parts, turn)


def read_targets(formatted: Column, loss: Column) -> Column:
    """array<string> of the unescaped texts under a window's loss mask."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: turns, text under the loss mask, characters."""
    turns = read_turns(F.col("formatted"), F.col("repeated"))
    lined = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = windows.select("conv_id", "window", F.size(turns).alias("n"), lined.alias("lined"),
                          F.array_join(read_targets(F.col("formatted"), F.col("loss")), "").alias("targets"),
                          F.length("formatted").cast("long").alias("chars"))
    parts = F.array_sort(F.collect_list(F.struct("window", "lined", "targets")))
    whole = rows.groupBy("conv_id").agg(parts.alias("parts"), F.sum("n").alias("n_turns"),
                                        F.sum("chars").alias("formatted_chars"))
    all_turns = F.array_join(F.transform("parts", lambda p: p["lined"]), "")
    all_targets = F.array_join(F.transform("parts", lambda p: p["targets"]), "")
    return whole.select("conv_id", "n_turns", F.sha2(all_turns, 256).alias("turns_sha256"),
                        F.length(all_targets).cast("long").alias("loss_chars"),
                        F.sha2(all_targets, 256).alias("loss_sha256"), "formatted_chars")


TRICKY = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    tricky = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                   F.lit(TRICKY).alias("text"))
    return conversation_digests(format_conversations(turns.unionByName(tricky)))


OP2_SQL = f"""
with src as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '{TRICKY}'), (-1, 1, 'assistant', '{TRICKY}')),
sized as (
  select *, row_number() over w as n,
         12 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;'))
         + 1 + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + 11 as chars
  from src window w as (partition by conv_id order by turn, role, text)),
sys as (select conv_id, chars as sys_chars, cast(ceil(chars / 4.0) as bigint) as sys_tokens
        from sized where n = 1 and role = 'system'),
prefix as (
  select s.*, coalesce(sys_chars, 0) as sys_chars, 1536 - coalesce(sys_tokens, 0) as cell,
         case when n = 1 and role = 'system' then 0 else cast(ceil(chars / 4.0) as bigint) end as own
  from sized s left join sys using (conv_id)),
begun as (
  select *, cast(sum(own) over (partition by conv_id order by n) as bigint) - own as pos, greatest(cell, 1) as c
  from prefix),
celled as (
  select *, 2 * (pos // c) + (pos // c <> (pos + greatest(own, 1) - 1) // c)::int as win from begun),
heads as (
  select conv_id, win, min(n) as n, min(pos) as pos, any_value(sys_chars) as sys_chars from celled group by all),
again as (
  select h.conv_id, sum(t.chars) as chars from heads h join celled t
  on t.conv_id = h.conv_id and t.own > 0 and t.pos between h.pos - 512 and h.pos - 1 group by 1),
led as (select conv_id, sum(case when n > 1 then sys_chars else 0 end) as chars from heads group by 1)
select s.conv_id, count(*) as n_turns,
       sha256(string_agg(s.role || chr(10) || s.text || chr(10), '' order by s.n)) as turns_sha256,
       cast(coalesce(sum(length(s.text)) filter (s.role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(s.text, '' order by s.n) filter (s.role = 'assistant'), '')) as loss_sha256,
       cast(sum(s.chars) + coalesce(any_value(a.chars), 0) + any_value(l.chars) as bigint) as formatted_chars
from sized s join led l using (conv_id) left join again a using (conv_id) group by s.conv_id"""
