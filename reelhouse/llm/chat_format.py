"""Preference formatting of conversation pairs.

A pair is a chosen and a rejected conversation. The longest common prefix of
whole turns (role and text equal, null equal to null) is the prompt, rendered
once; what follows in each conversation is its completion. A completion comes
with its mask: the spans, in code points, of what is learnt: the text of
assistant turns and the mark that ends the turn. Everything else in it, and the
whole prompt, is masked out. If the prompt is followed by an assistant turn on
both sides, the header of that turn belongs to the prompt, as it is the same.

Turn comparison and assembly work on a pair's turns after they are grouped; a
pair is one training example and as long as its two conversations, which is the
size of the result row itself.

Defined results: turns are ordered by turn number, then role and text; a null
role is rendered as an empty one, a null text likewise, and both still differ
from an empty one when turns are compared; marks inside a text are broken up by
a space after their first character, so that a text cannot end its turn;
repeated rows count once; a pair in which one side has no turns has an empty
prompt; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import table

# The marks of the chat template, fixed values.
START, END = "<|im_start|>", "<|im_end|>"
LEARNT_ROLE = "assistant"


def header(turn: Column) -> Column:
    return F.concat(F.lit(START), safe(turn["role"]), F.lit("\n"))


def safe(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def body(turn: Column) -> Column:
    return F.concat(safe(turn["text"]), F.lit(END + "\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), body(t))), "")


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal in both arrays."""
    n = F.least(F.size(a), F.size(b))
    both = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n),
                      lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    first_other = F.coalesce(F.array_position(both, F.lit(False)).cast("int"), F.lit(0))
    return F.when(first_other == 0, F.size(both)).otherwise(first_other - 1)


def spans(turns: Column, headless: Column) -> Column:
    """Learnt spans [start, end) of the rendered turns; with ``headless`` the
    first turn comes without its header."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"), F.lit(0).alias("n"))

    def step(acc: Column, t: Column) -> Column:
        head = F.when(headless & (acc["n"] == 0), F.lit(0)).otherwise(F.length(header(t)))
        begin = acc["at"] + head
        stop = begin + F.length(body(t))
        learnt = F.array(F.struct(begin.alias("start"), (stop - 1).alias("end")))
        out = F.when(t["role"] == LEARNT_ROLE, F.concat(acc["out"], learnt)).otherwise(acc["out"])
        return F.struct(stop.alias("at"), out.alias("out"), (acc["n"] + 1).alias("n"))

    return F.aggregate(turns, start, step, lambda acc: acc["out"])


def preference_format(pairs: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """``pairs`` (id, chosen, rejected: arrays of turn, role, text) as examples.

    Columns: id, prompt_turns, prompt, chosen, chosen_mask, rejected,
    rejected_mask, same (nothing is left to prefer).
    """
    empty = "array<struct<turn:bigint,role:string,text:string>>"
    a, b, n = F.col("__a"), F.col("__b"), F.col("prompt_turns")
    rest = lambda x: F.slice(x, n + 1, F.greatest(F.size(x) - n, F.lit(0)))
    opens = lambda x: F.coalesce(F.try_element_at(x, n + 1)["role"] == LEARNT_ROLE, F.lit(False))
    ready = (pairs.select(F.col(id_col), F.coalesce("chosen", F.array().cast(empty)).alias("__a"),
                          F.coalesce("rejected", F.array().cast(empty)).alias("__b"))
             .withColumn("prompt_turns", common_turns(a, b))
             .withColumn("__open", opens(a) & opens(b)))
    reply = F.lit(f"{START}{LEARNT_ROLE}\n")

    def completion(x: Column) -> Column:
        whole = render(rest(x))
        return F.when(F.col("__open"), F.substr(whole, F.length(reply) + 1)).otherwise(whole)

    return ready.select(
        id_col, "prompt_turns",
        F.concat(render(F.slice(a, F.lit(1), n)), F.when(F.col("__open"), reply).otherwise(F.lit(""))).alias("prompt"),
        completion(a).alias("chosen"), spans(rest(a), F.col("__open")).alias("chosen_mask"),
        completion(b).alias("rejected"), spans(rest(b), F.col("__open")).alias("rejected_mask"),
        ((F.size(a) == n) & (F.size(b) == n)).alias("same"),
    )


def parroted(turns: DataFrame) -> DataFrame:
    """Preference pairs of plain conversations, by one rule for all.

    Chosen is the conversation. In rejected, assistant turns from a certain one
    on (the conversation's id modulo their number) only repeat the turn before
    them. A conversation without an assistant turn is rejected without its last.
    """
    conv = turns.select(F.col("conv_id").alias("pair_id"), F.struct(
        F.col("turn").cast("bigint").alias("turn"), F.col("role"), F.col("text")).alias("t"))
    whole = conv.groupBy("pair_id").agg(F.array_sort(F.array_distinct(F.collect_list("t"))).alias("chosen"))
    c = F.col("chosen")
    replies = F.filter(F.sequence(F.lit(1), F.size(c)), lambda i: F.element_at(c, i.cast("int"))["role"].eqNullSafe(F.lit(LEARNT_ROLE)))
    from_turn = F.when(F.size(replies) > 0, F.element_at(
        replies, (F.pmod(F.coalesce("pair_id", F.lit(0)), F.size(replies)) + 1).cast("int")))
    echo = F.transform(c, lambda t, i: F.when(
        (t["role"] == LEARNT_ROLE) & (i + 1 >= F.col("__from")) & (i > 0),
        F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.get(c, i - 1)["text"].alias("text"))).otherwise(t))
    return (whole.withColumn("__from", from_turn)
            .withColumn("rejected", F.when(F.col("__from").isNull(), F.slice(c, F.lit(1), F.size(c) - 1)).otherwise(echo))
            .drop("__from"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = parroted(table(spark, sf_dir, "conversations"))
    return preference_format(pairs).withColumnRenamed("pair_id", "conv_id").select(
        "conv_id", "prompt_turns", "prompt", "chosen", "rejected",
        F.transform("chosen_mask", lambda s: F.concat_ws("-", s["start"], s["end"])).alias("chosen_mask"),
        F.transform("rejected_mask", lambda s: F.concat_ws("-", s["start"], s["end"])).alias("rejected_mask"),
        "same",
    ).withColumns({c: F.array_join(c, ",") for c in ("chosen_mask", "rejected_mask")})


#: DuckDB twin of ``query``: turns as rows, one number for each. Written apart from the operator.
SQL = """
with turns as (
  select conv_id, turn, role, text,
         row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as i,
         count(*) over (partition by conv_id) as n
  from (select distinct conv_id, cast(turn as bigint) as turn, role, text from conversations)),
replies as (
  select conv_id, i, row_number() over (partition by conv_id order by i) - 1 as k, count(*) over (partition by conv_id) as m
  from turns where role = 'assistant'),
starts as (select conv_id, i as first_reply from replies where k = ((coalesce(conv_id, 0) % m) + m) % m),
both_sides as (
  select t.conv_id, t.i, t.n, t.role, t.text as chosen_text,
         case when s.first_reply is not null and t.role = 'assistant' and t.i >= s.first_reply and t.i > 1
              then lag(t.text) over (partition by t.conv_id order by t.i) else t.text end as rejected_text,
         case when s.first_reply is null then t.n - 1 else t.n end as n_rejected
  from turns t left join starts s on t.conv_id is not distinct from s.conv_id),
prefixes as (
  select conv_id, max(n) as n, max(n_rejected) as n_rejected,
         coalesce(min(case when i <= n_rejected and chosen_text is distinct from rejected_text then i - 1 end), max(n_rejected)) as p
  from both_sides group by conv_id),
openings as (
  select f.conv_id, f.n, f.n_rejected, f.p,
         coalesce(bool_or(b.i = f.p + 1 and b.i <= f.n_rejected and b.role = 'assistant'), false) as opened
  from prefixes f join both_sides b on f.conv_id is not distinct from b.conv_id group by all),
rendered as (
  select b.conv_id, o.n, o.n_rejected, o.p, o.opened, b.i, b.role, b.i <= o.n_rejected as in_rejected,
         case when o.opened and b.i = o.p + 1 then '' else '<|im_start|>' || replace(coalesce(b.role, ''), '<|', '< |') || chr(10) end as head,
         replace(coalesce(b.chosen_text, ''), '<|', '< |') || '<|im_end|>' || chr(10) as chosen_body,
         replace(coalesce(b.rejected_text, ''), '<|', '< |') || '<|im_end|>' || chr(10) as rejected_body
  from both_sides b join openings o on b.conv_id is not distinct from o.conv_id),
measured as (
  select *, coalesce(sum(case when i > p then length(head) + length(chosen_body) else 0 end) over before, 0) + length(head) as chosen_at,
         coalesce(sum(case when i > p then length(head) + length(rejected_body) else 0 end) over before, 0) + length(head) as rejected_at
  from rendered window before as (partition by conv_id order by i rows between unbounded preceding and 1 preceding))
select conv_id, cast(p as integer) as prompt_turns,
       coalesce(string_agg(head || chosen_body, '' order by i) filter (i <= p), '')
         || case when opened then '<|im_start|>assistant' || chr(10) else '' end as prompt,
       coalesce(string_agg(head || chosen_body, '' order by i) filter (i > p), '') as chosen,
       coalesce(string_agg(head || rejected_body, '' order by i) filter (i > p and in_rejected), '') as rejected,
       coalesce(string_agg(concat(chosen_at, '-', chosen_at + length(chosen_body) - 1), ',' order by i)
                filter (i > p and role = 'assistant'), '') as chosen_mask,
       coalesce(string_agg(concat(rejected_at, '-', rejected_at + length(rejected_body) - 1), ',' order by i)
                filter (i > p and in_rejected and role = 'assistant'), '') as rejected_mask,
       n = p and n_rejected = p as same
from measured group by conv_id, n, n_rejected, p, opened
"""
