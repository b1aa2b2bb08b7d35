"""Preference formatting of conversations, with DataFrame functions alone.

Two conversations of a pair share their longest common prefix of turns; it is rendered once as the prompt, and
what follows in each is rendered as a completion with the spans of the assistant's text, on which to train.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .ranks import rank_within

#: Fixed marks of the rendering: a header line for each turn and an end mark.
HEAD, MID, END = "<|", "|>\n", "<|end|>\n"


def _text(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), turn["role"], F.lit(MID), turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _text), "")


def train_spans(turns: Column, role: str = "assistant") -> Column:
    """Character spans (start, end) of the rendering that hold the text and end mark of `role`'s turns."""
    kind = "array<struct<start:int,end:int>>"

    def step(acc: Column, turn: Column) -> Column:
        body = acc["at"] + F.length(turn["role"]) + len(HEAD) + len(MID)
        end = body + F.length(turn["text"]) + len(END)
        span = F.array(F.struct(body.cast("int").alias("start"), end.cast("int").alias("end")))
        return F.struct(end.cast("int").alias("at"), F.when(turn["role"] == role, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {kind})").alias("spans"))
    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def conversations(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) to (conv_id, turns) in turn order; null roles and texts are empty."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def pair_by_opening(convs: DataFrame, n: int) -> DataFrame:
    """Pair conversations that open with the same turn: of each opening's conversations, in the order of the md5 of
    their ids, the first is chosen over the second, the third over the fourth, and so on; an odd one has no rejected. `n` bounds
    the number of conversations."""
    opening = F.md5(_text(F.get("turns", F.lit(0))))
    ranked = rank_within(convs.withColumn("opening", opening), ["opening"], F.md5(F.col("conv_id").cast("string")), n)
    ranked = ranked.withColumn("pair_no", F.floor(F.col("rank") / 2)).withColumn("x", F.struct("conv_id", "turns"))
    return ranked.groupBy("opening", "pair_no").agg(F.max(F.when(F.col("rank") % 2 == 0, F.col("x"))).alias("c"), F.max(F.when(F.col("rank") % 2 == 1, F.col("x"))).alias("r"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(c, r), structs of conv_id and turns, r possibly null, to the formatted pair.

    Adds chosen_id, rejected_id, n_common, prompt, chosen, rejected, chosen_spans and rejected_spans. Turns are equal
    when role and text are; identical conversations leave two empty completions; without r the prompt is empty and
    the rejected side null.
    """
    a, b = F.col("c")["turns"], F.col("r")["turns"]
    m = F.least(F.size(a), F.size(b))
    equal = F.zip_with(F.slice(a, 1, m), F.slice(b, 1, m), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    first = F.array_position(equal, F.lit(False))
    d = pairs.withColumn("n_common", F.when(b.isNull(), 0).when(first == 0, m).otherwise(first - 1).cast("int"))
    rest = lambda x: F.slice(x, F.col("n_common") + 1, F.greatest(F.size(x) - F.col("n_common"), F.lit(0)))
    d = d.withColumns({"_a": rest(a), "_b": rest(b)})
    return d.select(
        *[c for c in pairs.columns if c not in ("c", "r")],
        F.col("c")["conv_id"].alias("chosen_id"),
        F.col("r")["conv_id"].alias("rejected_id"),
        "n_common",
        render(F.slice(a, 1, F.col("n_common"))).alias("prompt"),
        render(F.col("_a")).alias("chosen"),
        render(F.col("_b")).alias("rejected"),
        train_spans(F.col("_a")).alias("chosen_spans"),
        train_spans(F.col("_b")).alias("rejected_spans"),
    )


def preference_pairs(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) to formatted preference pairs, paired by their opening turn.

    Rows without conv_id belong to no conversation and are left out; turns with equal or null numbers come in the
    order of role and text, null numbers first; repeated rows are repeated turns; other columns are dropped; an
    empty table gives no pair.
    """
    return format_pairs(pair_by_opening(conversations(rows), rows.count()))


def reply_pairs(spark: SparkSession, rows: DataFrame, role: str = "assistant") -> DataFrame:
    """Conversations (conv_id, turn, role, text) to formatted preference pairs, one for each conversation.

    Chosen is the conversation; rejected is the same with the text of its last `role` turn replaced by another one: of
    the distinct texts of last `role` turns, in the order of their md5, the next, and after the last the first. So the
    two always differ. rejected_id is the least conv_id of those that the text ends. Without a `role` turn, or when all
    these texts are equal, there is no rejected side. Otherwise as preference_pairs().
    """
    turns = F.col("turns")
    places = F.transform(turns, lambda t, i: F.when(t["role"] == role, i))
    convs = conversations(rows).withColumn("_at", F.array_max(places)).withColumn("_reply", F.get(turns, F.col("_at"))["text"])
    convs = convs.withColumn("_key", F.md5("_reply"))
    replies = convs.where("_at is not null").groupBy("_key").agg(F.min("conv_id").alias("_id"), F.min("_reply").alias("_other"))
    replies = cut(spark, replies, "replies")
    n = replies.count()
    ranked = rank_within(replies, [], F.col("_key"), n, "_no")
    follower = ranked.select(F.pmod(F.col("_no") - 1, F.lit(max(n, 1))).alias("_no"), "_id", "_other").where(F.lit(n > 1))
    links = ranked.select("_key", "_no").join(follower, "_no").drop("_no")
    put = F.transform(turns, lambda t, i: F.when(i == F.col("_at"), t.withField("text", F.col("_other"))).otherwise(t))
    pairs = convs.join(links, "_key", "left").select(
        F.struct("conv_id", "turns").alias("c"), F.when(F.col("_other").isNotNull(), F.struct(F.col("_id").alias("conv_id"), put.alias("turns"))).alias("r")
    )
    return format_pairs(pairs)


def _digests(d: DataFrame) -> DataFrame:
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return d.select(
        "chosen_id", "rejected_id", "n_common", F.md5("prompt").alias("prompt_md5"), F.md5("chosen").alias("chosen_md5"), F.md5("rejected").alias("rejected_md5"),
        spans("chosen_spans").alias("chosen_spans"), spans("rejected_spans").alias("rejected_spans"),
    )


def op7_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(reply_pairs(spark, table(spark, sf_dir, "conversations")))


_R = "'<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)"
_SPANS = """array_to_string(list_transform(list_filter(range(1, len({t}) + 1), lambda i: {t}[i].role = 'assistant'), lambda i:
  (coalesce(list_sum(list_transform({t}[1:i - 1], lambda x: length({r}))), 0)::bigint + length({t}[i].role) + 5)::varchar || '-' ||
  (list_sum(list_transform({t}[1:i], lambda x: length({r})))::bigint)::varchar), ',')"""
_RESULT = f"""select chosen_id, rejected_id, n::int as n_common, md5(coalesce(array_to_string(list_transform(h, lambda x: {_R}), ''), '')) as prompt_md5,
  md5(coalesce(array_to_string(list_transform(a, lambda x: {_R}), ''), '')) as chosen_md5,
  case when b is not null then md5(coalesce(array_to_string(list_transform(b, lambda x: {_R}), ''), '')) end as rejected_md5,
  coalesce({_SPANS.format(t="a", r=_R)}, '') as chosen_spans, case when b is not null then coalesce({_SPANS.format(t="b", r=_R)}, '') end as rejected_spans from m
"""
#: DuckDB SQL for op7_preference_chat.
OP7_SQL = f"""
with c as (select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as t
  from conversations where conv_id is not null group by conv_id),
k as (select *, list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')) as p from c),
e as (select t[p].text as reply, min(conv_id) as id, row_number() over (order by md5(t[p].text)) - 1 as no, count(*) over () as m from k where p is not null group by t[p].text),
n as (select k.conv_id as chosen_id, y.id as rejected_id, case when y.id is null then 0 else p - 1 end as n, t as ta,
    case when y.id is not null then t[1:p - 1] || [{{'role': t[p].role, 'text': y.reply}}] || t[p + 1:] end as tb
  from k left join e x on p is not null and t[p].text = x.reply left join e y on x.m > 1 and y.no = (x.no + 1) % x.m),
m as (select chosen_id, rejected_id, n, ta[1:n] as h, ta[n + 1:] as a, case when tb is not null then tb[n + 1:] end as b from n)
{_RESULT}"""
