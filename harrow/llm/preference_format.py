"""Preference formatting: the common turns of two conversations as one prompt, and their rests as masked completions."""

from pyspark.sql import functions as F

TRAINED = "assistant"
_PAIR = "array<struct<role:string,text:string>>"


def conversations_of(turns):
    """(conv_id, turns): the turns of each conversation in order of turn (ties by role, then text; nulls first).

    A conversation ends up as one row, as it does in its sample. Turns with a
    null conv_id are one conversation; a null role or text is an empty one.
    """
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.select("conv_id", one.alias("one")).groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda x: F.struct(x["role"], x["text"])).alias("turns"))


def stale_replies(conversations):
    """(conv_id, chosen, rejected): a conversation up to its last reply, and the same with the reply before in its place.

    A conversation without a reply makes no pair; where there is no reply
    before, the rejected one is empty.
    """
    places = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: F.get("turns", i)["role"] == TRAINED)
    rows = conversations.select("conv_id", "turns", places.alias("at")).where("size(at) > 0")
    last, before = F.get("at", F.size("at") - 1), F.get("at", F.size("at") - 2)
    stale = F.struct(F.lit(TRAINED).alias("role"), F.coalesce(F.get("turns", before)["text"], F.lit("")).alias("text"))
    return rows.select("conv_id", F.slice("turns", F.lit(1), last + 1).alias("chosen"), F.concat(
        F.slice("turns", F.lit(1), last), F.array(stale)).cast(_PAIR).alias("rejected"))


def format_pairs(pairs, keys=("conv_id",)):
    """keys, n_prompt_turns, prompt, chosen, rejected, chosen_mask and rejected_mask for each pair.

    pairs has arrays chosen and rejected of (role, text). The longest common
    prefix of turns, equal in role and text, is rendered once as the prompt, the
    rest of each side as its completion. A mask is an array of (n_chars,
    trained) over the completion in order; what an assistant turn says, with its
    end mark, is trained, turn headings and other roles are not. Two equal
    conversations have empty completions, a side that is null counts as empty,
    and a null role or text as an empty string. Texts are whole, and mark strings
    inside them stay. Every row gets its own result; other columns are dropped.
    """
    def side(name):
        whole = F.transform(F.coalesce(name, F.array().cast(_PAIR)), lambda t: F.struct(
            F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
        return whole.alias(name)

    rows = pairs.select(*keys, side("chosen"), side("rejected"))
    shared = F.least(F.size("chosen"), F.size("rejected"))
    differs = F.filter(F.when(shared > 0, F.sequence(F.lit(0), shared - 1)),
                       lambda i: F.get("chosen", i) != F.get("rejected", i))
    rows = rows.select(*keys, "chosen", "rejected", F.coalesce(F.array_min(differs), shared).alias("n"))

    def rest(name):
        return F.slice(name, F.col("n") + 1, F.size(name))

    return rows.select(
        *keys, F.col("n").cast("long").alias("n_prompt_turns"), _rendered(F.slice("chosen", F.lit(1), F.col("n"))).alias("prompt"),
        *[_rendered(rest(x)).alias(x) for x in ("chosen", "rejected")],
        *[_mask(rest(x)).alias(f"{x}_mask") for x in ("chosen", "rejected")])


def _head(turn):
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _body(turn):
    return F.concat(turn["text"], F.lit("<|end|>\n"))


def _rendered(turns):
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _mask(turns):
    def part(text, trained):
        return F.struct(F.char_length(text).cast("long").alias("n_chars"), trained.alias("trained"))

    return F.flatten(F.transform(turns, lambda t: F.array(
        part(_head(t), F.lit(False)), part(_body(t), t["role"] == TRAINED))))


def op9_preference_format(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    done = format_pairs(stale_replies(conversations_of(turns)))
    for name in ("chosen_mask", "rejected_mask"):
        done = done.withColumn(name, F.array_join(F.transform(
            name, lambda m: F.concat(m["n_chars"].cast("string"), F.when(m["trained"], "+").otherwise("-"))), ","))
    return done


SQL = """
with c as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as t from conversations group by conv_id),
a as (select *, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant') as q from c),
p as (select conv_id, t[1:q[-1]] as x,
    list_append(t[1:q[-1] - 1], {'role': 'assistant', 'text': case when len(q) > 1 then t[q[-2]].text else '' end}) as y
  from a where len(q) > 0),
n as (select *, coalesce(list_min(list_filter(range(1, len(x) + 1), lambda i: x[i] <> y[i])) - 1, len(x)) as n from p),
r as (select conv_id, n, x[1:n] as h, x[n + 1:] as x, y[n + 1:] as y from n)
select conv_id, n as n_prompt_turns,
  array_to_string(list_transform(h, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '') as prompt,
  array_to_string(list_transform(x, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '') as chosen,
  array_to_string(list_transform(y, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '') as rejected,
  array_to_string(list_transform(x, lambda t: (length(t.role) + 5)::varchar || '-,' || (length(t.text) + 8)::varchar
    || case when t.role = 'assistant' then '+' else '-' end), ',') as chosen_mask,
  array_to_string(list_transform(y, lambda t: (length(t.role) + 5)::varchar || '-,' || (length(t.text) + 8)::varchar
    || case when t.role = 'assistant' then '+' else '-' end), ',') as rejected_mask
from r
"""
