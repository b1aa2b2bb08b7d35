"""Quality rules: one table of thresholds, compiled into one Spark projection without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, table

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to a in is that it for on was with be as at this by are from",
    "de": "der die und in den von zu das sich mit des auf für ist nicht im eine dem ein als",
    "fr": "de la le et les des en un du une que est pour qui dans au sur par pas avec",
    "es": "de la que el en y del los se las no por un con una es para su al lo",
}


#: Upper-case letters of these languages: A to Z and the Latin-1 ones.
UPPER = "".join(map(chr, [*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]))


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule when num < low * den or num > high * den."""

    name: str
    num: str
    den: str
    low: float | None = None
    high: float | None = None


#: The threshold table. Columns are those of `measures`; a den of 1 makes the bound absolute.
RULES = (
    Rule("too_short", "n_words", "one", low=20),
    Rule("repeated_windows", "n_repeat_words", "n_words", high=0.3),
    Rule("word_length", "word_chars", "n_words", low=2, high=14),
    Rule("symbols", "n_symbols", "n_words", high=0.25),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("stop_words", "n_stop_words", "n_words", low=0.04),
    Rule("upper_case", "n_upper", "word_chars", high=0.4),
    Rule("exclamations", "n_exclaim", "n_words", high=0.5),
    Rule("immediate_repeats", "n_same_as_previous", "n_words", high=0.2),
)
BASE_RULES = ("too_short", "repeated_windows")


def _repeat_words(words: Column, window: int) -> Column:
    """Words that lie in a window found twice or more: sort the windows once, then add up the union of their spans."""
    n = F.size(words)
    starts = F.sequence(F.lit(1), n - window + 1)
    wins = F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i, window), " ").alias("w"), i.alias("i")))
    ordered = F.array_sort(wins)

    def same(s: Column, j: Column) -> Column:
        return F.filter(
            s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["w"] == x["w"])) | (F.coalesce(F.get(s, k + 1)["w"], F.lit("")) == x["w"])
        )

    # A lambda binds the sorted array once, so it is not sorted again for each of its elements.
    hits = F.flatten(F.transform(F.array(ordered), same))
    at = F.array_sort(F.transform(hits, lambda x: x["i"]))
    total = F.aggregate(
        at,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(
            (i + window).alias("end"), (acc["n"] + F.lit(window) - F.greatest(acc["end"] - i, F.lit(0))).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return total


def measures(docs: DataFrame, window: int = 8) -> DataFrame:
    """Add the counts that RULES refer to. Null text counts as no words; every count is over the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumn("_t", text).withColumn("_w", F.filter(F.split("_t", WS, -1), lambda w: w != ""))
    n = F.size("_w")
    lines = F.filter(F.split("_t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = d.withColumn("_lines", lines)
    d = d.withColumn(
        "_wins",
        F.when(
            n > window,
            F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.xxhash64(F.slice("_w", i, window))),
        ),
    )
    bare, shorter = F.regexp_replace("_t", WS, ""), F.greatest(n - 1, F.lit(0))
    stops = sorted({w for v in STOP_WORDS.values() for w in v.split()})
    count = lambda chars: F.length("_t") - F.length(F.translate("_t", chars, ""))
    return d.select(
        *docs.columns,
        F.lit(1).alias("one"),
        n.cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        count("#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        # Equal windows have equal hashes, so no equal hashes means no repeat; else the windows themselves decide.
        F.when(F.coalesce(F.size(F.array_distinct("_wins")) == F.size("_wins"), F.lit(True)), F.lit(0))
        .otherwise(_repeat_words(F.col("_w"), window))
        .cast("long")
        .alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(*stops))).cast("long").alias("n_stop_words"),
        count(UPPER).cast("long").alias("n_upper"),
        count("!").cast("long").alias("n_exclaim"),
        F.size(F.array_remove(F.zip_with(F.slice("_w", 1, shorter), F.slice("_w", F.lit(2), shorter), lambda a, b: a == b), F.lit(False)))
        .cast("long")
        .alias("n_same_as_previous"),
    )


def broken(rule: Rule) -> Column:
    num, den = F.col(rule.num).cast("double"), F.col(rule.den).cast("double")
    tests = [num < den * rule.low] if rule.low is not None else []
    tests += [num > den * rule.high] if rule.high is not None else []
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, window: int = 8) -> DataFrame:
    """Add the counts, `base_failed`, `failed_rules` (names) and `kept`.

    Nulls: text counts as empty, so the document breaks too_short; other columns are not looked at. Repeated
    rows are judged each by itself. An empty table gives an empty result. Input columns stay; a clash with a
    count's name is resolved in favour of the count (the input column is dropped first).
    """
    made = {"one", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_upper", "n_exclaim", "n_same_as_previous", "base_failed", "failed_rules", "kept", "_t", "_w", "_lines", "_wins"}
    d = measures(docs.drop(*[c for c in docs.columns if c in made]), window)
    # Integer arithmetic where the base rules must be exact.
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules if r.name not in BASE_RULES]))
    return d.withColumns({"base_failed": base, "failed_rules": failed}).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("one")


def accepted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that no rule rejects, with their own columns.

    The verdict passes through a generator, so that the filter is not pushed into the projection, where it would
    compute each of its measures again for each rule.
    """
    packed = docs.select("text", F.struct(*docs.columns).alias("_row"))
    return judge(packed, rules).select("_row", F.explode(F.array("kept")).alias("_kept")).where("_kept").select("_row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select(*cols, F.array_join("failed_rules", ",").alias("failed_rules"))


_IN = ", ".join("'" + w + "'" for w in sorted({w for v in STOP_WORDS.values() for w in v.split()}))
#: DuckDB SQL for op6_quality_rules.
OP6_SQL = f"""
with t as (select doc_id, coalesce(text, '') as s from documents),
w as (select doc_id, s, list_filter(string_split_regex(s, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
  list_filter(string_split(s, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from t),
x as (select *, case when len(w) >= 8 then list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' ')) else [] end as g from w),
p as (select doc_id, unnest(g) as g, unnest(range(1, len(g) + 1)) as i from x),
q as (select doc_id, i, count(*) over (partition by doc_id, g) as c from p),
r as (select doc_id, i, lag(i) over (partition by doc_id order by i) as b from q where c > 1),
s as (select doc_id, sum(least(8, coalesce(i - b, 8))) as n from r group by doc_id),
m as (select x.doc_id, len(w) as n_words, length(regexp_replace(s, '[\\x20\\x09-\\x0D]+', '', 'g')) as word_chars,
  length(s) - length(regexp_replace(s, '[#*$%&|<>]', '', 'g')) as n_symbols,
  len(ls) - len(list_distinct(ls)) as n_dup_lines, len(ls) as n_lines, coalesce(sr.n, 0) as n_repeat_words,
  len(list_filter(w, lambda y: lower(y) in ({_IN}))) as n_stop,
  length(regexp_replace(s, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) as n_upper,
  length(s) - length(replace(s, '!', '')) as n_exclaim,
  len(list_filter(range(1, len(w)), lambda i: w[i] = w[i+1])) as n_same
  from x left join s sr on x.doc_id = sr.doc_id),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed, concat_ws(',',
  case when word_chars < 2 * n_words or word_chars > 14 * n_words then 'word_length' end,
  case when n_symbols > 0.25::double * n_words then 'symbols' end,
  case when n_dup_lines > 0.5::double * n_lines then 'duplicate_lines' end,
  case when n_stop < 0.04::double * n_words then 'stop_words' end,
  case when n_upper > 0.4::double * word_chars then 'upper_case' end,
  case when n_exclaim > 0.5::double * n_words then 'exclamations' end,
  case when n_same > 0.2::double * n_words then 'immediate_repeats' end) as failed_rules from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  (not base_failed and failed_rules = '') as kept, failed_rules from b
"""
