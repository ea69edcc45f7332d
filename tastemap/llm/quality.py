"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each document gets counts over its whole text. Documents that pass the base rule
(at least 50 words, at most half of them in repeated three-word windows) feed
mergeable quantile sketches of four measures, one per language and source: values
fall into buckets of 1 % relative width, so a sketch is a table of counts that adds
up in any order and gives the same thresholds on every run. Sketches of a
language's sources merge into the language's, those into the corpus'. A threshold lies
beyond the quartiles by ``FENCE`` quartile distances plus a slack (``SLACK``). A group's
thresholds are the mean of its own, weighted by its documents, and its language's, weighted
by ``PRIOR`` documents; the language's are blended with the corpus' alike. So they move
smoothly with a group's size. Documents with a measure out of range are rejected.

Defined results: null and empty texts have zero counts and fail the base rule; a
null language or source is a group of its own (shared with the empty name);
repeated rows are judged one by one; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .frames import saved, table

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
ZERO_BUCKET = -100000
FENCE = 3.0
PRIOR = 100  # documents for which the next larger group's thresholds count
# measure: (slack, lower side too)
SLACK = {"symbol_ratio": (0.05, False), "repeat_ratio": (0.25, False),
         "dup_ratio": (0.5, False), "word_length": (0.75, True)}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the counts of ``COUNTS`` and ``n_lines`` (lines with a word)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    solid = lambda c: F.length(F.translate(c, BLANKS, ""))
    d = docs.select(
        "*", solid(text).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: solid(x) > 0).alias("_lines"),
        F.array_remove(F.split(F.translate(text, BLANKS[1:], " " * 5), " "), "").alias("_words"))
    d = d.select(
        "*", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_words").cast("long").alias("n_words"),
        F.when(F.size("_words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))).alias("_grams"))
    d = d.drop("_lines", "_words").select(
        "*", F.when(F.size("_grams") > F.size(F.array_distinct("_grams")), F.sort_array(
            F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))).alias("_sorted"))
    same = lambda x, k: x["g"].eqNullSafe(F.get("_sorted", k)["g"])
    d = d.drop("_grams").select("*", F.sort_array(F.transform(
        F.filter("_sorted", lambda x, k: same(x, k + 1) | ((k > 0) & same(x, F.greatest(k - 1, F.lit(0))))),
        lambda x: x["i"])).alias("_places"))
    # a repeated window covers three words, or those up to the next repeated window
    cover = F.transform("_places", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1) - x, F.lit(3))))
    return d.select("*", F.coalesce(F.aggregate(cover, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
                    .alias("n_repeat_words")).drop("_sorted", "_places")


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def _measures():
    safe = lambda c: F.greatest(F.col(c), F.lit(1)).cast("double")
    return {"symbol_ratio": F.col("n_symbols") / safe("word_chars"), "repeat_ratio": F.col("n_repeat_words") / safe("n_words"),
            "dup_ratio": F.col("n_dup_lines") / safe("n_lines"), "word_length": F.col("word_chars") / safe("n_words")}


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): one sketch per group, level of detail as given."""
    rows = counted.filter(~base_failed()).select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), v.alias("v")) for m, v in _measures().items()])).alias("x"))
    bucket = F.when(F.col("x.v") > 0, F.ceil(F.log(F.col("x.v")) / F.log(F.lit(GAMMA)))).otherwise(ZERO_BUCKET)
    return rows.groupBy("lang", "source", F.col("x.measure").alias("measure"), bucket.cast("long").alias("bucket")).agg(
        F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """The sketches of all groups that share ``keys``, added up."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def limits(sketch: DataFrame, *keys: str) -> DataFrame:
    """One row per group: its size and each measure's lower and upper limit."""
    from pyspark.sql import Window as W
    by = W.partitionBy(*keys, "measure")
    cum = sketch.select("*", F.sum("n").over(by.orderBy("bucket")).alias("cum"), F.sum("n").over(by).alias("total"),
                        F.when(F.col("bucket") == ZERO_BUCKET, 0.0).otherwise(
                            F.pow(F.lit(GAMMA), F.col("bucket")) * (2 / (GAMMA + 1))).alias("v"))
    q = lambda p: F.min(F.when(F.col("cum") > (F.col("total") - 1) * p, F.col("v")))
    quart = cum.groupBy(*keys, "measure").agg(F.max("total").alias("size"), q(0.25).alias("q1"), q(0.75).alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * FENCE
    out = [F.max("size").alias("size")]
    for m, (slack, both) in SLACK.items():
        out.append(F.max(F.when(F.col("measure") == m, F.col("q3") + reach + slack)).alias(f"hi_{m}"))
        if both:
            out.append(F.max(F.when(F.col("measure") == m, F.col("q1") - reach - slack)).alias(f"lo_{m}"))
    return quart.groupBy(*keys).agg(*out)


LIMITS = [f"hi_{m}" for m in SLACK] + [f"lo_{m}" for m, (_, both) in SLACK.items() if both]


def group_limits(counted: DataFrame) -> DataFrame:
    """(lang, source, limits): the group's own blended with the language's, those with the corpus'."""
    fine = saved(sketches(counted), "quality-sketch")
    own = limits(fine, "lang", "source")
    lang = limits(merged(fine, "lang"), "lang").select("lang", F.col("size").alias("lsize"), *[F.col(c).alias("l_" + c) for c in LIMITS])
    corpus = limits(merged(fine.withColumn("g", F.lit(0)), "g"), "g").select("g", *[F.col(c).alias("c_" + c) for c in LIMITS])
    both = own.join(lang, "lang").withColumn("g", F.lit(0)).join(corpus, "g")
    blend = lambda n, a, b: (F.col(n) * a + F.lit(float(PRIOR)) * b) / (F.col(n) + F.lit(float(PRIOR)))
    return both.select("lang", "source", *[
        blend("size", F.col(c), blend("lsize", F.col("l_" + c), F.col("c_" + c))).alias(c) for c in LIMITS])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """``id_col``, the counts, ``base_failed``, ``kept`` and ``text_key`` (hash of the text), a row per document."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                      F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"))
    counted = saved(with_counts(src).select("id", "lang", "source", "n_lines", *COUNTS,
                                            F.xxhash64("text").alias("text_key")), "quality-counts")
    d = counted.join(group_limits(counted), ["lang", "source"], "left")
    fine = F.lit(True)
    for m, v in _measures().items():
        fine &= v <= F.col(f"hi_{m}")
        if SLACK[m][1]:
            fine &= v >= F.col(f"lo_{m}")
    return d.select(F.col("id").alias(id_col), *COUNTS, base_failed().alias("base_failed"),
                    (~base_failed() & F.coalesce(fine, F.lit(True))).alias("kept"), "text_key")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("text_key")


def _sql() -> str:
    q = lambda p: f"min(v) filter (where cum > (total - 1) * {p})"
    hi = lambda m: f"max(q3 + (q3 - q1) * {FENCE} + {SLACK[m][0]}) filter (where measure = '{m}') as hi_{m}"
    lo = lambda m: f"max(q1 - (q3 - q1) * {FENCE} - {SLACK[m][0]}) filter (where measure = '{m}') as lo_{m}"
    lims = ", ".join([hi(m) for m in SLACK] + [lo(m) for m in SLACK if SLACK[m][1]])
    prior = f"{float(PRIOR)}::double"
    pick = ", ".join(f"(o.size * o.{c} + {prior} * ((l.size * l.{c} + {prior} * c.{c}) / (l.size + {prior}))) / (o.size + {prior}) as {c}"
                     for c in LIMITS)
    level = lambda name, keys, by: f"""
{name}_n as (select {keys}, measure, bucket, sum(n) as n from sketch group by {by}, measure, bucket),
{name}_c as (select *, sum(n) over (partition by {by}, measure order by bucket) as cum, sum(n) over (partition by {by}, measure) as total,
  case when bucket = {ZERO_BUCKET} then 0.0 else pow({GAMMA!r}, bucket) * {2 / (GAMMA + 1)!r} end as v from {name}_n),
{name}_q as (select {by}, measure, max(total) as size, {q(0.25)} as q1, {q(0.75)} as q3 from {name}_c group by {by}, measure),
{name} as (select {by}, max(size) as size, {lims} from {name}_q group by {by})"""  # noqa: E731
    good = " and ".join([f"{m} <= hi_{m}" for m in SLACK] + [f"{m} >= lo_{m}" for m in SLACK if SLACK[m][1]])
    return f"""
with raw as (select row_number() over () as r, doc_id, coalesce(text, '') as t, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
w as (select r, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls,
  regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g') as solid, regexp_replace(t, '[^#*$%&|<>]', '', 'g') as sym from raw),
g as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as gram from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)),
rep as (select r, i from (select r, i, count(*) over (partition by r, gram) as c from g) where c > 1),
cov as (select r, count(distinct i + d) as n from rep, (values (0), (1), (2)) as o(d) group by r),
m as (select doc_id, lang, source, len(ws)::bigint as n_words, length(solid)::bigint as word_chars, length(sym)::bigint as n_symbols,
  len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words
  from raw join w using (r) left join cov using (r)),
v as (select *, n_words < {MIN_WORDS} or n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} as base_failed,
  n_symbols / greatest(word_chars, 1)::double as symbol_ratio, n_repeat_words / greatest(n_words, 1)::double as repeat_ratio,
  n_dup_lines / greatest(n_lines, 1)::double as dup_ratio, word_chars / greatest(n_words, 1)::double as word_length from m),
sketch as (select lang, source, measure, case when x > 0 then ceil(ln(x) / ln({GAMMA!r}))::bigint else {ZERO_BUCKET} end as bucket, count(*) as n
  from (unpivot (select lang, source, symbol_ratio, repeat_ratio, dup_ratio, word_length from v where not base_failed)
        on symbol_ratio, repeat_ratio, dup_ratio, word_length into name measure value x) group by all),{level("own", "lang, source", "lang, source")},{level("lng", "lang", "lang")},{level("crp", "1 as g", "g").replace("select 1 as g, measure, bucket, sum(n) as n from sketch group by g,", "select 1 as g, measure, bucket, sum(n) as n from sketch group by")},
lim as (select o.lang, o.source, {pick} from own o join lng l using (lang), crp c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce({good}, true) as kept
from v left join lim using (lang, source)"""


OP8_SQL = _sql()
