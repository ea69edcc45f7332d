"""Secret scan: fixed patterns plus a randomness test battery, in DataFrame functions only.

*Patterns.* Assignments of passwords and tokens, access key ids and long hex runs,
leftmost and non-overlapping per kind, with places in code points: the pieces
between matches and the matches themselves, both from one regular expression, are
walked once to get the places.

*Battery.* Every further run of ``[A-Za-z0-9+/_-]`` of at least ``MIN_TOKEN``
characters is a candidate. Its encoding is inferred (hex, base 32, lower-case letters
and digits, base 64), its symbols are numbered in that alphabet, and three scores that
are about standard normal for a random string are taken: chi-squared uniformity of
the alphabet, number of runs above and below the alphabet's middle, and
serial correlation. A candidate is random when it keeps away from ordinary text in all
three, so its p-value is the largest of three, each from the score's known distribution at
the token's own length and alphabet if the text were ordinary: symbols that repeat at the
rate ``REPEAT`` (at least ``LEAST`` times the uniform rate; noncentral chi-squared in
its cube-root normal form), and neighbours that depend on each other by ``DEPEND`` (normal, for
runs and serial correlation). No other token of the table enters a p-value. The
false-discovery rate is held at ``FDR`` per length stratum (step-up rule on the histogram
of p-values). Histograms are counts, so they add up over any partitioning, and only they
are compared with each other. Tokens of letters only, apart from a capital at the start, are
words; they, like digit strings, are not candidates.
Candidates that pass and overlap no pattern span are added as kind ``random``.

Defined results: null and empty texts have no spans; rows with a null id are scanned
like others; repeated rows give repeated results; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .frames import saved, table

# fixed values: patterns of the kinds and their least lengths
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]

MIN_TOKEN = 16
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+" % MIN_TOKEN
FDR = 0.05
REPEAT = 0.05     # least share of equal pairs of symbols in ordinary text (English letters 0.067, German 0.076)
LEAST = 2.0       # and in small alphabets, in uniform shares
DEPEND = 0.8      # correlation of neighbours in ordered text
STEP = 16         # buckets of p-values per halving
ALPHABETS = {     # encoding: (pattern, symbols)
    "hex": ("^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "lower": ("^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    "lower36": ("^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    "upper36": ("^[A-Z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    "base64": ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
}
WALK = 128        # matches of a block
SPAN = "array<struct<s:int,e:int,m:string>>"


def bound(value, use):
    """``use(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def places(text, pattern: str):
    """Array of (s, e, m) of all matches of ``pattern`` in the column ``text``.

    Matches are walked in blocks of ``WALK``, each from its own start, so that the work does not grow with the square of their number."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(F.split(text, pattern), found, lambda p, m: F.struct(
        F.coalesce(F.length(p), F.lit(0)).alias("p"), F.coalesce(F.length(m), F.lit(0)).alias("n"), m.alias("m")))

    def walk(ps):
        block = lambda i: F.slice(ps, i * WALK + 1, WALK)
        starts = F.aggregate(
            F.sequence(F.lit(0), F.floor(F.size(ps) / WALK).cast("int")),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda a, i: F.struct(F.aggregate(block(i), a["at"], lambda n, x: n + x["p"] + x["n"]).alias("at"),
                                  F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        spans = lambda at, i: F.aggregate(
            block(i), F.struct(at.alias("at"), F.array().cast(SPAN).alias("out")),
            lambda a, x: F.struct((a["at"] + x["p"] + x["n"]).alias("at"), F.when(x["m"].isNull(), a["out"]).otherwise(
                F.concat(a["out"], F.array(F.struct((a["at"] + x["p"]).alias("s"), (a["at"] + x["p"] + x["n"]).alias("e"), x["m"].alias("m"))))).alias("out")),
            lambda a: a["out"])
        return F.flatten(F.transform(starts, spans))

    return bound(pieces, walk)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text_key`` and the pattern spans (``assign``, ``access``, ``hex``) and candidates of each text."""
    t = F.col("t")
    none = F.array().cast(SPAN)
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_VALUE
    return src.select(
        "id", F.xxhash64("t").alias("text_key"),
        F.when((F.contains(t, F.lit("=")) | F.contains(t, F.lit(":"))) & F.regexp_like(t, F.lit(ASSIGN)),
               F.filter(places(t, ASSIGN), lambda x: value(x["m"]))).otherwise(none).alias("assign"),
        F.when(F.contains(t, F.lit("AKIA")), places(t, ACCESS)).otherwise(none).alias("access"),
        F.when(F.regexp_like(t, F.lit(HEX)), places(t, HEX)).otherwise(none).alias("hex"),
        F.when(F.regexp_like(t, F.lit(TOKEN)), places(t, TOKEN)).otherwise(none).alias("tokens"))


def normal(x):
    """Share of the standard normal distribution below ``x`` (Abramowitz and Stegun 26.2.17)."""
    def share(v):
        z = F.least(F.abs(v), F.lit(30.0))
        t = 1 / (1 + 0.2316419 * z)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        tail = F.exp(-z * z / 2) * (poly * 0.3989422804014327)
        return F.when(v < 0, tail).otherwise(1 - tail)

    return bound(x, share)


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (with a column ``m``) plus ``encoding``, ``plain`` (ordinary letters), the sum of squares ``statistic`` and ``p``."""
    kind, symbols = F.lit("base64"), F.lit(ALPHABETS["base64"][1])
    for name, (pattern, alphabet) in reversed(ALPHABETS.items()):
        if pattern:
            kind = F.when(F.col("m").rlike(pattern), name).otherwise(kind)
            symbols = F.when(F.col("m").rlike(pattern), alphabet).otherwise(symbols)
    plain = F.col("m").rlike("^[A-Za-z][a-z]+$|^[A-Z]+$")
    d = tokens.select("*", kind.alias("encoding"), symbols.alias("_alphabet"), plain.alias("plain"))
    # one case for letters when the alphabet has one
    body = F.when(plain, F.lower("m")).when(F.col("encoding") == "hex", F.lower("m")).otherwise(F.col("m"))
    letters = F.when(plain, F.lit(ALPHABETS["lower"][1])).otherwise(F.col("_alphabet"))
    d = d.select("*", F.split(body, "").alias("_c"), letters.alias("_l"), F.length("m").cast("double").alias("_n"))
    d = d.select("*", F.length("_l").cast("double").alias("_a"),
                 F.transform("_c", lambda c: F.instr(F.col("_l"), c).cast("double")).alias("_x"))
    per = F.aggregate(F.transform(F.array_distinct("_x"), lambda v: F.pow(F.size(F.filter("_x", lambda w: w == v)), F.lit(2.0))),
                      F.lit(0.0), lambda a, v: a + v)
    mean = F.aggregate("_x", F.lit(0.0), lambda a, v: a + v) / F.col("_n")
    high = F.transform("_x", lambda v: F.when(v * 2 > F.col("_a"), 1).otherwise(0))
    d = d.select("*", (F.col("_a") / F.col("_n") * per - F.col("_n")).alias("_chi"), mean.alias("_mean"), high.alias("_h"))
    d = d.select("*", F.transform("_x", lambda v: v - F.col("_mean")).alias("_d"),
                 F.aggregate("_h", F.lit(0), lambda a, v: a + v).cast("double").alias("_n1"))
    var = F.aggregate("_d", F.lit(0.0), lambda a, v: a + v * v)
    lag = F.aggregate(F.zip_with(F.slice("_d", 1, F.size("_d") - 1), F.slice("_d", 2, F.size("_d") - 1), lambda x, y: x * y),
                      F.lit(0.0), lambda a, v: a + v)
    turns = F.aggregate(F.zip_with(F.slice("_h", 1, F.size("_h") - 1), F.slice("_h", 2, F.size("_h") - 1),
                                   lambda x, y: F.when(x != y, 1).otherwise(0)), F.lit(1), lambda a, v: a + v)
    df = F.col("_a") - 1
    # cube-root normal form of chi-squared; uniform strings are never "too uniform" here
    z_chi = F.greatest(F.lit(0.0), (F.pow(F.greatest(F.col("_chi"), F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
    n1, n2 = F.col("_n1"), F.col("_n") - F.col("_n1")
    mu = 2 * n1 * n2 / F.col("_n") + 1
    sd = F.sqrt(F.greatest((mu - 1) * (mu - 2) / (F.col("_n") - 1), F.lit(0.25)))
    z_runs = (turns - mu) / sd
    # a constant half or string has nothing to turn: as far from random as the length allows
    z_runs = F.when((n1 == 0) | (n2 == 0), F.sqrt("_n")).otherwise(z_runs)
    z_serial = F.when(var > 0, lag / var * F.sqrt("_n")).otherwise(F.sqrt("_n"))
    # each score's distribution in ordinary text of this length: noncentral chi-squared, and normal around DEPEND
    off = F.col("_n") * (F.greatest(F.col("_a") * REPEAT, F.lit(LEAST)) - 1)
    spread = 2 * (df + 2 * off) / (9 * (df + off) * (df + off))
    alike = (F.pow(F.greatest(F.col("_chi"), F.lit(0.0)) / (df + off), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
    ordered = F.greatest(F.abs("_runs"), F.abs("_serial")) - DEPEND * F.sqrt("_n")
    d = d.select("*", z_chi.alias("_uniform"), z_runs.alias("_runs"), z_serial.alias("_serial"))
    stat = F.col("_uniform") * F.col("_uniform") + F.col("_runs") * F.col("_runs") + F.col("_serial") * F.col("_serial")
    # the largest p-value belongs to the score nearest to ordinary text
    d = d.select("*", stat.alias("statistic"), F.greatest(alike, ordered).alias("_z"))
    return d.select(*tokens.columns, "encoding", "plain", "statistic", normal(F.col("_z")).alias("p"))


def stratum(n):
    """Length stratum: widths grow with the length (about four per doubling)."""
    return F.floor(F.log2(n) * 4).cast("int")


def discoveries(tested: DataFrame) -> DataFrame:
    """Rows of ``tested`` that are not ``plain`` and pass the false-discovery control of their length stratum."""
    t = tested.filter("not plain").select("*", stratum(F.length("m")).alias("stratum"),
                                          F.floor(-F.log2("p") * STEP).cast("int").alias("bucket"))
    hist = t.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    down = W.partitionBy("stratum").orderBy(F.desc("bucket"))
    all_ = W.partitionBy("stratum")
    ranked = hist.select("stratum", "bucket", F.sum("n").over(down).alias("k"), F.sum("n").over(all_).alias("m"))
    # the bucket's largest p-value stands for all in it
    limit = ranked.filter(F.pow(F.lit(2.0), -F.col("bucket") / STEP) <= F.col("k") / F.col("m") * FDR).groupBy("stratum").agg(
        F.min("bucket").alias("limit"))
    return t.join(limit, "stratum").filter("bucket >= limit").drop("stratum", "bucket", "limit")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts per pattern kind, ``base`` and ``all_spans`` as sorted (s, k, e) arrays."""
    found = saved(scan(docs, id_col, text_col), "secrets")
    def coded(i: int):
        return F.transform(KINDS[i], lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e")))

    base_spans = F.concat(*map(coded, range(3)))
    found = found.select("*", F.sort_array(base_spans).alias("base"))
    tokens = found.filter(F.size("tokens") > 0).select("id", "text_key", "base", F.explode("tokens").alias("x")).select(
        "id", "text_key", "base", "x.s", "x.e", "x.m").filter(~F.col("m").rlike("^[0-9+/_-]+$"))
    tested = saved(battery(tokens).filter("not plain"), "tested")
    hits = discoveries(tested).filter(
        ~F.exists("base", lambda b: (b["s"] < F.col("e")) & (F.col("s") < b["e"])))
    extra = hits.groupBy("id", "text_key").agg(F.collect_set(F.struct("s", F.lit(3).alias("k"), "e")).alias("extra")).select(
        F.col("id").alias("id2"), F.col("text_key").alias("key2"), "extra")
    both = found.join(extra, F.col("id").eqNullSafe(F.col("id2")) & (F.col("text_key") == F.col("key2")), "left")
    return both.select(
        F.col("id").alias(id_col), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], "base",
        F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "extra"))).alias("all_spans"))


def spans_text(col: str):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = find_secrets(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(spans_text("base"), 256).alias("base_sha256"),
                    spans_text("all_spans").alias("spans"), (F.size("all_spans") - F.size("base")).cast("long").alias("n_random"))
