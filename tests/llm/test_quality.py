import contextlib
import io

from pyspark.sql import functions as F

import duck
import messy
from conftest import SF_MID
from tastemap.llm import quality
from tastemap.llm.frames import saved

COLS = ["doc_id", "text", "lang", "source"]


def compare(docs):
    got = quality.judge(docs).drop("text_key").collect()
    duck.same(got, duck.rows(quality.OP8_SQL, documents=docs.select(*COLS).toArrow()))
    return got


def test_awkward_rows(spark):
    got = compare(messy.docs(spark))
    assert len(got) == len(messy.TEXTS)
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (3, 4, 5, 6))


def test_counts_by_hand(spark):
    text = "a b c x a b c\n\na b c\n \nq&#\na b c\nz z z z z"
    d = spark.createDataFrame([(1, text, "en", "s")], messy.SCHEMA)
    r = compare(d)[0]
    # windows a b c (four times), b c x..., z z z (three times, overlapping)
    assert (r.n_words, r.n_symbols, r.n_dup_lines) == (19, 2, 1) and r.n_repeat_words == 17


def test_one_group_many_sizes(spark):
    """Large and small groups blend their own, their language's and the corpus' limits."""
    rows = []
    for i in range(700):
        lang, source = ("en", "big") if i < 400 else ("en", f"s{i % 9}") if i < 560 else ("xx", "few")
        noise = "# " * (i % 40 if i % 10 == 0 else 0)
        rows.append((i, noise + " ".join(f"w{(i * 31 + j * j) % 701}" for j in range(60 + i % 50)), lang, source))
    got = compare(spark.createDataFrame(rows, messy.SCHEMA))
    assert 0 < sum(not r.kept for r in got) < 200


def test_limits_move_smoothly_with_the_group(spark):
    """One more document moves a group's limit little, also at PRIOR documents; by hand: the blend of three levels."""
    def limit(n):
        rows = [(i, 0, 0, 0, 100, 400 + 8 * i % 97, "en", "a") for i in range(n)] + [(i, 0, 0, 0, 100, 700 + 5 * i % 83, "en", "b") for i in range(500)]
        rows += [(i, 0, 0, 0, 100, 900, "xx", "c") for i in range(50)]
        d = spark.createDataFrame(rows, "id long, n_symbols long, n_dup_lines long, n_repeat_words long, n_words long, word_chars long, lang string, source string")
        d = d.withColumn("n_lines", F.lit(1).cast("long"))
        sk = quality.sketches(d)
        own, lang, corpus = (quality.limits(quality.merged(x, *k), *k) for x, k in (
            (sk, ("lang", "source")), (sk, ("lang",)), (sk.withColumn("g", F.lit(0)), ("g",))))
        o, e, c = (x.first() for x in (own.filter("source = 'a'"), lang.filter("lang = 'en'"), corpus))
        got = quality.group_limits(d).filter("source = 'a'").first().hi_word_length
        p = quality.PRIOR
        want = (o.size * o.hi_word_length + p * (e.size * e.hi_word_length + p * c.hi_word_length) / (e.size + p)) / (o.size + p)
        assert abs(got - want) < 1e-9 and min(o.hi_word_length, e.hi_word_length, c.hi_word_length) < got
        return got
    assert abs(limit(100) - limit(99)) < 0.1


def test_labels_agree(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = compare(docs)
    quality_of = {r.doc_id: r.quality for r in labels.collect()}
    good = [r for r in got if quality_of.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in got if quality_of.get(r.doc_id) == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good) and sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_sketches_add_up(spark):
    """The sketch of all rows equals the sum of the sketches of any split."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").withColumnsRenamed({"lang": "l", "source": "s"})
    rows = quality.with_counts(docs).selectExpr("'x' as lang", "'y' as source", "n_lines", *quality.COUNTS, "doc_id")
    rows = saved(rows, "counts")
    whole = quality.merged(quality.sketches(rows), "lang")
    halves = quality.sketches(rows.filter("doc_id % 2 = 0")).unionAll(quality.sketches(rows.filter("doc_id % 2 = 1")))
    assert messy.by_row(whole.collect(), "measure", "bucket", "n") == messy.by_row(quality.merged(halves, "lang").collect(), "measure", "bucket", "n")


def test_empty_table(spark):
    assert compare(messy.docs(spark, [])) == []


def test_no_python_in_the_plan(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        quality.with_counts(messy.docs(spark)).explain()
    assert "Python" not in buf.getvalue() and "Pandas" not in buf.getvalue() and "Arrow" not in buf.getvalue()
