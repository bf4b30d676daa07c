import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martloom.llm import language_id as lang
from martloom.llm.queries import QUERIES, read


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return lang.train(read(spark, sf_dir, "documents").where("doc_id % 2 = 0"))


def records(docs):
    return docs.select(
        "doc_id", "text", F.lit(None).cast("string").alias("declared"), F.lit("").alias("host"), F.lit("").alias("suffix")
    )


def test_held_out_accuracy(spark, sf_dir, model):
    docs = read(spark, sf_dir, "documents").where("doc_id % 2 = 1")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = lang.identify(records(docs), *model).collect()
    assert len(rows) == len(truth)
    assert sum(r.lang == truth[r.doc_id] for r in rows) >= 0.95 * len(rows)
    assert sum(r.text_lang == truth[r.doc_id] for r in rows) >= 0.93 * len(rows)


def test_query_covers_documents_and_pages(spark, sf_dir):
    rows = QUERIES["op8_language_id"](spark, sf_dir).collect()
    docs = {r.doc_id: r.lang for r in read(spark, sf_dir, "documents").collect()}
    assert {r.doc_id for r in rows} - {None} == docs.keys()
    assert len([r for r in rows if r.doc_id is None]) == read(spark, sf_dir, "pages").count()
    right = sum(r.lang == docs[r.doc_id] for r in rows if r.doc_id is not None)
    assert right >= 0.98 * len(docs)
    pages = [r for r in rows if r.page_id is not None]
    assert sum(r.lang == r.declared for r in pages) >= 0.95 * len(pages)
    assert sum(r.kept for r in rows) >= 0.98 * len(rows)


def plain_fusion(rows, langs):
    """rows: (scores, declared, host, suffix); the same model in plain Python."""
    guess = [max(range(len(langs)), key=lambda i: r[0][i]) for r in rows]
    total = Counter(guess)
    out = []
    for r, own in zip(rows, guess):
        logs = []
        for i in range(len(langs)):
            world = (total[i] + 1) / (len(rows) + len(langs))

            def count(column, value):
                same = [g for x, g in zip(rows, guess) if x[column] == value]
                return same.count(i) - (own == i), len(same) - 1

            k = lang.PRIOR_RECORDS
            n, size = count(3, r[3])
            suffix = (n + k * world) / (size + k)
            n, size = count(2, r[2])
            host = (n + k * suffix) / (size + k)
            same = [g for x, g in zip(rows, guess) if x[1] == r[1]]
            declares = (same.count(i) + k * len(same) / len(rows)) / (total[i] + k)
            logs.append(math.log(host) + math.log(declares) + r[0][i] / lang.TEMPER)
        top = max(logs)
        out.append((langs[logs.index(top)], 1 / sum(math.exp(x - top) for x in logs)))
    return out


def test_fusion_equals_plain_version(spark, sf_dir, model):
    langs, table = model
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        F.substring("text", 1, 12).alias("text"),
        F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("declared"),
        F.concat(F.lit("h"), F.col("doc_id") % 23).alias("host"),
        F.concat(F.lit("s"), F.col("doc_id") % 23 % 4).alias("suffix"),
    )
    scored = {r.doc_id: r for r in lang.text_scores(docs, langs, table).collect()}
    ids = sorted(scored)
    expected = plain_fusion(
        [(list(r.scores), r.declared, r.host, r.suffix) for r in (scored[i] for i in ids)], langs
    )
    found = {r.doc_id: r for r in lang.identify(docs, langs, table).collect()}
    for i, (name, posterior) in zip(ids, expected):
        assert found[i].posterior == pytest.approx(posterior, rel=1e-6)
        if posterior > 0.51:
            assert found[i].lang == name


def test_evidence_beyond_the_text_decides_where_text_is_silent(spark, model):
    rows = [(i, "Der die und das von einer ver schen keit ung", "de", "a.de", "de") for i in range(30)]
    rows += [(100 + i, "the and of ing tion that with here", "en", "b.com", "com") for i in range(30)]
    rows += [(200, None, "de", "a.de", "de"), (201, "", None, "b.com", "com"), (202, "12 34", None, "new.de", "de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string, suffix string")
    found = {r.doc_id: r.lang for r in lang.identify(frame, *model).collect()}
    assert (found[200], found[201], found[202]) == ("de", "en", "de")


def test_odd_rows(spark, make_docs, odd_rows, model):
    rows = lang.identify(records(make_docs(odd_rows)), *model).collect()
    assert len(rows) == len(odd_rows)
    assert all(r.lang in model[0] for r in rows)
    assert lang.identify(records(make_docs([])), *model).isEmpty()
    nothing = lang.train(make_docs([(1, "x", None, None), (2, None, "", "s")]))
    assert nothing[0] == []
    assert {r.lang for r in lang.identify(records(make_docs(odd_rows)), *nothing).collect()} == {None}


def test_page_parts(spark):
    html = "<!-- <html lang='xx'> --><HTML class=a lang = 'DE-at'><script>var en='</p>';</script>a<b>b</b><style>x{}</style>"
    row = spark.createDataFrame([(html, "HTTP://u@Www.Ex.co.UK:80/p.fr?x")], "html string, url string").select(
        lang.page_text(F.col("html")).alias("text"),
        lang.declared_language(F.col("html")).alias("declared"),
        lang.host_of(F.col("url")).alias("host"),
    ).first()
    assert row.text.split() == ["a", "b"] and row.declared == "de" and row.host == "www.ex.co.uk"
    empty = spark.createDataFrame([(None, None)], "html string, url string").select(
        lang.page_text(F.col("html")), lang.declared_language(F.col("html")), lang.host_of(F.col("url")),
        lang.suffix_of(lang.host_of(F.col("url"))),
    ).first()
    assert tuple(empty) == ("", None, "", "")


def test_every_labelled_language_is_learned(spark, make_docs):
    """300 language codes, more than were once kept, the last ones with the least text."""
    stems = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + i * 7 % 26)}" for i in range(300)]
    text = lambda i: f"{stems[i]} " * (700 - i)
    docs = make_docs([(i, text(i), f"l{i:03}", "s") for i in range(300)])
    langs, table = lang.train(docs)
    assert langs == [f"l{i:03}" for i in range(300)] and table.shape == (300, lang.BUCKETS)
    found = {r.doc_id: (r.text_lang, r.lang) for r in lang.identify(records(docs), langs, table).collect()}
    assert found == {i: (f"l{i:03}", f"l{i:03}") for i in range(300)}


def test_columns_named_like_the_operators_own(spark, model):
    """They stay as they are, but for those named like results, which are replaced."""
    names = ["guess", "scores", "host_n", "suffix_by", "logs", "top", "_key", "n", "record", "fold", "_model", "a.b"]
    fields = ", ".join(f"`{n}` string" for n in names)
    rows = [(i, "the and of ing tion that with here", "en", "b.com", "com", "mine", *names) for i in range(3)]
    frame = spark.createDataFrame(
        rows, f"doc_id long, text string, declared string, host string, suffix string, lang string, {fields}"
    )
    for langs, table in (model, ([], model[1])):
        found = lang.identify(frame, langs, table).collect()
        assert [tuple(r[n] for n in names) for r in found] == [tuple(names)] * 3
        assert {r["lang"] for r in found} == ({"en"} if langs else {None})


def test_a_text_is_not_judged_by_itself(spark):
    """Two labels on one vocabulary each; a text with a wrong label agrees with the other texts of its
    words once its own fold is left out, and its copies with it."""
    rows = [(i, "der die und das von einer ver schen", "de", i % 2) for i in range(4)]
    rows += [(10 + i, "the and of ing tion that with here", "en", i % 2) for i in range(4)]
    rows += [(20 + i, "qqq zzz xxx der und", "en", 0) for i in range(50)]
    texts = spark.createDataFrame(rows, "doc_id long, text string, lang string, fold int")
    langs, models = lang.train(texts, folds=2)
    assert langs == ["de", "en"] and models.shape == (3, 2, lang.BUCKETS)
    whole = lang.train(texts)
    assert (whole[1] == models[2]).all()
    for k in (0, 1):
        assert (lang.train(texts.where(F.col("fold") != k))[1] == models[k]).all()
    scored = lang.text_scores(texts.withColumn("fold", F.when(F.col("doc_id") != 21, F.col("fold"))), langs, models)
    best = {r.doc_id: langs[list(r.scores).index(max(r.scores))] for r in scored.collect()}
    assert best[20] == "de" and best[21] == "en"


def test_labels_with_odd_characters(spark):
    texts = spark.createDataFrame([("a:b", "one two"), ("\n", "three four")], "lang string, text string")
    assert lang.train(texts)[0] == ["\n", "a:b"]


def test_declaration_in_a_comment_does_not_count(spark):
    pages = ["<!-- <html lang=en> --><html lang=fr>", "<!-- <html lang=en>", "<html lang=es><!-- <html lang=en> -->", ""]
    frame = spark.createDataFrame([(p,) for p in pages], "html string")
    found = [r[0] for r in frame.select(lang.declared_language(F.col("html"))).collect()]
    assert found == ["fr", None, "es", None]
