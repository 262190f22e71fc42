"""Search, pages, mixing and the pipeline."""

import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from airway.llm import decontamination, html_extraction, mixing
from airway.llm import queries as registered
from airway.sources.staging import work_root
from tests.helpers import plain

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registered.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(registered.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == want


# search


def plain_search(text, items, window):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    doc, hit, found = words(text), set(), set()
    for name, item in items:
        item = words(item)
        n = min(window, len(item))
        for i in range(len(item) - n + 1) if n else ():
            for k in range(len(doc) - n + 1):
                if doc[k : k + n] == item[i : i + n]:
                    hit |= set(range(k, k + n))
                    found.add("" if name is None else str(name))
    return len(doc), hit, sorted(found)


@pytest.mark.parametrize("pass_words", [2_000_000, 8])
def test_search_equals_plain_search(spark, docs_of, pass_words):
    rng = random.Random(3)

    def text(n):
        return " ".join(rng.choice(["a", "b", "A,", "é", "b-a", "7"]) for _ in range(n))

    items = [(10, text(6)), (2, text(3)), (7, "b"), (None, "é é é"), (3, None), (4, " ,. "), (10, text(4)), (2, text(3)), (11, text(12))]
    rows = [(i, text(rng.randrange(0, 60))) for i in range(25)] + [(90, None), (91, ""), (None, "é é é"), (3, "b b b"), (3, "b b b")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_benchmark(docs_of(rows), benchmark, window=4, pass_words=pass_words).collect()
    got = sorted((r["id"] if r["id"] is not None else -1, r["n_words"], str([(h["from"], h["to"]) for h in r["hits"]]), r["items"]) for r in found)

    def ranges(hit):
        starts = [i for i in sorted(hit) if i - 1 not in hit]
        return [(a, next(b for b in range(a, a + 999) if b not in hit)) for a in starts]

    want = []
    for i, t in rows:
        n, hit, names = plain_search(t, items, 4)
        want.append((i if i is not None else -1, n, hit, names))
    assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in sorted(want, key=lambda w: (w[0], w[1], str(ranges(w[2]))))]
    covered = [{x for a, b in eval(g[2]) for x in range(a, b)} for g in got]  # noqa: S307
    assert covered == [w[2] for w in sorted(want, key=lambda w: (w[0], w[1], str(ranges(w[2]))))]


def test_search_with_empty_tables(spark, docs_of):
    empty = spark.createDataFrame([], "item_id long, text string")
    rows = [(1, "some words"), (2, None)]
    assert [r["items"] for r in decontamination.find_benchmark(docs_of(rows), empty).collect()] == [[], []]
    assert decontamination.without_contaminated(docs_of(rows), empty).count() == 2
    assert decontamination.find_benchmark(docs_of([]), empty).count() == 0


# pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="content"><h1>Title {n} &amp; more</h1><p>First  <b>bold<br>text</b> {n}&nbsp;here<p>Second {n}
<blockquote>Quoted {n}</blockquote><ul><li>one {n}<li>two {n}</ul>
<div class="box"><p>Follow our paper for more</p></div></div>
<aside>Side</aside><div class="comments"><p>Reader says</p></div><form><input value="q">Search</form>
<footer>&copy; site</footer><!-- note --></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, key string, host string, marks string, text string")


def test_main_text_without_template(spark):
    rows = [(n, f"https://a.example/{n}", PAGE.format(n=n), "k", "h", "m", "t") for n in range(12)]
    rows += [(50, "https://b.example/x", PAGE.format(n=50), "k", "h", "m", "t"), (51, None, None, None, None, None, None), (52, "", "", "", "", "", "")]
    rows += [(None, "https://a.example/3", PAGE.format(n=3), "k", "h", "m", "t"), (53, "https://c.example/", "<p>plain & simple", "", "", "", "")]
    found = {r["id"]: r for r in html_extraction.extract_main_text(pages(spark, rows)).collect()}
    want = "Title {n} & more\nFirst bold text {n} here\nSecond {n}\nQuoted {n}\none {n}\ntwo {n}"
    for n in range(12):
        assert found[n]["text"] == want.format(n=n)
    assert found[None]["text"] == want.format(n=3)
    assert found[50]["text"] == want.format(n=50) + "\nFollow our paper for more"
    assert (found[51]["text"], found[52]["text"], found[53]["text"]) == ("", "", "plain & simple")
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_copies_of_a_page_are_no_template(spark):
    page = "<body><article><h1>Head</h1><p>Story text</p></article></body>"
    rows = [(n, f"https://a.example/{n}", page, "", "", "", "") for n in range(40)]
    assert {r["text"] for r in html_extraction.extract_main_text(pages(spark, rows)).collect()} == {"Head\nStory text"}


def test_article_is_read_where_marked_and_broken_markup_ends(spark):
    broken = "<div class='x" + "<a title=\"" * 2000 + "<div>" * 5000 + "deep"
    rows = [
        (1, "u", "<body class='has-sidebar'><p>Teaser</p><main><article class='post ad-free'><header><h1>H</h1></header><p>A<p>B</article>"
         "<article class='comment'><p>C</p></article></main>", "", "", "", ""),
        (2, "u", broken, "", "", "", ""),
        (3, "u", "<p>one<!-- never closed <p>two", "", "", "", ""),
    ]
    found = {r["id"]: r["text"] for r in html_extraction.extract_main_text(pages(spark, rows)).collect()}
    assert found[1] == "H\nA\nB"
    assert found[3] == "one"


def test_main_text_of_supplied_pages(spark, table):
    found = {r["page_id"]: r["text"] for r in registered.op8_main_text(spark, SF).collect()}
    for r in table("pages").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        import html

        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
        assert found[r["page_id"]] == "\n".join(b for b in blocks if b)


# mixing


def test_poisson_counts_follow_their_mean(spark, docs_of):
    docs = docs_of([(i, "xxxx") for i in range(4000)], "a").unionByName(docs_of([(10_000 + i, "xxxx") for i in range(100)], "b"))
    found = mixing.mix_sources(docs, targets={"a": 0.5, "b": 0.5})
    counts = {r["source"]: r["count"] for r in found.groupBy("source").count().collect()}
    assert abs(counts["a"] - 2050) < 5 * math.sqrt(2050)
    assert abs(counts["b"] - 2050) < 5 * math.sqrt(2050)
    assert found.groupBy("doc_id", "copy").count().where("count > 1").count() == 0
    again = mixing.mix_sources(docs, targets={"a": 0.5, "b": 0.5})
    assert sorted(found.select("doc_id", "copy").collect()) == sorted(again.select("doc_id", "copy").collect())


def test_inversion_equals_the_distribution(spark):
    means = spark.createDataFrame([(m,) for m in (0.0, 0.3, 1.0, 7.5, 15.99)], "mean double")
    for r in means.withColumn("cdf", mixing.poisson_table(means["mean"])).collect():
        p = [math.exp(-r["mean"]) * r["mean"] ** k / math.factorial(k) for k in range(30)]
        assert r["cdf"][:30] == pytest.approx([sum(p[: k + 1]) for k in range(30)])
        assert len(r["cdf"]) == mixing.STEPS + 1


def test_mixing_edges(spark, docs_of):
    rows = [(1, "abc"), (1, "abc"), (None, "abc"), (2, None), (3, "")]
    docs = docs_of(rows, None).withColumnRenamed("key", "copy")
    found = mixing.mix_sources(docs, epochs=40.0).collect()
    assert {r["doc_id"] for r in found} == {1, None, 2, 3}
    assert sorted(found[0].asDict()) == sorted([*docs.columns, "place"])
    assert mixing.mix_sources(docs_of([])).count() == 0
    assert mixing.mix_sources(docs_of([(1, None), (2, "")])).count() == 0


# pipeline


def test_stages_keep_columns_and_take_effect(spark, table):
    docs = table("documents").withColumn("node", F.col("doc_id"))
    counts = [docs.count()]
    for _name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        if stage is not corpus_pipeline.mixing:
            assert made.columns == docs.columns
        made.write.parquet(path := f"{work_root(spark)}/stage-{random.randrange(1 << 60)}")
        docs = spark.read.parquet(path)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] > 0
    assert "AKIA" not in "".join(r["text"] for r in docs.collect())
    assert corpus_pipeline.run(spark, SF).count() == counts[5]


def test_stages_on_edges_and_empty_tables(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "tie tie"), (3, "tie tie"), (4, "x" * 200_000)]
    for given in (rows, []):
        for _name, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs_of(given), SF)
            assert made.columns == docs_of(given).columns
            made.collect()
