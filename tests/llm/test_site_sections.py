"""Templates of a part of a host."""

import pytest

from airway.llm import html_extraction


@pytest.mark.parametrize(("article", "others"), [(False, 290), (True, 40)])
def test_template_of_a_section_goes_whatever_the_size_of_the_host(spark, article, others):
    tag = "article" if article else "div"
    body = f"<body><{tag}><h1>Head {{n}}</h1><p>Story {{n}}</p>{{box}}</{tag}></body>"
    box = "<div><p>Read the shop news every week</p></div>"
    rows = [(n, f"https://a.example/shop/x{n % 2}/{n}?p=1", body.format(n=n, box=box)) for n in range(20)]
    rows += [(n, f"https://a.example/{'' if n % 3 else 'news/'}{n}", body.format(n=n, box="")) for n in range(100, 100 + others)]
    rows += [(999, "https://a.example/other/999", body.format(n=999, box=box)), (1000, None, body.format(n=1000, box=box))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["id"]: r["text"] for r in html_extraction.extract_main_text(pages).collect()}
    assert all(found[n] == f"Head {n}\nStory {n}" for n, _, _ in rows if n < 999)
    assert found[999].endswith("every week") and found[1000].endswith("every week")
