import html
import re
import time

import pytest

from locusweave.llm import html_text as H
from locusweave.llm import queries

from .conftest import DATA, needs_data

PROSE = "A sentence of some length stands here, with commas. And it goes on for a while. "


@pytest.fixture(scope="module")
def model():
    counts = H.Counter()
    for page, labels in H.built_pages():
        H.count_page(counts, page, labels)
    return H.TreeModel.from_counts(counts)


@pytest.mark.parametrize("source, want", [
    ("", ""), ("plain text only. Yes.", "plain text only. Yes."), ("<p>One<p>Tw<b>o</b> &amp; &lt;3&nbsp;x", "One Two & <3 x"),
    (f"<body><nav><a>x</a></nav><main><h1>Head</h1><p>{PROSE}<br>end</p></main><aside>{PROSE}</aside></body>", f"Head {PROSE}end"),
    (f"<article><p>{PROSE}</p><div class='ad'>Buy now.</div><p>{PROSE}</p><section class='comments'><p>{PROSE}</p></section></article>", f"{PROSE}{PROSE.strip()}"),
    (f"<div id='cookie-notice'>We use cookies.</div><div class='post'><p>{PROSE}</p></div><form><label>Mail</label></form>", PROSE.strip()),
    (f"<article><p>{PROSE}</p><footer>by X</footer></article>", PROSE.strip()),
    ("<script>var t='</p><article>no</article>';</script><style>p{}</style><!-- <p>no</p> -->", ""),
])
def test_pages(model, source, want):
    assert model.extract(source) == want


@pytest.mark.parametrize("before", ["<svg viewBox='0 0 1 1'/>", "<math/>", "<object data=x>", "<noscript><img src=x>", "<template>", "<svg><path d='M0'/><title>Icon</svg>",
                                    "<svg><style>a{}</svg>", "<svg><path d='M0'>", "<svg><title/><script href=x /></svg>"])
def test_embedded_elements_hide_no_text(model, before):
    assert model.extract(f"<body>{before}<article><p>{PROSE}</p></article></body>") == PROSE.strip()
    assert model.extract(f"<article><p>{PROSE}{before}</p><p>{PROSE}</p></article>") == f"{PROSE}{PROSE.strip()}"
    assert model.extract(f"<article><p>{PROSE}</p>{before}<p>{PROSE}</p></article><p><svg></svg></p>") == f"{PROSE}{PROSE.strip()}"


@pytest.mark.parametrize("inner, want", [
    ("<math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math>", "x = 1 2"), ("<object data=x>Shown instead.</object>", "Shown instead."),
    ("<noscript>Read this.</noscript>", "Read this."), ("<object><p>In it.</p></object>", "In it."), ("wo<svg><g><path d='M0'/></g></svg>rd", "word"),
])
def test_embedded_text_is_kept(model, inner, want):
    assert model.extract(f"<article><p>{PROSE}{inner} Then more.</p></article>") == f"{PROSE}{want} Then more."


@pytest.mark.parametrize("source, want", [
    ("<p class=it's>Hello it's fine.</p>", "Hello it's fine."), ('<p><a href="x"">two</a> "three".</p>', 'two "three".'), ("<p title='a>b' data-x=\"<p>\">One.</p>", "One."),
    ('<p><a href=/q?a="b>One</a> and "two".</p>', 'One and "two".'), ('<p title="open>One.</p>', "One."), ("<p ' id = 'x>y' \">One's.</p>", "One's."), ('<p title="a>One "two.', 'One "two.'),
])
def test_stray_quotes_in_tags(source, want):
    assert "".join(run for _, run in H.parse(source).runs) == want


def test_names_of_odd_attributes():
    assert H._names(""" class=side"bar id='main text' title="class=menu" hidden""") == {"side", "bar", "sidebar", "main", "text", "hidden"}
    assert H._names(' href="x"" class = "nav"/') == {"nav"} == H._names(" class=nav/")


def test_marginals_equal_enumeration(model):
    page = H.parse(f"<body><div class='menu'><p>Short</p></div><div><p>{PROSE}</p><ul><li>One</li></ul></div></body>")
    edges = [model.edge(node) for node in page.nodes]
    n = len(page.nodes)
    total, content = 0.0, [0.0] * n
    for labels in range(1 << n):
        bits = [labels >> i & 1 for i in range(n)]
        weight = 1.0
        for i, node in enumerate(page.nodes):
            weight *= edges[i][bits[node.parent] if i else 0][bits[i]]
        total += weight
        for i in range(n):
            content[i] += weight * bits[i]
    assert model.marginals(page) == pytest.approx([c / total for c in content], rel=1e-9)


def test_deep_and_long_pages_end(model):
    for source in (f"<p>{PROSE}</p>", f"<div>{PROSE}</div>"):
        once = model.extract(f"<body><div>{source}</div></body>")
        assert model.extract("<body>" + "<div>" * 100_000 + source + "</div>" * 100_000 + "</body>") == once
    assert model.extract("<div>" * 100_000 + f"<p>{PROSE * 3}</p>" + "</div>" * 100_000) == (PROSE * 3).strip()
    assert len(model.extract("<article>" + f"<p>{PROSE}</p>" * 5000 + "</article>")) == 5000 * len(PROSE) - 1


@pytest.mark.parametrize("source", [
    "<div>" * 100_000 + f"<p>{PROSE}</p>", "<div>" * 20_000 + "</b>" * 200_000 + f"<p>{PROSE}</p>", "<ul><li>" * 50_000 + f"<p>{PROSE}</p>",
    "<a " * 300_000, "<svg>" + "<style>x" * 100_000, "<b>" * 200_000 + PROSE,
])
def test_time_grows_with_the_page_not_its_depth(source):
    start = time.process_time()
    H.parse(source)
    assert time.process_time() - start < 10  # walking the open elements for every tag takes minutes


def test_sample_holds_one_page_per_id(spark):
    pages = spark.createDataFrame([(1, f"<article><p>{PROSE} {i}</p></article>") for i in range(50)] + [(None, "<main>x</main>")], "page_id long, html string")
    assert H.fit(pages, 5).potentials.keys() == H.fit(pages.where("html like '%0</p>%'"), 5).potentials.keys()


def test_rows_with_nulls_repeats_and_other_columns(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (2, "u", "", "x"), (3, "u", f"<article><p>{PROSE}</p></article>", "x"), (3, "u", f"<article><p>{PROSE}</p></article>", "x"), (None, None, "<nav>a</nav>", "x")],
                                  "page_id long, url string, html string, TEXT string")
    got = sorted((tuple(r) for r in H.extract_pages(pages).collect()), key=str)
    assert got == sorted([(1, None, ""), (2, "u", ""), (3, "u", PROSE.strip()), (3, "u", PROSE.strip()), (None, None, "")], key=str)
    assert H.extract_pages(pages.limit(0)).count() == 0


@needs_data
def test_query_finds_the_articles(spark):
    def article(source):
        inner = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
        return " ".join(html.unescape(re.sub("<[^>]+>", "", re.sub("</?(p|h1|br)>", " ", inner))).split())

    want = {r.page_id: article(r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = queries.op3_html_text(spark, DATA).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)
