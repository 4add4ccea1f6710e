from collections import Counter, defaultdict

import pytest

from skylattice.llm import site_lines as L

SCHEMA = "page_id long, url string, html string, host string, text string, lines int"


def page(i, url, *lines):
    return (i, url, "<html><body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body></html>", "h", "t", 1)


ODD = [
    *[page(i, f"http://Hot.example/{i}", "menu", f"own {i}", "menu", "rare" if i < 3 else f"x{i}") for i in range(30)],
    page(40, "https://user@small.example:80/a", "menu", "b"),
    page(41, "https://small.example/b", "menu", "c"),
    page(41, "https://small.example/b", "menu", "c"),
    page(42, None, "menu", "menu"),
    page(43, "not a url", "menu"),
    (44, "http://hot.example/none", None, None, None, None),
    (45, "http://hot.example/empty", "", None, None, None),
    (None, "http://hot.example/x", "<p>menu<p>" + "long " * 20_000, None, None, None),
]


def expected(rows, ratio=L.RATIO, least=L.PAGES):
    pages, shown = Counter(h for _, h, _ in rows), defaultdict(Counter)
    for _, h, lines in rows:
        shown[h].update(set(lines))
    out = []
    for i, h, lines in rows:
        kept = [x for x in lines if h is None or shown[h][x] < least or shown[h][x] <= ratio * pages[h]]
        out.append((i, h, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def cut(df):
    return [tuple(r) for r in df.select("page_id", L.host(), L.lines()).collect()]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    got = sorted((tuple(r) for r in L.drop_lines(df).collect()), key=str)
    assert got == expected(cut(df))
    texts = {(r[0], r[1]): r[2] for r in got}
    assert texts[5, "hot.example"] == "own 5\nx5" and texts[1, "hot.example"] == "own 1\nrare"
    assert texts[40, "small.example"] == "b" and texts[42, None] == "menu\nmenu"


def test_empty_table(spark):
    assert L.drop_lines(spark.createDataFrame(ODD, SCHEMA).where("false")).collect() == []


@pytest.mark.parametrize("ratio,least", [(0.0, 1), (0.5, 1), (1.0, 1)])
def test_parameters(spark, ratio, least):
    df = spark.createDataFrame(ODD, SCHEMA)
    got = sorted((tuple(r) for r in L.drop_lines(df, ratio, least).collect()), key=str)
    assert got == expected(cut(df), ratio, least)


@pytest.mark.parametrize(
    "html,lines",
    [
        ("<p>a</p><p> b  c </p>", ["a", "b  c"]),
        ("a<br>b<BR/>c", ["a", "b", "c"]),
        ("a<b>b</b> c", ["ab c"]),
        ("<script>var t='<p>x</p>';</script>y<!-- <p>z</p> --><style>p{}</style>", ["y"]),
        ("&lt;p&gt; &amp;lt; &quot;q&quot; &#39;&nbsp;", ["<p> &lt; \"q\" '"]),
        ("a\r\nb\t\n\n c", ["a", "b", "c"]),
        ("<pre>x</pre><param>y", ["x", "y"]),
        ("", []),
    ],
)
def test_lines(spark, html, lines):
    assert spark.createDataFrame([(html,)], "html string").select(L.lines()).first()[0] == lines


def test_main_path_is_free_of_python(spark):
    plan = L.drop_lines(spark.createDataFrame(ODD, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
