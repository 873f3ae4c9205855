"""Pages nested deeper than an expression goes."""

from cohortloom.llm import wrapper


def fold(pages):
    out = None
    for p in pages:
        e = wrapper.expression(p)
        out = e if out is None else wrapper.align(out, e)
    return wrapper.rule(out)


def deep(n, word, region="article"):
    inside = "<div>" * n + f"in {word}<nav>links<div>more</div></nav><p>still {word}" + "</div>" * n
    return f"<html><body><div><{region}><p>first {word}</p>{inside}<p>last {word}</p></{region}></div><div>foot</div></body></html>"


def test_hundred_nested_divs_in_an_article(spark):
    rows = [(i, "http://a.example/x", deep(100, w)) for i, w in enumerate(("one", "two", "three"))]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"first {w} in {w} still {w} last {w}" for i, w in enumerate(("one", "two", "three"))}


def test_nested_divs_on_both_sides_of_the_depth():
    for n in (0, 1, 50, 55, 56, 57, 60, 100, 3000):
        pages = [deep(n, w) for w in ("one", "two", "three")]
        assert wrapper.main_text(pages[1], fold(pages)) == "first two in two still two last two"


def test_deep_main_node_without_a_name():
    pages = ["<body>" + "<div>" * 100 + f"<p>{w} text</p><form>a form</form><p>{w} end</p>" + "</div>" * 100 + "<div>foot</div></body>" for w in ("one", "two", "three")]
    assert wrapper.main_text(pages[0], fold(pages)) == "one text one end"


def test_long_quoted_attributes():
    for n in (10, 9_998, 12_000, 300_000):
        for q in "\"'":
            image = f"<img src={q}data:{'x' * n} > y{q}>"
            pages = [f"<body><div><article><p>first {w}</p>{image}<script data-a={q}{'z' * n}>{q}>no text</script><p>last {w}</p></article></div></body>" for w in ("one", "two", "three")]
            assert wrapper.main_text(pages[1], fold(pages)) == "first two last two"


def test_quote_that_never_closes():
    page = "<body><article><p>a</p><p title=\"b>c</p>" + "<i x=>d</i>" * 20_000 + "</article></body>"
    assert wrapper.main_text(page, fold([page])).startswith("a c d")
