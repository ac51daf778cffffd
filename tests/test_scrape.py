import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scrape


def pages(spark, *html):
    return spark.createDataFrame([(f"u{i}", h) for i, h in enumerate(html)], "url string, html string")


def field(spark, html, *path):
    return scrape.extract_fields(pages(spark, html), {"f": path}).first()["f"]


@pytest.mark.parametrize(
    "html, path, expected",
    [
        ('<div class="a"> x </div>', [("div", "class", "a")], "x"),
        ("<div class='b a c'>x</div>", [("div", "class", "a")], "x"),
        ('<div class="ab">no</div><div class="a">x</div>', [("div", "class", "a")], "x"),
        ('<div class="temp h1">no</div><div class="h1 temp">x</div>', [("div", "class", "h1 temp")], "x"),
        ('<div id="1" class="a" data-x="2">x</div>', [("div", "class", "a")], "x"),
        ('<div data-class="a">no</div><div class="a">x</div>', [("div", "class", "a")], "x"),
        ('<divider class="a">no</divider><div class="a">x</div>', [("div", "class", "a")], "x"),
        ('<div class="a">1<div>2<div>3</div>4</div>5</div>6', [("div", "class", "a")], "12345"),
        ('<div class="a"><div>1</div><div>2</div></div><div>3</div>', [("div", "class", "a")], "12"),
        ('<DIV CLASS="a">x<DIV>y</DIV></DIV>z', [("div", "class", "a")], "xy"),
        ('<a class="home"><abbr>x</abbr>y</a>z', [("a", "class", "home")], "xy"),
        ('<a class="home"><i>x</i><span itemprop="name">City</span></a>', [("a", "class", "home"), ("span", "itemprop", "name")], "City"),
        ('<span itemprop="name">no</span><a class="home"></a>', [("a", "class", "home"), ("span", "itemprop", "name")], None),
        ('<!-- <p class="a">no</p> --><script>"<p class=\'a\'>no</p>"</script><p class="a">x</p>', [("p", "class", "a")], "x"),
        ('<p class="a">5&nbsp;&deg;C &amp;lt; &lt;b&gt;</p>', [("p", "class", "a")], "5 °C &lt; <b>"),
        ("<p>\n\t x y\n</p>", [("p",)], "x y"),
        ("<p>open", [("p",)], "open"),
        ("no tags", [("p",)], None),
    ],
)
def test_element_text(spark, html, path, expected):
    assert field(spark, html, *path) == expected


def test_long_pages_are_read_whole(spark):
    filler = "<div><p>word " * 20_000 + "</p></div>" * 20_000
    html = f'<html>{filler}<div class="a">{"<div>1</div>" * 20_000}</div><div>no</div></html>'
    assert field(spark, html, ("div", "class", "a")) == "1" * 20_000


METEOBLUE = """<a href="/x" class="home"><span itemprop="name"> Hilltop </span></a>
<div class="current-description"> 14:05 EET </div><div class="h1 current-temp"> -3 &deg;C </div>"""

SINOPTIK = """<h1 class="currentCity">СТАРИЯТ ГРАД</h1><span class="wfNonCurrentDate">21 ФЕВРУАРИ</span>
<span class="time">14:05</span><span class="wfCurrentTemp">7&deg;C</span>
<div class="wfCurrentWindContainer">Wind <div>west</div></div><span class="wfCurrentWind">4 m/s</span>"""

ACCUWEATHER = """<h1 class="header-loc">old TOWN, Old Town</h1>
<div class="content-module subnav-pagination"><div>SATURDAY, 21 FEBRUARY</div></div><p class="sub">2:05 PM</p>
<div class="display-temp">7&#176;<span>C</span></div><div class="phrase">Cloudy</div>
<div class="detail-item spaced-content"><div>Wind</div><div>W 11 km/h</div></div>"""


@pytest.mark.parametrize(
    "site, html, expected",
    [
        ("meteoblue", METEOBLUE, {"city": "Hilltop", "curr_time": "14:05 EET", "temperature": 3}),
        (
            "sinoptik", SINOPTIK,
            {"city": "Старият град", "curr_time": "14:05", "temperature": 7, "weather": "Wind west", "wind_m_s": 4, "curr_day": 21, "curr_month": "февруари"},
        ),
        (
            "accuweather", ACCUWEATHER,
            {"city": "Old town", "curr_time": "2:05 PM", "temperature": 7, "weather": "Cloudy", "weekday": "Saturday", "wind_m_s": 3, "curr_day": 21, "curr_month": "february"},
        ),
    ],
)
def test_sites(spark, site, html, expected):
    raw = scrape.scrape_site(pages(spark, html), site)
    assert scrape.transform_site(raw, site).first().asDict() == expected


def test_wind_is_taken_per_row(spark):
    raw = scrape.scrape_site(pages(spark, ACCUWEATHER, ACCUWEATHER.replace("11 km", "40 km")), "accuweather")
    assert sorted(r["wind_m_s"] for r in scrape.transform_site(raw, "accuweather").collect()) == [3, 11]


def test_unreadable_pages_are_set_apart(spark):
    raw = scrape.scrape_site(pages(spark, METEOBLUE, "<p>moved</p>"), "meteoblue", keep=("url",))
    good, bad = scrape.split_readable(raw, scrape.SCRAPED_IN["meteoblue"])
    assert [r["url"] for r in good.collect()] == ["u0"]
    assert [(r["url"], r["missing_fields"]) for r in bad.collect()] == [("u1", ["city", "curr_time", "temperature"])]


def test_declared_input_is_checked(spark):
    raw = spark.createDataFrame([("a", "b", 1)], "city string, curr_time string, temperature int")
    with pytest.raises(ValueError, match="Schema mismatch"):
        scrape.transform_site(raw, "meteoblue")


def test_nested_elements_are_read_in_linear_time(spark):
    import time

    from tidemark.functions.text import after_opening, before_closing, element_content

    def seconds(n):
        page = "<div>" + "<div>x</div>" * n + "</div>" + "<div>other</div>" * n
        df = spark.createDataFrame([(page,)], "html string").coalesce(1)
        rest = df.select(after_opening(F.col("html"), "div").alias("rest")).withColumn("head", before_closing(F.col("rest"), "div"))
        text = rest.select(F.length(element_content(F.col("rest"), F.col("head"), "div")).alias("n"))
        started = time.perf_counter()
        assert text.first()["n"] == 12 * n
        return time.perf_counter() - started

    seconds(100)
    half, whole = seconds(32_000), seconds(64_000)
    assert whole < max(3 * half, 2)


def test_hidden_parts_go_and_unclosed_ones_stay(spark):
    import re

    from tidemark.functions.text import visible_html

    plain = re.compile(r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>")
    marks = ["<!--", "-->", "<script>", "<SCRIPT a='b'>", "</script>", "</Script \n>", "</scriptx", "<style>", "</style>", "<!", "->", "<scripty>", "a", "é\n", "<p>", "\U0001f600"]
    rng = random.Random(7)
    pages = ["".join(rng.choice(marks) for _ in range(rng.randrange(14))) for _ in range(3000)] + ["<!-->", "<!--->", "--><!-- x", "<script></script"]
    found = spark.createDataFrame([(p,) for p in pages], "p string").select("p", visible_html(F.col("p")).alias("v")).collect()
    assert [(r.p, r.v) for r in found] == [(p, plain.sub("", p)) for p in pages]
    assert spark.sql("SELECT CAST(NULL AS STRING) AS p").select(visible_html(F.col("p"))).first()[0] is None


def test_unclosed_marks_cost_no_more_than_their_length(spark):
    import time

    from tidemark.functions.text import visible_html

    def seconds(page):
        df = spark.createDataFrame([(page,)], "p string").select(F.length(visible_html(F.col("p"))).alias("n"))
        started = time.perf_counter()
        assert df.first().n == len(page)
        return time.perf_counter() - started

    seconds("warm <!--")
    for mark in ("<!--", "<script ", "<style>"):
        assert seconds(mark * (640_000 // len(mark))) < 8
