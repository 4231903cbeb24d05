"""Attributes, nested elements and character references against Python's own rules and by hand."""

import html
import html.entities

from pyspark.sql import functions as F

from coursewise.functions import markup
from coursewise.operators import pages


def test_references_are_decoded_as_html_says(spark):
    texts = ["&amp;quot; &amp;amp;", "&#x27;&#X41;&#65;&#8364;&#128512;", "&eacute;&Eacute; &eacute &notit; &not;in; &nosuch; & &; &#; &#x; &#xg", "&#0;&#128;&#159;&#xD800;&#x110000;&#99999999;&#13;&#11;",
             "a&b&copy", "&lt;b&gt;&nbsp;&hearts;&CounterClockwiseContourIntegral;", "", "no reference", "&quot;&#34;&#39;", "&ampamp;", "100&#37"]
    texts += [f"&{n}" for n in list(html.entities.html5)[::37]]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", markup.unescape(F.col("t")).alias("u")).collect()
    assert {r.t: r.u for r in rows} == {t: html.unescape(t) for t in texts} | {None: None}


def one(spark, page, column):
    return spark.createDataFrame([(page,)], "p string").select(column.alias("c")).first().c


def test_attributes_in_any_order_quotes_and_case(spark):
    p = F.col("p")
    for tag in ('<META content="9.99" name=x property="a:b">', "<meta property='a:b' content='9.99'/>", '<meta data-x="p > q property=\'no\'" PROPERTY=a:b  CONTENT = 9.99 >', '<meta\nproperty="a:b"\ncontent="9&#46;99">'):
        page = f'<meta name="a:b" content="1"><meta property="other" content="2"><meta content="3" title=\'property="a:b"\'>{tag}<meta property="a:b" content="4">'
        assert one(spark, page, markup.attribute(markup.first_tag(p, markup.opening("property", "a:b", "meta")), "content")) == "9.99"
    assert one(spark, "<meta property='a:b'>", markup.attribute(markup.first_tag(p, markup.opening("property", "a:b", "meta")), "content")) is None
    assert one(spark, "<p>none</p>", markup.first_tag(p, markup.opening("property", "a:b"))) is None


def test_elements_end_at_their_own_closing_tag(spark):
    p, box = F.col("p"), markup.opening("class", "box")
    assert one(spark, "x<div class=box>a<div>b<div>c</div></div>d</div>e", markup.first_element(p, box)) == "a<div>b<div>c</div></div>d"
    assert one(spark, "<SPAN class='box'>a<div>b</div><span>c</SPAN>d</span>e", markup.first_element(p, box)) == "a<div>b</div><span>c</SPAN>d"
    assert one(spark, "<div class='box'>never <b>closed", markup.first_element(p, box)) == "never <b>closed"
    assert one(spark, "<divider class='box'>a</divider><div>", markup.first_element(p, box)) == "a"
    assert one(spark, "<div class='boxes'>a</div>", markup.first_element(p, box)) is None
    nested = "<i><span>a<span>b</span></span></i><span/><span x='>'>c</span>"
    assert one(spark, nested, markup.elements(p, r"(?is)<span(?=[\s/>])")) == ["a<span>b</span>", "b", "<span x='>'>c</span>", "c"]
    assert one(spark, " a <b> 1,0 </b> 00 <!-- x -->&euro;", markup.text(p, strip=True)) == "a1,000€"
    hidden = "<script>'<i class=box>'</script><!-- <i class=box> --><b title='<i class=box>0</i>'>t</b><i class=box>1</i>"
    assert one(spark, hidden, markup.first_element(markup.visible(p), box)) == "1"


def test_listing_markers(spark):
    """Pieces between tags lose the white space around them, so "All <b>x</b> courses" reads "Allxcourses" and is none."""
    link = '<a href="/course/{}/">x</a>'
    markers = {"<h2>All Python courses</h2>": True, "<h1><b> All courses\n</b></h1>": True, "<div>All the <b>best</b> Python courses</div>": True,
               "<div><p>All</p></div><span>All of <i>our courses</i></span>": True, "<h2>All <b>Python</b> courses</h2>": False, "<p>All Python courses</p>": False,
               "<div>All Python courses <b>now</b></div>": False, "🙂🙂<h2>All Python courses</h2>": True}
    rows = [(i, "https://s.example/l", link.format("first") + m + link.format("second")) for i, m in enumerate(markers)]
    got = {}
    for r in pages.extract_links(spark.createDataFrame(rows, "page_id int, url string, html string")).collect():
        got.setdefault(r.page_id, set()).add(r.link.split("/")[-2])
    assert [got[i] for i in range(len(markers))] == [{"second"} if only else {"first", "second"} for only in markers.values()]
