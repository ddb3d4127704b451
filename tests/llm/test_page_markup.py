"""Main text where the markup says too little or too much."""

from hearth.llm import html_extract


def texts(spark, bodies, host="h.org"):
    rows = [(i, f"http://{host}/a/{i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    return [r.text for r in sorted(got.collect())]


def test_differencing_decides_beside_and_inside_content(spark):
    def teasers(story, card):
        return f"<p>Site line</p><div><h1>{story}</h1><p>body of {story}</p></div><article>{card}</article><p>Bottom line</p>"

    def shared(story):
        return f"<main><p>Follow our channel</p><h1>{story}</h1><p>body of {story}</p><p>All prices with tax</p></main>"
    assert texts(spark, [teasers("one", "card x"), teasers("two", "card y")]) == [
        "one\nbody of one\ncard x", "two\nbody of two\ncard y"]
    assert texts(spark, [shared("one"), shared("two")]) == ["one\nbody of one", "two\nbody of two"]
    copy = "<p>Site line</p><article><h1>same</h1><p>copied story</p></article>"
    assert texts(spark, [copy, copy]) == ["same\ncopied story"] * 2


STORY = "<h1>Head</h1><p>first part</p><p>second part</p>"


def test_states_of_a_page_are_no_furniture(spark):
    wraps = ["content has-sidebar", "no-sidebar", "header-fixed wrapper", "main share-enabled", "cookie-accepted", "page with-search"]
    for i, got in enumerate(texts(spark, [f'<div class="{w}" id="page{i}">{STORY}<p>end {i}</p></div>' for i, w in enumerate(wraps)])):
        assert f"end {i}" in got
    alone = [texts(spark, [f'<div class="{w}"><article>{STORY}</article></div>'], f"h{i}.org")[0] for i, w in enumerate(wraps + ["header", "sidebar", "menu"])]
    assert alone == ["Head\nfirst part\nsecond part"] * len(alone)


def test_heads_and_paragraphs_of_a_text_stay(spark):
    page = ('<article><div class="post-header"><h1 class="banner">Title</h1></div><div class="entry-header">By line</div><div class="header">Lead</div>'
            + "".join(f'<p class="{c}">{c} text</p>' for c in ("social", "related", "search", "notice", "form")) + "</article>")
    assert texts(spark, [page]) == ["Title\nBy line\nLead\nsocial text\nrelated text\nsearch text\nnotice text\nform text"]


def test_named_furniture_still_goes(spark):
    names = ["ad", "site-header", "sidebar", "left-sidebar", "cookie-notice", "newsletter-signup", "adContainer", "social-links", "post-comments",
             "breadcrumbs", "main-nav", "share-buttons", "widget_2", "search-form"]
    page = "".join(f'<div class="{n}"><p>x {n}</p></div>' for n in names) + '<div id="comments"><article><p>a comment</p></article></div>'
    assert texts(spark, [page + '<div class="cookie-notice"><div class="content">We use</div></div><p class="ad">buy</p>' + STORY]) == [
        "Head\nfirst part\nsecond part"]
