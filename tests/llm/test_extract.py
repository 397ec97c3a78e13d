"""Extraction: block cutting, held-out accuracy, Viterbi against all labellings."""

import itertools

import numpy as np

from sedgeline.llm import extract as X


def test_blocks():
    page = '<title>no</title><p>a &amp;  b<br>c<p>d <b>e</b><script>var x="</p>"</script>f<!-- no --><ul><li>g<li>h</ul>1 < 2 &am'
    assert [b.text for b in X.leaf_blocks("<head>" + page.replace("<p>", "</head><p>", 1))] == ["a & b c", "d e f", "g", "h", "1 < 2 &am"]
    assert [b.text for b in X.leaf_blocks("<p>x<div cl")] == ["x"] and [b.text for b in X.leaf_blocks("<p>x<!-- y")] == ["x"]
    assert X.leaf_blocks("") == []


def test_held_out_pages():
    pages = X.labelled_pages(seed=4242, n=150)
    field = X.default_field()
    right = total = 0
    for page, y in pages:
        got = field.decode(X.leaf_blocks(page))
        right += sum(a == b for a, b in zip(got, y, strict=True))
        total += len(y)
    assert right / total > 0.97


# Written by hand, with names and skeletons of their own: (page, blocks that are main text). Features were chosen with
# these in view; those of FRESH were written afterwards and measured once.
BY_HAND = [
    (
        '<body><div class="c1"><div class="c2"><a href=/>Start</a> <a href=/b>Boats</a></div><div class="c3"><h1>Rowing on the lake</h1><p>The lake was quiet when we set out in the early morning, and the boat was heavy.</p><div class="promo-box">Oars at half price!</div><p>By noon the wind had turned, so that we had to row back along the shore.</p></div><div class="c4">All rights with the rowing club</div></div></body>',
        ["Rowing on the lake", "The lake was quiet when we set out in the early morning, and the boat was heavy.", "By noon the wind had turned, so that we had to row back along the shore."],
    ),
    (
        '<body><header><p>The Valley Paper</p></header><article><h1>New bridge opens</h1><p>After three years of work the new bridge over the river was opened on Sunday.</p><p>The mayor cut a ribbon, and a brass band played.</p></article><section class="reader-reactions"><h3>What others say</h3><p>I walked over it and it is a fine bridge, thanks to all.</p><p>Too narrow, if you ask me, and too late as well.</p></section><footer><p>Valley Paper, Mill Lane 4</p></footer></body>',
        ["New bridge opens", "After three years of work the new bridge over the river was opened on Sunday.", "The mayor cut a ribbon, and a brass band played."],
    ),
    (
        '<html><head><title>Soup</title></head><body><table id="frame"><tr><td class="menu"><a href="1">Soups</a><br><a href="2">Breads</a></td><td><div class="story"><h2>Leek soup</h2><p>Wash the leeks well, cut them into rings and let them soften in butter.</p><ul><li>three leeks</li><li>two potatoes</li></ul><p>Add the potatoes and the stock, and cook it all for half an hour.</p></div></td></tr></table><div id="cookie-banner"><p>This site keeps cookies. <a href="#">Fine</a></p></div></body></html>',
        ["Leek soup", "Wash the leeks well, cut them into rings and let them soften in butter.", "three leeks", "two potatoes", "Add the potatoes and the stock, and cook it all for half an hour."],
    ),
    (
        '<body><nav class="crumbs"><a href="/">Home</a> / <a href="/g">Garden</a></nav><main><div id="wrap9"><h1>When to cut roses</h1><p>Roses are cut in early spring, when the forsythia blooms and hard frost is over.</p><blockquote>Cut above an eye that looks outward.</blockquote><p>Old and dead wood is taken out first.</p></div><aside><h4>More to read</h4><ul><li><a href="/t">Tulips in pots</a></li><li><a href="/l">Lawns</a></li></ul></aside></main><form action="/s"><label>Your mail</label><button>Send</button></form></body>',
        ["When to cut roses", "Roses are cut in early spring, when the forsythia blooms and hard frost is over.", "Cut above an eye that looks outward.", "Old and dead wood is taken out first."],
    ),
]


FRESH = [
    (
        '<body><div id="masth"><span>Harbour Times</span></div><div class="lay"><div class="gx7"><h1>Ferry runs again</h1><div class="byl">By our reporter</div><p>The ferry to the island runs again since Monday, with a new engine and a new crew.</p><p>Tickets cost the same as before.</p><div class="recirc"><a href="/1">Ten harbours</a><a href="/2">Old ships</a></div><p>In winter there will be two crossings a day, weather allowing.</p></div><div class="gx8"><h4>Most read</h4><ul><li><a href="/a">Fish prices</a></li><li><a href="/b">Storm warning</a></li></ul></div></div><div class="legal-line">Harbour Times, all rights reserved</div></body>',
        ["Ferry runs again", "The ferry to the island runs again since Monday, with a new engine and a new crew.", "Tickets cost the same as before.", "In winter there will be two crossings a day, weather allowing."],
    ),
    (
        '<body><main role="main"><h1>Sharpening a plane iron</h1><p>Flatten the back first.</p><ol><li>Start on the coarse stone.</li><li>Raise a burr along the whole edge.</li><li>Go on to the fine stone.</li></ol><figure><img src="i.png"><figcaption>The burr, seen from the side.</figcaption></figure><p>Strop the edge on leather when you are done, and it will take shavings that you can read through.</p></main><section id="user-opinions"><h2>4 opinions</h2><div><p>Use water stones instead, they cut faster and stay cleaner.</p></div><div><p>Thanks, this worked.</p></div></section></body>',
        ["Sharpening a plane iron", "Flatten the back first.", "Start on the coarse stone.", "Raise a burr along the whole edge.", "Go on to the fine stone.", "The burr, seen from the side.", "Strop the edge on leather when you are done, and it will take shavings that you can read through."],
    ),
    (
        '<body><ul class="tabs"><li><a href="/n">News</a></li><li><a href="/w">Weather</a></li></ul><div class="entry-content"><h2>Rain until Friday</h2><p>A low over the sea brings rain to the whole coast until Friday evening.</p><table><tr><td>Thursday</td><td>12 mm</td></tr><tr><td>Friday</td><td>4 mm</td></tr></table><p>At the weekend it will be dry.</p></div><div class="nl-signup"><p>Get the weather by mail every morning.</p><form><input name="m"><button>Subscribe</button></form></div></body>',
        ["Rain until Friday", "A low over the sea brings rain to the whole coast until Friday evening.", "Thursday", "12 mm", "Friday", "4 mm", "At the weekend it will be dry."],
    ),
    (
        '<body><article><p>No title here, only a note that the library stays closed on Thursday.</p></article><div class="talk"><p>What a pity, I wanted to bring my books back on Thursday after work.</p><p>Use the box at the door, it is open all night long.</p></div></body>',
        ["No title here, only a note that the library stays closed on Thursday."],
    ),
]


def test_pages_written_by_hand():
    right(BY_HAND, 0.9)


def test_pages_written_afterwards():
    right(FRESH, 0.8)


def right(pages, least):
    field = X.default_field()
    hit = found = wanted = 0
    for page, main in pages:
        got = X.main_text(page, field).split("\n")
        hit, found, wanted = hit + len(set(got) & set(main)), found + len(got), wanted + len(main)
    assert hit / found >= least and hit / wanted >= least, (hit, found, wanted)


def test_deep_page():
    page = "<div>" * 20_000 + "<p>x</p>" * 200
    assert len(X.leaf_blocks(page)) == 200


def test_viterbi_is_best():
    r = np.random.default_rng(3)
    for _ in range(20):
        n = int(r.integers(1, 7))
        field = X.Field({f"f{k}": float(r.normal()) for k in range(n)}, float(r.normal()), r.normal(size=(2, 2)), r.normal(size=2))
        blocks = [X.Block("x", [f"f{k}"]) for k in range(n)]

        def score(y, field=field, blocks=blocks):
            s = field.start[y[0]] + sum((field.bias + field.weights[b.features[0]]) * v for b, v in zip(blocks, y, strict=True))
            return s + sum(field.trans[a, b] for a, b in zip(y, y[1:], strict=False))

        assert tuple(field.decode(blocks)) == max(itertools.product((0, 1), repeat=n), key=score)


def test_pages_with_nulls_and_parts(spark):
    page = '<html><body><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use things.</div><article><h1>Title here</h1><p>One  two\n three.</p><div class="ad">Buy now.</div><p>Four five six seven.</p></article><section class="comments"><h2>Comments</h2><p>Nice one, thanks.</p></section><aside class="sidebar"><p>More</p></aside><form><label>Mail</label></form><footer>&copy; us</footer></body></html>'
    df = spark.createDataFrame([(1, "u", page), (2, None, None), (None, "v", "")], "page_id long, url string, html string").selectExpr("*", "'q' AS text")
    got = {r.page_id: (r.text, r.n_chars) for r in X.extract(df).collect()}
    want = "Title here\nOne two three.\nFour five six seven."
    assert got == {1: (want, len(want)), 2: ("", 0), None: ("", 0)}
    assert X.extract(df.limit(0)).count() == 0
