import html.parser
import itertools
import random

from pulse.llm import pages

SCHEMA = "page_id long, url string, html string, text string, lines int"


def extract(spark, rows, **parameters):
    frame = spark.createDataFrame([(*r, "?", 0) for r in rows], SCHEMA)
    return {r.page_id: r.text for r in pages.extract(frame, **parameters).collect()}


def test_article_without_everything_else(spark):
    html = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><article>";</script></head>
    <body class="header-fixed"><header>Site</header><nav><ul><li><a href="/x">Menu</a></ul></nav><div class="cookie-notice">Cookies</div>
    <div class="ad">Buy</div><!-- <p>hidden</p> --><article><h1>Title &amp; more</h1><p>One <b>bo</b>ld&nbsp;word<br>next   line
    <p>A &lt; B &eacute; &#233; &#xE9; 1 < 2<aside>Side</aside><form><input value="a>b">Send</form><ul><li>first<li>second</ul>
    <img alt="x > y" src="z"><div class="share">Share</div><section id="comments">Me first</section><p>End.</article><footer>&copy;</footer>"""
    got = extract(spark, [(1, "http://h/a", html)])
    assert got[1] == "Title & more One bold word next line A < B é é é 1 < 2 first second End."


def test_wrappers_are_no_parts():
    text = lambda html: " ".join(pages.lines(html)[0])
    for start, end in (
        ("<div class='layout has-sidebar'>", "</div>"), ("<div class='page header-fixed'>", "</div>"), ("<form id=f>", "</form>"),
        ("<div id=sidebar-page><div class='nav-open'><form>", "</form></div></div>"), ("<main><div class='layout has-sidebar'>", "</div></main>"),
        ("<article class=a><div class='comments-open'>", "</div></article>"), ("<div class='widget-page'>", "</div>"),
    ):
        for tag in ("article", "main"):
            page = f"<body>{start}<nav>Menu</nav><div class=ad>Buy</div><{tag}><p>One</p><div class=share>Share</div><p>two</p></{tag}><div class=menu>More</div>{end}</body>"
            assert text(page) == "One two", page
    # Parts go as before, with the articles in them.
    part = "<div id=comments><article>Me first</article></div><div class='related-posts'><article>Next</article></div><form>Send</form>"
    for page in (f"<main><p>One</p>{part}</main>", f"<article>One{part}</article>", f"<article>One</article>{part}", f"<form><article>One</article>{part}</form>",
                 f"<div class='has-sidebar'><main>One</main><div class=sidebar><article>Other</article></div>{part}</div>",
                 f"<div class=widgets><article>One</article>{part}</div>", f"<article>One</article><nav><div class=x><article>No</article></div></nav>{part}"):
        assert text(page) == "One", page
    assert text("<div class='has-sidebar'><article>One</article></div><form><article>two</article></form>") == "One two"
    assert text("<div class=sidebar-x hidden><article>No</article></div><article>One") == "One"
    assert pages.lines("<div class=search><nav><article>No</article></nav>Find</div>Rest") == ([], ["Rest"], False)


def test_differencing_where_markup_says_nothing(spark):
    page = lambda *own: "<div><p>Home</p><p>Topics</p>" + "".join(f"<p>{o}</p>" for o in own) + "<p>Imprint</p></div>"
    rows = [(1, "http://h/a/1", page("one", "two")), (2, "http://h/a/2", page("three")), (3, "http://h/a/3", page("four", "one"))]
    rows += [(4, "http://h/a/4", page("four", "one")), (5, "http://other/a", page("alone")), (6, None, page("no url"))]
    got = extract(spark, rows)
    assert got[1] == "one two" and got[2] == "three" and got[3] == got[4] == "four one"
    assert got[5] == "Home Topics alone Imprint" and got[6] == "Home Topics no url Imprint"


def test_one_page_per_task(spark):
    rows = [(i, f"http://h/{i:03}", f"<p>top</p><p>text {i}</p>") for i in range(40)]
    assert extract(spark, rows) == {i: f"text {i}" for i in range(40)}
    got = extract(spark, rows, pages_per_task=10)
    assert all(f"text {i}" in got[i] for i in range(40))


def test_texts_are_the_same_for_any_number_of_ranges(spark):
    rng = random.Random(3)
    rows = [(i, f"http://h/{i:03}", f"<p>top</p><p>text {i}</p>") for i in range(40)]
    assert extract(spark, rows, pages_per_task=1) == {i: f"text {i}" for i in range(40)}
    # Copies through several ranges, lone pages, pages with an article, and several hosts.
    rows, host = [], 0
    while len(rows) < 60:
        host += 1
        for _ in range(rng.randrange(1, 9)):
            body = "".join(f"<p>{rng.choice('abcdef')}</p>" for _ in range(rng.randrange(1, 6)))
            body = f"<article>main</article>{body}" if rng.random() < 0.2 else body
            rows += [(len(rows) + k, f"http://h{host}/{len(rows) + k:03}", body) for k in range(rng.choice((1, 1, 2, 7)))]
    whole = extract(spark, rows)
    assert sum(t == "" for t in whole.values()) < 40
    for n in (1, 3, 10):
        assert extract(spark, rows, pages_per_task=n) == whole


def test_nulls_empty_and_broken_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "http://h/", "<article>open <p>end"), (4, "http://g/", "<script>never closed <article>x</article>")]
    rows += [(5, "http://k/", "plain & simple"), (6, "http://l/", "<article>" + "<p>w</p>" * 50_000 + "</article>"), (6, "http://l/", "<p <b>x</p>")]
    got = extract(spark, rows[:6])
    assert got[1] == got[2] == "" and got[3] == "open end" and got[4] == "" and got[5] == "plain & simple"
    assert len(got[6].split()) == 50_000
    assert extract(spark, []) == {}


def test_common_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = rng.choices("abcd", k=rng.randrange(8)), rng.choices("abcd", k=rng.randrange(8))
        best = 0
        for n in range(len(a), 0, -1):
            for pick in itertools.combinations(range(len(a)), n):
                rest = iter(b)
                if all(a[i] in rest for i in pick):
                    best = n
                    break
            if best:
                break
        found = sorted(pages.common(a, b))
        rest = iter(b)
        assert len(found) == best and all(a[i] in rest for i in found)


def test_nothing_of_an_article_goes_by_a_part_of_a_name(spark):
    pages_ = [
        ("<article><h2 class='section-header'>Head</h2><p>Body</p></article>", "Head Body"),
        ("<article><header><h1>Title</h1><p>By Jo</p></header><p>Body</p></article>", "Title By Jo Body"),
        ("<article><p>It costs <span class='share-price'>12 euro</span> now.</p></article>", "It costs 12 euro now."),
        ("<article><div class='related-work'><p>Others did.</p></div></article>", "Others did."),
        ("<article><table class='search-stats'><tr><td>7</td><td>8</td></tr></table>x</article>", "7 8 x"),
        ("<main><div class='post'><div class='ad-free'>Body</div></div></main>", "Body"),
        ("<main class=ads><h3 id=comments>Remarks</h3><em class='ad'>not</em> one</main>", "Remarks not one"),
        # Whole names still say what goes.
        ("<article>x<div class='big ad'>Buy</div><div id=comment-list>Me</div><ul class='share-buttons'><li>f</ul><div class='ad_slot-2'>B</div></article>", "x"),
        ("<article>x<span hidden>no</span><div class='comments-open'>yes</div><footer>f</footer></article>", "x yes"),
    ]
    rows = [(i, f"http://h{i}/a", html) for i, (html, _) in enumerate(pages_)]
    assert extract(spark, rows) == {i: want for i, (_, want) in enumerate(pages_)}


def test_neighbours_vote_on_named_blocks_of_an_article(spark):
    def page(own, block="<p>Join us</p>"):
        return f"<article><header><p>The Site</p><h1>Daily</h1></header><p>Lead</p><p>{own}</p><div class='join-newsletter-today'>{block}</div></article>"

    rows = [(i, f"http://h/{i}", page(f"text {i}")) for i in range(5)]
    rows.append((5, "http://h/5", page("text 5", "<p>Join us</p><p>A letter of its own</p>")))
    rows.append((6, "http://alone/", page("text 6")))
    got = extract(spark, rows)
    # The repeated block and header line go; headings and lines without a name stay though they repeat.
    assert [got[i] for i in range(5)] == [f"Daily Lead text {i}" for i in range(5)]
    assert got[5] == "Daily Lead text 5 A letter of its own"
    assert got[6] == "The Site Daily Lead text 6 Join us"
    for n in (1, 2):
        assert extract(spark, rows, pages_per_task=n) == got


class _Plain(html.parser.HTMLParser):
    """A plain version for well-formed pages: a tree, and one walk over it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = ["root", {}, None, []]

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs), self.at, []]
        self.at[3].append(node)
        if tag not in ("br", "img"):
            self.at = node

    def handle_endtag(self, tag):
        self.at = self.at[2]

    def handle_data(self, data):
        self.at[3].append(data)


INLINE, GONE = {"b", "span", "a"}, {"nav", "footer", "aside", "form", "script", "style"}
PART_NAMES, WHOLE_NAMES = ("share-price", "ad-free", "related-work", "x search-stats"), ("ad", "comments", "menu", "share", "cookie-banner")


def plain_lines(text):
    """(line, undecided) of the article, or None without one, and lines outside."""
    tree = _Plain()
    tree.feed(text)
    inside, outside, buffer, seen = [], [], [], []

    def flush(main, part, heading):
        line = " ".join("".join(buffer).split())
        buffer.clear()
        if line:
            inside.append((line, part and not heading)) if main else outside.append(line)

    def walk(node, main, part, heading):
        for child in node[3]:
            if isinstance(child, str):
                buffer.append(child)
                continue
            tag, name = child[0], child[1].get("class", "")
            kept_name = main and (tag in INLINE or tag in ("h1", "h2"))
            if tag in GONE or (tag == "header" and not main) or (not kept_name and (name in WHOLE_NAMES or (name and not main))):
                if tag not in INLINE or name in WHOLE_NAMES or name:
                    flush(main, part, heading)
                continue
            state = main or tag == "article", part or (main and not kept_name and (tag == "header" or name in PART_NAMES)), heading or tag in ("h1", "h2")
            if tag == "article":
                seen.append(tag)
            if tag not in INLINE or (name and not kept_name):
                flush(main, part, heading)
                walk(child, *state)
                flush(*state)
            else:
                walk(child, *state)

    walk(tree.root, False, False, False)
    flush(False, False, False)
    return (inside if seen else None), outside


def plain_extract(rows):
    """All pages, with differencing against the next page on either side that differs."""
    order, out = sorted(rows, key=lambda r: (r[1].split("/")[2], r[1], r[0])), {}
    parsed = []
    for page_id, url, text in order:
        inside, outside = plain_lines(text)
        fixed = inside is not None and not any(u for _, u in inside)
        compared = [(o, True) for o in outside] if fixed or inside is None else inside
        parsed.append((page_id, url.split("/")[2], " ".join(x for x, _ in inside) if fixed else None, compared))
    for i, (page_id, host, text, own) in enumerate(parsed):
        if text is not None:
            out[page_id] = text
            continue
        gone = set()
        for side in (parsed[:i][::-1], parsed[i + 1 :]):
            other = next((p[3] for p in itertools.takewhile(lambda p: p[1] == host, side) if p[3] != own), None)
            if other is not None:
                gone |= pages.common(own, other)
        out[page_id] = " ".join(x for k, (x, undecided) in enumerate(own) if k not in gone or not undecided)
    return out


def test_equal_to_a_plain_version(spark):
    rng = random.Random(11)

    def block(depth, in_article):
        kind = rng.random()
        word = rng.choice("abcdefgh") + rng.choice(["", " &amp; x", "&eacute;", "\n y"])
        name = rng.choice([*PART_NAMES, *WHOLE_NAMES]) if rng.random() < 0.3 else None
        attr = f' class="{name}"' if name else ""
        if depth == 0 or kind < 0.3:
            return f"<p{attr}>{word} <b>z</b></p>" if rng.random() < 0.8 else f"<h2{attr}>{word}</h2>"
        if kind < 0.45:
            return f"<p>{word}<span{attr if in_article else ''}>{word}</span> more<br>{word}</p>"
        if kind < 0.6:
            return f"<{(t := rng.choice(['nav', 'footer', 'aside', 'form', 'header']))}>{block(depth - 1, in_article)}</{t}>"
        if kind < 0.65:
            return "<script>var a = 1;</script>"
        return f"<div{attr}>{''.join(block(depth - 1, in_article) for _ in range(rng.randrange(1, 4)))}</div>"

    rows = []
    for i in range(150):
        around = "".join(block(1, False) for _ in range(rng.randrange(3)))
        if rng.random() < 0.7:
            article = "".join(block(2, True) for _ in range(rng.randrange(1, 6)))
            around += f"<article>{article}</article>" + block(1, False)
        rows.append((i, f"http://h{i // 30}/{i % 30:02}", f"<html><body>{around}</body></html>"))
    rows += [(200 + i, "http://h1/05", rows[35][2]) for i in range(3)]
    assert extract(spark, rows) == plain_extract(rows)
