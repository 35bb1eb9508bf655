import random

from rareclass.llm import html as H


def text(source, paths=()):
    return H.page_text(source, list(paths))


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
    <header class="site"><h1>Site name</h1><p>Slogan of the site</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies for everything, please agree with that.</p></div>
    <main><article class="post-17"><header><h1>Title &amp; more</h1><div class="byline">By someone</div></header>
    <p>First   paragraph,
    with <b>bold</b> &eacute;&#8212;&nbsp;text that is long enough.</p><div class="ad">Buy now</div><p>Second<br>line.</p><ul><li>one<li>two</ul>
    <form><input><button>Send</button></form><aside>Related things</aside><!-- <p>no</p> -->
    <section class="comments"><h2>Comments</h2><article class="comment"><p>I disagree with this long article.</p></article></section></article></main>
    <div id="sidebar"><p>Side text that is also quite long, to tempt the scores of containers.</p></div><footer>&copy; all</footer></body></html>"""
    assert text(page) == "Title & more\nFirst paragraph, with bold é— text that is long enough.\nSecond line.\none\ntwo"


def test_broken_markup():
    assert text("<p><b>open <br><p>next 1 < 2 &lt;b&gt; <a href='x>y'>link</a>") == "open\nnext 1 < 2 <b> link"
    assert text("<div><p>cut off here <div cla") == "cut off here"
    assert text("<article>bare text<p>para</article><footer>f") == "bare text\npara"
    assert text("<article><p>a</i></b>b</p></div>c</article>") == "ab\nc"
    assert text("<script>never ends <p>x") == "" and text("<!-- never ends <p>x") == ""
    assert text("just text") == "just text"
    assert text("") == "" and text(None) == "" and text("<nav>menu</nav>") == ""
    assert text("<article><p>" + "word " * 300_000 + "</p></article>") == ("word " * 300_000).strip()
    assert text("<article>" + "<div>" * 400 + "deep" + "</article>") == "deep"
    assert text("<article><p hidden>h</p><p style='display:none'>n</p><p>seen</p></article>") == "seen"


def test_class_words_do_not_condemn_the_main_text():
    body = "The text of the page, which is most of what stands on it."
    assert text(f"<div class='content no-sidebar'><p>{body}</p></div>") == body
    assert text(f"<div class='page-header social'><div class='post'><p>{body}</p></div><div class='related'><p>Teaser</p></div></div>"
                "<div id='sidebar'><p>Side</p></div>") == body
    assert text(f"<div class='no-comments'><p>{body}</p></div>") == body
    assert text(f"<div class='widget'><p>{body}</p></div><div class='related'><p>{body[:-1]}</p></div>").startswith(body)
    assert text(f"<div class='intro'><p>Short article text.</p></div><div id='comments'><p>{body}</p></div>") == "Short article text."
    assert text(f"<div class='cookie-notice'><p>{body}</p></div>") == ""


BODY = "The text of the page, which is most of what stands on it."


def test_no_article_text_is_lost():
    lead, end = "A short lead.", "The end."
    assert text(f"<div class='wrap'><div class='lead'><p>{lead}</p></div><div class='rest'><p>{BODY}</p></div></div>") == f"{lead}\n{BODY}"
    three = "".join(f"<section class='{c}'><p>{t}</p></section>" for c, t in (("intro", lead), ("body", BODY), ("end", end)))
    assert text(f"<div>{three}</div>") == f"{lead}\n{BODY}\n{end}"
    assert text(f"<h1>Title</h1><div class='content'><p>{BODY}</p></div>") == f"Title\n{BODY}"
    assert text(f"<main><header><h1>Title</h1><p>{lead}</p><p class='meta'>May 1</p></header><p>{BODY}</p></main>") == f"Title\n{lead}\n{BODY}"
    for c in ("legal-analysis", "search-results-analysis", "story-notice-period"):
        assert text(f"<article><p>{BODY}</p><div class='{c}'><p>{lead}</p></div></article>") == f"{BODY}\n{lead}"
    assert text(f"<article><div class='article-header'><h1>Title</h1></div><p>{BODY}</p></article>") == f"Title\n{BODY}"
    assert text(f"<main><h1>Title</h1><article><p>{BODY}</p></article><p>{end}</p></main>") == f"Title\n{BODY}\n{end}"
    assert text(f"<h1>Title</h1><p>Elsewhere</p><article><p>{BODY}</p></article>") == f"Title\n{BODY}"
    assert text(f"<h1>Site</h1><article><h1>Title</h1><p>{BODY}</p></article>") == f"Title\n{BODY}"


def test_noise_beside_the_container_stays_out():
    links = "".join(f"<li><a href='/{i}'>Page {i}</a></li>" for i in range(9))
    assert text(f"<ul>{links}</ul><div class='content'><p>{BODY}</p></div><div><a href='/'>Home</a></div>") == BODY
    for c in ("ad-slot", "related-posts", "share-buttons", "comment-list", "search-box"):
        assert text(f"<article><p>{BODY}</p><div class='{c}'><p>Buy now</p></div></article>") == BODY
        assert text(f"<div class='content'><p>{BODY}</p></div><div class='{c}'><p>Buy now</p></div>") == BODY


def test_generated_pages_with_known_text():
    """Pages of random layout with known main text: nothing lost, nothing added."""
    rng = random.Random(5)
    noise = ["<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<div class='sidebar'><p>Side text</p></div>", "<footer><p>All rights</p></footer>",
             "<div class='ad'>Buy this</div>", "<form><p>Your name</p></form>", "<script>x('<p>')</script>", "<div id='comments'><p>I disagree</p></div>",
             "<div><a href='/a'>One</a> <a href='/b'>Two</a></div>", "<div class='cookie-notice'><p>Cookies</p></div>", "<aside><p>By the way</p></aside>"]
    for n in range(300):
        parts = [f"{rng.choice(['Part', 'Teil'])} {n} {i} " + "word " * rng.randint(5, 40) + "end" for i in range(rng.randint(2, 6))]
        tag = rng.choice(["p", "p", "blockquote"])
        cells = [f"<{tag}>{p}</{tag}>" for p in parts]
        split = rng.randint(1, len(cells) - 1)
        one, two = "".join(cells[:split]), "".join(cells[split:])
        inner = rng.choice([f"{one}{two}", f"<div class='lead'>{one}</div><div class='rest'>{two}</div>", f"<section>{one}</section><section class='b'>{two}</section>",
                            f"{one}<div>{two}</div>"])
        shell = rng.choice(["<article>%s</article>", "<main>%s</main>", "<div class='content'>%s</div>", "<div class='wrap-3'><div>%s</div></div>", "%s",
                            "<main><article class='post-1'>%s</article></main>"])
        title, head = f"Title {n}", rng.random() < 0.5
        want = ([title] if head else []) + parts
        before, after = "".join(rng.sample(noise, 3)), "".join(rng.sample(noise, 3))
        page = f"<html><body>{before}{shell % ((f'<h1>{title}</h1>' if head else '') + inner)}{after}</body></html>"
        assert text(page) == "\n".join(want), page


def test_every_path_with_a_share_of_the_votes_wins(spark):
    """Twelve layouts on one host, each with teasers that are longer than the text on one page."""
    def page(k, teaser):
        return f'<body><div class="lay{chr(97 + k)}"><p>{long(40)} {k}</p></div><div class="teasers"><p>{long(teaser)}</p></div></body>'
    rows = [(k * 10 + i, "http://h.example.com/", page(k, 60 if i == 0 else 5)) for k in range(12) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"{long(40)} {i // 10}" for i, _, _ in rows)


def test_thousands_of_open_elements():
    assert text("<div>" * 5000 + "deep") == "deep"
    assert text("<article>" + "<section><b>" * 3000 + "deep" + "</article>") == "deep"


def test_paths_are_generalised():
    page = H.Page('<body><div class="Main post-12"><p>some words here</p></div></body>')
    assert set(page.scores()) == {"html/body/div.main.post-#", "html/body"}


def long(n):
    return " ".join(f"word{i}" for i in range(n))


def test_host_vote_corrects_single_pages(spark):
    """On its own the last page would take the long teaser list; the host's other pages have settled the path."""
    good = [f'<body><div class="txt">{"".join(f"<p>{long(40)} {i} {j}</p>" for j in range(4))}</div><div class="teasers"><p>{long(9)}</p></div></body>' for i in range(6)]
    odd = f'<body><div class="txt"><p>{long(40)}</p></div><div class="teasers"><p>{long(60)}</p></div></body>'
    rows = [(i, f"https://a.example.com/{i}", h) for i, h in enumerate(good)] + [(6, "http://A.example.com/x?y", odd), (7, "http://b.example.com/", odd)]
    got = {r["page_id"]: r["text"] for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[6] == long(40) and got[7] == long(60)
    assert got[0].count("\n") == 3


def test_awkward_tables(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no url", "<p>x</p>"), (3, "no url", "<p>x</p>"), (None, "http://h/1", "<article><p>y</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as host", "'c' as text", "'c' as paths")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in H.extract_digest(df).collect())
    assert got == [("1", "", 0), ("2", "", 0), ("3", "x", 1), ("3", "x", 1), ("None", "y", 1)]
    assert H.extract_digest(df.limit(0)).count() == 0
