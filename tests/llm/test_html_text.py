import numpy as np

from corpusflow.llm import html_text
from tests.llm.cases import CLASHING

PARAGRAPHS = [f"Paragraph {i} of the article, with &amp; and caf&eacute; and enough words to look like a text" for i in range(6)]
TEXT = "\n".join(p.replace("&amp;", "&").replace("&eacute;", "é") for p in PARAGRAPHS)


def page(article, before="", after=""):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t='<p>no</p>';</script></head><body>"
        "<header class='site-header'><h2>Site</h2></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>"
        f"<!-- <p>no</p> --><div class='ad'>Buy this very long advert text that has many words in one line</div>{before}{article}{after}"
        "<aside><p>Other articles that are worth a look, in a sidebar</p></aside><form><p>Write to us</p><input><button>Send</button></form>"
        "<section id='comments'><p>A reader says something long about the article, at great length</p></section>"
        "<div id=cookie-notice>We use cookies and ask for your consent here and now</div><footer>&copy; 2020 Site</footer></body></html>"
    )


def test_article_without_the_rest():
    paragraphs = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    assert html_text.extract(page(f"<article><h1>Head <b>line</b></h1>{paragraphs}</article>")) == "Head line\n" + TEXT
    assert html_text.extract(page(f"<article><h1>H</h1>{paragraphs.replace('</p>', '')}")).startswith("H\n" + TEXT)  # unclosed
    assert html_text.extract(page(f"<main><div><h1>H</h1></div><div class=body>{paragraphs}</div></main>")) == "H\n" + TEXT
    assert html_text.extract(page(f"<div id=content>{paragraphs}</div>")) == TEXT
    assert html_text.extract(page("<article><p>one\n two<br>three&nbsp;four <i>fi</i>ve</p> <p> </p>six<ul><li>a<li>b</ul></article>")) == "one two three four five\nsix\na\nb"
    assert html_text.extract(page(f"<article>{paragraphs}<div class='share'>Share</div><div class=comments><p>{'long ' * 50}</p></div></article>")) == TEXT


def test_odd_pages():
    assert html_text.extract(None) == html_text.extract("") == html_text.extract("<html><body><nav>x</nav></body></html>") == ""
    assert html_text.extract("just text &lt;b&gt; and more") == "just text <b> and more"
    assert html_text.extract("</p></div><p>a</b></p") == "a"
    long = "<article>" + "<p>word word word</p>" * 20_000 + "</article>"
    assert html_text.extract(long).count("\n") == 19_999
    assert html_text.extract("<div>" * 3000 + "deep") == "deep"


def test_smoothing_and_threshold():
    values = np.array([1.0, 1.0, 50.0, 60.0, 55.0, 2.0])
    kernel = lambda d: np.exp(-0.5 * d**2)
    want = [sum(v * kernel(abs(i - j)) for j, v in enumerate(values) if abs(i - j) <= 3) / sum(kernel(abs(i - j)) for j in range(6) if abs(i - j) <= 3) for i in range(6)]
    assert np.allclose(html_text.smoothed(values, 1.0), want)
    assert 2 < html_text.threshold(values) < 50 and html_text.threshold(np.array([3.0, 3.0])) == 3.0


def test_rows(spark):
    html = page("<article><p>Some text</p></article>")
    frame = spark.createDataFrame([(1, "u", html), (1, "u", html), (None, None, None)], "page_id long, url string, html string")
    rows = html_text.main_text(frame.selectExpr("*", *[f"1 as `{c}`" for c in CLASHING])).collect()
    assert sorted(map(str, map(tuple, rows))) == ["(1, 'u', 'Some text', 9)", "(1, 'u', 'Some text', 9)", "(None, None, '', 0)"]
    assert html_text.main_text(frame.limit(0)).count() == 0


def test_layout_classes_and_forms_skip_no_article():
    paragraphs = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    for name in ("content has-sidebar", "no-sidebar", "page with-ads", "post has-comments", "container modal-open", "site-wrapper nav-open", "sidebar"):
        assert html_text.extract(page(f"<div class='{name}'><article>{paragraphs}</article></div>")) == TEXT, name
        if name != "sidebar":
            assert html_text.extract(page(f"<div class='{name}'>{paragraphs}</div>")) == TEXT, name
    for inner in (f"<article>{paragraphs}</article>", f"<div>{paragraphs}</div>"):
        assert html_text.extract(f"<body><form action=/><nav>Menu</nav>{inner}<div class=sidebar>Other</div></form></body>") == TEXT


def test_only_whole_names_tell_reader_comments():
    paragraphs = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    for attrs in ("class='post has-comments'", "class=commentary", "id=post-comment-7", "class='post comment-policy'"):
        assert html_text.extract(page(f"<article {attrs}>{paragraphs}</article>")) == TEXT, attrs
    assert html_text.extract(page(f"<div id=comment-policy>{paragraphs}</div>")) == TEXT
    said = f"<p>{'A reader says much about it. ' * 30}</p>"
    for comments in (
        f"<div class=comments><article>{said}</article></div>", f"<article class=comment>{said}</article>", f"<section id=comments><article id=c7>{said}</article></section>",
        f"<ol class=comment-list><li id=comment-12>{said}</ol>", f"<article class='comment-body' id=div-comment-3>{said}</article>",
    ):
        assert html_text.extract(page(f"<article>{paragraphs}</article>{comments}")) == TEXT, comments


def test_formulas_stay_and_open_choices_swallow_nothing():
    first, rest = PARAGRAPHS[0], "".join(f"<p>{p}</p>" for p in PARAGRAPHS[1:])
    assert html_text.extract(page(f"<article><p>{first}<math><mi>x</mi><mo>=</mo><mn>1</mn></math></p>{rest}</article>")) == TEXT.replace("\n", "x=1\n", 1)
    assert html_text.extract(page(f"<select><option>One<option>Two<article><p>{first}</p>{rest}</article>")) == TEXT
    assert html_text.extract(page(f"<article><p>{first}<select><optgroup><option>One</select></p>{rest}</article>")) == TEXT


def brute_force(lines, sigma=1.0):
    """Regions of the lines (text, tags, region) by the formulas, number by number."""
    ratios = [len(t) / max(1, n) for t, n, _ in lines]
    weight = lambda d: np.exp(-0.5 * (d / sigma) ** 2) if d <= 3 * sigma else 0
    smooth = [sum(r * weight(abs(i - j)) for j, r in enumerate(ratios)) / sum(weight(abs(i - j)) for j in range(len(ratios))) for i in range(len(ratios))]
    cut = sum(smooth) / len(smooth)
    while True:
        low, high = [s for s in smooth if s < cut], [s for s in smooth if s >= cut]
        if not low or not high:
            cut = min(smooth)
            break
        nearer = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(nearer - cut) < 1e-9:
            break
        cut = nearer
    kept = {r for (_, _, r), s in zip(lines, smooth, strict=True) if s >= cut - 1e-12}
    return "\n".join(t for t, _, r in lines if r in kept)


def test_regions_against_brute_force():
    rnd = np.random.default_rng(4)
    for _ in range(100):
        html = "".join(
            f"<div>{''.join('<p>' + '<b>' * int(rnd.integers(0, 4)) + 'word ' * int(rnd.integers(1, 60)) + '</p>' for _ in range(rnd.integers(1, 5)))}</div>"
            for _ in range(rnd.integers(1, 8))
        )
        lines = html_text.Lines()
        lines.feed(html)
        lines.close()
        assert html_text.extract(html) == brute_force(lines.without_forms())
