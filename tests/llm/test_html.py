from millrace.llm import html_extract as hx

MODEL = hx.trained()


def test_article_without_the_rest():
    page = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header><p>Site</p></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies.</p></div><article><h1>Head &amp; more</h1><p>One  two
    three &lt;b&gt; &#233;<p>Second <a href="x">link</a> text.<div class=ad>Buy now!</div><ul><li>item<li>other</ul><form><input><p>Name</p></form></article>
    <aside><p>Related things</p></aside><section class="comments"><p>First!</p></section><footer>(c) me</footer></body></html>"""
    assert hx.extract(page, MODEL) == "Head & more\nOne two three <b> é\nSecond link text.\nitem\nother"


def test_broken_pages():
    assert hx.extract("", MODEL) == "" and hx.extract("<", MODEL) in ("", "<")
    assert hx.extract("<article><p>cut off in an entity &am", MODEL) == "cut off in an entity &am"
    assert hx.extract("<article><p>cut in a tag</p><p cla", MODEL) == "cut in a tag"
    assert hx.extract("<article><p>open comment<!-- gone", MODEL) == "open comment"
    assert isinstance(hx.extract("<article>" + "<div>" * 30_000 + "<p>deep words here</p>", MODEL), str)


def test_marginals_equal_enumeration():
    from itertools import product

    tree = hx.Tree('<body><div class="ad"><p>x</p></div><article><p>some words</p></article></body>')
    feats, parent = tree.features(), tree.parent
    total, on = 0.0, [0.0] * len(parent)
    for state in product((0, 1), repeat=len(parent)):
        p = MODEL["root"][state[0]]
        for i, s in enumerate(state):
            for f in enumerate(feats[i]):
                p *= MODEL["unary"].get(f, (1, 1))[s]
            if i:
                p *= MODEL["edge"][feats[i][0] if feats[i][0] in MODEL["edge"] else "box"][state[parent[i]]][s]
        total += p
        for i, s in enumerate(state):
            on[i] += p * s
    assert max(abs(a / total - b) for a, b in zip(on, hx.marginals(tree, MODEL))) < 1e-9


def test_held_out_pages():
    right = n = 0
    for page in hx.labelled_pages(200, seed=99):
        tree = hx.Tree(page)
        belief = hx.marginals(tree, MODEL)
        for node, _, piece in tree.pieces:
            if piece.strip():
                n += 1
                right += (belief[node] >= 0.5) == ("\x02" in piece)
    assert right / n > 0.92


def test_query(spark, write):
    pages = [(1, "u", "<article><h1>A</h1><p>text " + "word " * 50_000 + "</p></article>"), (2, None, None), (3, "u", ""), (None, "u", "<p>x</p>"), (1, "u", "<article><p>text here</p></article>")]
    got = hx.op8_html(spark, write(pages=pages)).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.url is None] == [""] and max(r.n_chars for r in got) > 200_000
    assert hx.op8_html(spark, write(pages=[])).count() == 0
