"""Main text of web pages by a tree-structured graphical model.

Each element of the page is a node with two states, content or not. Its own look (tag, class words,
link share, length) gives a potential; parent and child share another. Sum-product messages go up and
down the tree once, which yields each node's exact marginal; the text of nodes above one half stays.
Potentials are counts over labelled pages, which labelled_pages() makes from a rule.
"""

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import table, texts

#: Fixed values of HTML: elements without an end, inside a line of text, and with raw text inside.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
#: Elements whose start ends an open element of the given kinds.
ENDS_OPEN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "html", "nav", "aside", "main", "select", "blockquote", "form", "footer", "header", "figure"}

GROUPS = {
    "code": "script style noscript template iframe object svg canvas head title meta link textarea select option button noembed noframes",
    "form": "form fieldset input legend datalist",
    "nav": "nav menu",
    "footer": "footer address",
    "header": "header",
    "aside": "aside dialog",
    "article": "article main",
    "heading": "h1 h2 h3 h4 h5 h6",
    "para": "p blockquote pre figcaption dd dt",
    "list": "ul ol dl",
    "item": "li",
    "table": "table thead tbody tfoot tr td th caption figure",
    "root": "html body",
}
GROUP = {tag: g for g, tags in GROUPS.items() for tag in tags.split()}
BAD = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|promo\w*|banner\w*|sponsor\w*|side-?bar\w*|nav\w*|menu\w*|foot\w*|head(?:er)?|masthead|cookie\w*|notice\w*|consent\w*|gdpr|pop-?up\w*|modal|overlay|comment\w*|repl(?:y|ies)|disqus\w*|share\w*|social\w*|related\w*|recommend\w*|breadcrumbs?|form|subscri\w*|newsletter\w*|log-?in|sign-?up|search\w*|pag(?:er|ination)|widget\w*|legal|copyright|hidden|alert|toolbar|tags?)(?:$|[\s_-])", re.I)
GOOD = re.compile(r"(?:^|[\s_-])(?:article\w*|content|post|entry\w*|main\w*|story\w*|body|text)(?:$|[\s_-])", re.I)

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(>|\Z)|<(?=/?[a-zA-Z])[^>]*(?:>|\Z)""", re.S)
ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPACE = re.compile(r"\s+")


class Tree:
    """Elements in page order; every piece of text with its node and block."""

    def __init__(self, html: str):
        self.tag, self.parent, self.look, self.chars, self.linked = ["#root"], [-1], [""], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []
        self.block = 0
        self._open: list[int] = [0]
        self._links = 0
        at, n = 0, len(html)
        while at < n:
            m = TOKEN.search(html, at)
            self._text(html[at : m.start() if m else n])
            if not m:
                break
            at = m.end()
            if not m[2] or not m[4] and m.end() == n:  # a comment, a declaration, or a tag that the page's end cuts off
                continue
            name = m[2].lower()
            if m[1]:
                self._end(name)
            elif name == "br":
                self._text(" ")
            else:
                self._start(name, m[3])
                if name in RAW and name not in VOID:
                    stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                    inside = html[at : stop.start() if stop else n]
                    if name in ("textarea", "title"):
                        self._text(inside)
                    at = stop.end() if stop else n
                    self._end(name)

    def _text(self, raw: str) -> None:
        if not raw:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        node = self._open[-1]
        self.pieces.append((node, self.block, text))
        size = len(text) if len(text) < 64 and not text.isspace() else len(text.strip())
        self.chars[node] += size
        if self._links:
            self.linked[node] += size

    def _start(self, name: str, attrs: str) -> None:
        if name not in INLINE:
            self.block += 1
            ends = ENDS_OPEN.get(name, set()) | {"p"}
            for k in range(len(self._open) - 1, 0, -1):
                tag = self.tag[self._open[k]]
                if tag in ends:
                    self._cut(k)
                    break
                if tag in SCOPE:
                    break
        if name in VOID:
            return
        self.tag.append(name)
        self.parent.append(self._open[-1])
        self.look.append(" ".join(x or y or z for _, x, y, z in ATTR.findall(attrs)) if attrs else "")
        self.chars.append(0)
        self.linked.append(0)
        self._open.append(len(self.tag) - 1)
        self._links += name == "a"

    def _end(self, name: str) -> None:
        if name not in INLINE:
            self.block += 1
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[k]]
            if tag == name:
                self._cut(k)
                return
            if name in INLINE and tag not in INLINE or tag in SCOPE and name in ("p", "li", "dt", "dd"):
                return

    def _cut(self, k: int) -> None:
        self._links -= sum(self.tag[i] == "a" for i in self._open[k:])
        del self._open[k:]

    def features(self) -> list[tuple]:
        """(group, class words, link share, length) of each node; the last two count the whole subtree."""
        chars, linked = self.chars[:], self.linked[:]
        for i in range(len(chars) - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            linked[self.parent[i]] += linked[i]
        out = []
        for tag, look, c, k in zip(self.tag, self.look, chars, linked, strict=True):
            words = "none" if not look else "bad" if BAD.search(look) else "good" if GOOD.search(look) else "other"
            share = "none" if not c else "low" if k < 0.3 * c else "mid" if k < 0.7 * c else "high"
            size = "none" if not c else "short" if c < 40 else "mid" if c < 200 else "long"
            out.append((GROUP.get(tag, "inline" if tag in INLINE else "box"), words, share, size))
        return out


def marginals(tree: Tree, model: dict) -> list[float]:
    """Probability of content of each node, by one upward and one downward pass of messages."""
    feats, parent = tree.features(), tree.parent
    unary, edge = model["unary"], model["edge"]
    n = len(feats)
    up0, up1 = [1.0] * n, [1.0] * n  # own potential times the children's messages
    msg = [(1.0, 1.0)] * n
    for i in range(n - 1, -1, -1):
        a, b = up0[i], up1[i]
        for f in enumerate(feats[i]):
            x, y = unary.get(f, (1.0, 1.0))
            a, b = a * x, b * y
        a, b = a / (a + b), b / (a + b)
        up0[i], up1[i] = a, b
        if i:
            (e00, e01), (e10, e11) = edge[feats[i][0]] if feats[i][0] in edge else edge["box"]
            m0, m1 = e00 * a + e01 * b, e10 * a + e11 * b
            msg[i] = (m0, m1)
            p = parent[i]
            a, b = up0[p] * m0, up1[p] * m1
            up0[p], up1[p] = a / (a + b), b / (a + b)
    belief = [0.0] * n
    full = [(0.5, 0.5)] * n
    a, b = up0[0] * model["root"][0], up1[0] * model["root"][1]
    full[0] = (a / (a + b), b / (a + b))
    belief[0] = full[0][1]
    for i in range(1, n):
        (e00, e01), (e10, e11) = edge[feats[i][0]] if feats[i][0] in edge else edge["box"]
        a, b = full[parent[i]]
        a, b = a / max(msg[i][0], 1e-300), b / max(msg[i][1], 1e-300)  # the parent without this child
        d0, d1 = (a * e00 + b * e10) * up0[i], (a * e01 + b * e11) * up1[i]
        full[i] = (d0 / (d0 + d1), d1 / (d0 + d1))
        belief[i] = full[i][1]
    return belief


def labelled_pages(n: int = 600, seed: int = 11) -> Iterator[str]:
    """Pages made by a rule, each with its main text marked: content stands between U+0002 and U+0003."""
    r = random.Random(seed)

    def text(lo: int, hi: int) -> str:
        return " ".join("".join(r.choice("abcdefghilmnoprstuv") for _ in range(r.randint(1, 9))) for _ in range(r.randint(lo, hi))).capitalize() + r.choice(".!? ")

    def good(lo: int = 1, hi: int = 90) -> str:
        return f"\x02{text(lo, min(hi, lo + int(r.expovariate(1 / 25))))}\x03"

    def links(k: int) -> str:
        return "".join(f'<li><a href="/x">{text(1, 3)}</a></li>' for _ in range(k))

    def maybe(p: float, *out: str) -> str:
        return r.choice(out) if r.random() < p else ""

    def body() -> str:
        out = []
        for _ in range(r.choice([0, 0, 1, 2, 3, 5, 8])):
            kind = r.random()
            if kind < 0.62:
                out.append(f"<p>{good()}" + maybe(0.85, "</p>"))
            elif kind < 0.7:
                out.append(f"<p>{good()} <a href='/y'>{good(1, 4)}</a> {good()}</p>")
            elif kind < 0.78:
                out.append(f"<h2>{good(1, 8)}</h2>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{good(1, 20)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.88:
                out.append(f"<table><tr><td>{good(1, 5)}</td><td>{good(1, 5)}</td></tr></table>")
            elif kind < 0.92:
                out.append(f"<blockquote>{good()}</blockquote>")
            elif kind < 0.95:
                out.append(f"<div>{good()}</div>")
            else:
                out.append(f"<p><b>{good()}<br>")
        return "".join(out)

    def advert() -> str:
        return f'<{(t := r.choice(["div", "div", "aside", "section"]))} class="{r.choice(["ad", "ads", "advert", "banner", "sponsored", "promo", "ad-box"])}">{r.choice(["", "<p>"])}{text(2, 30)}</{t}>'

    def comments() -> str:
        each = "".join(r.choice([f"<p>{text(2, 60)}</p>", f'<div class="comment"><p>{text(2, 60)}</p></div>', f"<li>{text(2, 40)}</li>"]) for _ in range(r.randint(1, 5)))
        return f'<{(t := r.choice(["div", "section", "ul", "aside"]))} {r.choice(["class", "id"])}="{r.choice(["comments", "comment-list", "replies"])}"><h3>{text(1, 2)}</h3>{each}</{t}>'

    def notice() -> str:
        return f'<div {r.choice(["class", "id"])}="{r.choice(["cookie", "cookie-banner", "notice", "consent", "popup", "newsletter", "alert"])}"><p>{text(4, 40)}</p>{maybe(0.5, "<button>ok</button>")}</div>'

    def form() -> str:
        return f"<form><label>{text(1, 3)}</label><input name=q><p>{text(1, 10)}</p><select><option>{text(1, 2)}</select><button>{text(1, 2)}</button></form>"

    def side() -> str:
        return r.choice([f"<aside><h3>{text(1, 4)}</h3><ul>{links(r.randint(2, 6))}</ul><p>{text(3, 30)}</p></aside>", f'<div class="{r.choice(["sidebar", "related", "share", "social", "widget", "breadcrumb"])}"><p>{text(2, 25)}</p><ul>{links(r.randint(1, 6))}</ul></div>'])

    def extra(p: float) -> str:
        return "".join(f() for f in (advert, side, notice, form) if r.random() < p)

    for _ in range(n):
        main = f"<h1>{good(1, 12)}</h1>" * (r.random() < 0.9) + body()
        if r.random() < 0.3:
            main += extra(0.25)
        if r.random() < 0.25:
            main += comments()
        box = r.choice(["article", "article", "article", "main", 'div class="content"', 'div class="post"', 'div id="main"', "section", "div"])
        head = f"<head><meta charset=utf-8><title>{text(2, 9)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
        nav = r.choice([f"<nav><ul>{links(r.randint(2, 8))}</ul></nav>", f'<div class="menu"><ul>{links(r.randint(2, 8))}</ul></div>', f"<nav><p>{text(1, 12)}</p></nav>", ""])
        top = maybe(0.3, f"<header><h2>{text(1, 6)}</h2><p>{text(2, 12)}</p></header>", f'<div class="header">{text(1, 8)}</div>')
        foot = r.choice([f"<footer>{text(3, 30)}</footer>", f"<footer><p>{text(2, 20)}</p><ul>{links(3)}</ul></footer>", f'<div class="footer">{text(2, 20)}</div>', ""])
        yield f"<!DOCTYPE html><html>{head}<body>{top}{nav}<!-- x -->{extra(0.3)}<{box}>{main}</{box.split()[0]}>{extra(0.2)}{maybe(0.2, comments())}{foot}</body></html>"


@lru_cache(maxsize=1)
def trained(n: int = 600, seed: int = 11) -> dict:
    """Potentials from labelled_pages(): a node is content if content stands in it or below it."""
    own: dict[int, Counter] = {0: Counter(), 1: Counter()}
    pairs: Counter = Counter()
    total = Counter()
    for page in labelled_pages(n, seed):
        marked = Tree(page)
        state = [0] * len(marked.tag)
        text = [0] * len(marked.tag)
        for node, _, piece in marked.pieces:
            state[node] |= "\x02" in piece
            text[node] |= bool(piece.strip())
        for i in range(len(state) - 1, 0, -1):
            state[marked.parent[i]] |= state[i]
        for i, feats in enumerate(marked.features()):
            total[state[i]] += 1
            for f in enumerate(feats):
                own[state[i]][f] += 1
            if i:
                pairs[feats[0], state[marked.parent[i]], state[i]] += 1
    unary = {f: tuple((own[s][f] + 0.5) / (total[s] + 1) for s in (0, 1)) for f in own[0] | own[1]}
    edge = {}
    for g in {*GROUPS, "box", "inline"}:
        rows = []
        for s in (0, 1):
            k = [pairs[g, s, t] + 0.5 for t in (0, 1)]
            # P(group | state) is in the unary potential already: keep only what the parent adds
            share = [k[t] / sum(k) / ((own[t][0, g] + 0.5) / (sum(own[u][0, g] for u in (0, 1)) + 1)) for t in (0, 1)]
            rows.append(tuple(share))
        edge[g] = tuple(rows)
    prior = (total[0] + 1) / (total[0] + total[1] + 2)
    return {"unary": unary, "edge": edge, "root": (prior, 1 - prior)}


def extract(html: str, model: dict, threshold: float = 0.5) -> str:
    """The main text of a page: content blocks in page order, one line each."""
    tree = Tree(html)
    content = [b >= threshold for b in marginals(tree, model)]
    lines, block, held = [], None, []
    for node, at, piece in tree.pieces:
        if at != block:
            lines.append("".join(held))
            block, held = at, []
        if content[node]:
            held.append(piece)
    lines.append("".join(held))
    return "\n".join(x for x in (SPACE.sub(" ", line).strip() for line in lines) if x)


def main_text(pages: DataFrame, html_col: str = "html", model: dict | None = None) -> DataFrame:
    """The rows of pages (all columns) with `main_text`; a null page counts as empty and has an empty text."""
    from pyspark.sql import functions as F

    model = model or trained()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in batches:
            yield pa.array([extract(h or "", model) for h in part.to_pylist()], pa.string())

    return pages.withColumn("main_text", F.arrow_udf(run, "string")(F.col(html_col)))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = trained()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, pages in texts(batches, "page_id", "url", "html"):
            found = [extract(h or "", model) for h in pages]
            yield pa.record_batch({"page_id": pa.array(ids, pa.int64()), "url": pa.array(urls, pa.string()), "text": pa.array(found, pa.string()), "n_chars": pa.array(map(len, found), pa.int64())})

    return table(spark, sf_dir, "pages").select("page_id", "url", "html").mapInArrow(rows, "page_id long, url string, text string, n_chars long")
