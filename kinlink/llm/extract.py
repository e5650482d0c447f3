"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read into leaf blocks: the texts between the edges of block elements, each with its open ancestors. A block's
features are the tags and the words of classes and ids of its ancestors, those words of the nearest ancestor that has any, its
own element and the form of its text. The field
is fitted on labelled pages (``labelled_pages`` makes them by rule in many layouts; any others may be given), and Viterbi
gives every block of a page its label in view of its neighbours. Blocks of the article are the page's text.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.llm.common import pieces, slices
from kinlink.llm.crf import Field, fit

LABELS = ["main", "chrome", "advert", "form", "comment"]
FEATURES = 1 << 14

# Elements of HTML by how they take part in the text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr br img input "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mmultiscripts "
    "mprescripts none mtable mtr mtd mpadded mphantom menclose merror semantics annotation annotation-xml".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template iframe head title textarea".split())
#: Hidden elements whose content is no markup: without an end tag they take the rest of the page.
RAW = frozenset("script style iframe title textarea".split())
#: Elements that are no part of a line of text and yet stand inside a paragraph.
IN_PARAGRAPH = frozenset("object svg canvas audio video select".split())
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
_OPEN_QUOTE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_LABEL = re.compile("\ue000(\\w+)\ue001")


class Block:
    __slots__ = ("text", "linked", "own", "around", "near")

    def __init__(self, text: str, linked: int, own: str, around: list[str], near: list[str]):
        self.text, self.linked, self.own, self.around, self.near = text, linked, own, around, near


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in its order. Broken markup is read as far as it goes; a tag cut off at the end is no text."""
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    named: list[list[str]] = []
    opened: Counter = Counter()
    around: Counter = Counter()
    parts: list[str] = []
    linked, in_link, at, n = 0, False, 0, len(page)

    def end_block() -> None:
        nonlocal linked, in_link
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Block(text, min(linked, len(text)), stack[-1][0] if stack else "body", list(around), named[-1] if named else []))
            parts.clear()
        linked, in_link = 0, False

    def close() -> None:
        tag, names = stack.pop()
        opened[tag] -= 1
        if len(names) > 1:
            named.pop()
        around.subtract(names)
        for name in names:
            if not around[name]:
                del around[name]

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text.strip())

    while at < n:
        less = page.find("<", at)
        if less < 0:
            add(page[at:])
            break
        if less > at:
            add(page[at:less])
        if page.startswith("<!--", less):
            end = page.find("-->", less + 4)
            at = n if end < 0 else end + 3
            continue
        following = page[less + 1 : less + 3]
        if following[:1] in ("!", "?"):
            end = page.find(">", less)
            at = n if end < 0 else end + 1
            continue
        name_at = following[1:] if following[:1] == "/" else following[:1]
        if not (name_at.isascii() and name_at.isalpha()):
            add("<")
            at = less + 1
            continue
        found = _TAG.match(page, less)
        if not found:  # a quote that never ends: the tag is taken to end with the next >
            end = page.find(">", less)
            found = _OPEN_QUOTE.match(page, less, end + 1) if end >= 0 else None
            if not found:
                break
        at = found.end()
        closing, tag, rest = found[1], found[2].lower(), found[3]
        if tag in HIDDEN:
            if not closing and not rest.endswith("/"):
                end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(page, at)
                if tag == "head":
                    body = re.compile("<body[\\s>]", re.I).search(page, at)
                    at = min(end.start() if end else n, body.start() if body else n)
                    if at == n and not end and not body:
                        at = found.end()  # a head that never ends: what follows is read
                elif end:
                    close_at = page.find(">", end.start())
                    at = n if close_at < 0 else close_at + 1
                elif tag in RAW:
                    at = n
            continue
        if tag in INLINE:
            if tag == "br":
                add(" ")
            elif tag == "a":
                in_link = not closing
            continue
        end_block()
        if closing:
            if opened[tag] > 0:
                while stack[-1][0] != tag:
                    close()
                close()
            continue
        if stack and stack[-1][0] == "p" and tag not in IN_PARAGRAPH:
            close()
        own = CLOSES_ITSELF.get(tag)
        if own and stack and stack[-1][0] in own:
            close()
        if tag in VOID or rest.endswith("/"):
            continue
        names = [f"t:{tag}"]
        for m in _NAMES.finditer(rest):
            names += [f"c:{w}" for w in _SPLIT.split((m[1] or m[2] or m[3] or "").lower()) if w]
        stack.append((tag, names))
        if len(names) > 1:
            named.append(names[1:])
        opened[tag] += 1
        around.update(names)
    end_block()
    return out


_known: dict[str, int] = {}


def _number(name: str) -> int:
    if name not in _known:
        if len(_known) > 100_000:
            _known.clear()
        _known[name] = crc32(name.encode("utf-8", "surrogatepass")) % FEATURES
    return _known[name]


def block_features(block: Block) -> list[int]:
    """Hashed features of a block."""
    text, n = block.text, len(block.text)
    words = text.count(" ") + 1
    share = 4 * block.linked // n
    inside = "article" if "t:article" in block.around or "t:main" in block.around else "else"
    names = [
        *block.around,
        *(f"n:{name}" for name in block.near),
        f"o:{block.own}",
        f"o:{block.own}:{inside}",
        f"l:{min(words.bit_length(), 8)}",
        f"l:{min(words.bit_length(), 8)}:{block.own}",
        f"k:{share}",
        f"k:{share}:{block.own}",
        f"e:{text[-1] in '.!?…:;'}:{words > 4}",
        f"g:{'©' in text or 'copyright' in text.lower()}",
        "bias",
    ]
    return [_number(x) for x in names]


def labelled_pages(pages: int = 1200, seed: int = 11) -> list[str]:
    """Pages made by rule in many layouts; each block begins with its label between U+E000 and U+E001."""
    rng = random.Random(seed)
    pick = lambda *of: of[int(rng.random() * len(of))]
    word = lambda: "".join(pick(*"aeiou") + pick(*"bcdfghlmnprst") for _ in range(rng.randrange(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randrange(a, b)))
    sentence = lambda: words(1, 14).capitalize() + pick(".", ".", ".", "!", "?", "!!", ",", "")
    mark = lambda label, text: f"\ue000{label}\ue001{text}"
    prose = lambda: " ".join(sentence() for _ in range(rng.randrange(1, 7)))
    named = lambda *of: pick(f' class="{pick(*of)}"', f' id="{pick(*of)}"', f' class="{word()} {pick(*of)}"')

    def links(label: str, low: int = 2, high: int = 8) -> str:
        item = lambda: f'<li><a href="/{word()}">{mark(label, words(1, 3))}</a></li>'
        return f"<ul>{''.join(item() for _ in range(rng.randrange(low, high)))}</ul>"

    def loose(label: str) -> str:
        text = pick(prose(), sentence(), words(1, 4))
        return pick(f"<p>{mark(label, text)}</p>", mark(label, text), f"<h3>{mark(label, words(1, 4))}</h3><p>{mark(label, text)}</p>")

    def chrome() -> str:
        return pick(
            f"<nav{pick('', named('menu', 'nav', 'navbar', 'breadcrumb'))}>{links('chrome')}</nav>",
            f"<div{named('menu', 'nav', 'navigation', 'topbar', 'breadcrumbs')}>{links('chrome')}</div>",
            f"<header{pick('', named('header', 'site', 'masthead'))}>{pick('<h1>%s</h1>' % mark('chrome', words(1, 4)), loose('chrome'))}{pick('', links('chrome'))}</header>",
            f"<div{named('header', 'masthead', 'banner')}>{loose('chrome')}</div>",
            f"<aside{pick('', named('sidebar', 'related', 'widget'))}>{pick(links('chrome'), loose('chrome'))}</aside>",
            f"<div{named('sidebar', 'related', 'widget', 'share', 'social', 'tags', 'popular', 'trending')}>{pick(links('chrome'), loose('chrome'))}</div>",
            f"<div{named('cookie', 'notice', 'consent', 'gdpr', 'alert', 'banner', 'popup', 'modal', 'disclaimer', 'newsletter', 'paywall')}>{loose('chrome')}{pick('', '<button>%s</button>' % mark('chrome', words(1, 2)))}</div>",
        )

    def advert() -> str:
        return f"<{(tag := pick('div', 'div', 'aside', 'section', 'p'))}{named('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'adsense', 'sponsor')}>{pick(mark('advert', prose()), mark('advert', words(1, 12)), loose('advert') if tag != 'p' else mark('advert', sentence()))}</{tag}>"

    def form() -> str:
        return f"<form{pick('', named('search', 'login', 'subscribe', 'signup', 'contact'))}>{pick('', '<p>%s</p>' % mark('form', sentence()))}<label>{mark('form', words(1, 3))}</label><input name=q><button>{mark('form', words(1, 2))}</button></form>"

    def comments() -> str:
        one = lambda: f"<{(t := pick('div', 'li', 'article'))}{named('comment', 'reply', 'comment-body')}>{pick('', '<h4>%s</h4>' % mark('comment', words(1, 3)))}<p>{mark('comment', prose())}</p></{t}>"
        plain = lambda t: f"<{t}>{mark('comment', prose())}</{t}>"
        kind = pick("", "", "p", "p", "li", "li", "div")
        body = "".join(plain(kind) if kind else one() for _ in range(rng.randrange(1, 5)))
        if kind == "li":
            body = pick("<ul>%s</ul>", "<ol>%s</ol>", "%s") % body
        return f"<{(t := pick('section', 'div', 'ol'))}{named('comments', 'comment-list', 'commentlist', 'comments-area', 'usercomments', 'responses', 'discussion', 'disqus', 'replies', 'reactions')}>{pick('', '<h3>%s</h3>' % mark('comment', words(1, 3)))}{body}</{t}>"

    def footer() -> str:
        legal = mark("chrome", pick("&copy; ", "© ", "Copyright ", "") + words(1, 6) + pick("", " &middot; " + prose()))
        return pick(f"<footer{pick('', named('footer', 'site'))}>{pick(legal, '<p>%s</p>' % legal)}{pick('', links('chrome'))}</footer>", f"<div{named('footer', 'copyright', 'legal', 'colophon')}>{legal}</div>")

    def article(container: bool) -> str:
        out = [pick("", f"<h1>{mark('main', words(1, 9).capitalize())}</h1>")]
        for _ in range(rng.randrange(1, 12)):
            kind = rng.randrange(14)
            bold = pick("", "", "<b>", "<i>")
            text = mark("main", pick(prose(), prose(), sentence(), words(1, 3).capitalize() + "."))
            if kind < 7:
                out.append(pick(f"<p>{bold}{text}</p>", f"<p>{bold}{text}<br>", f"<p>{bold}{text}</p>\n"))
            elif kind == 7:
                out.append(f"<h2>{mark('main', words(1, 5))}</h2><p>{text}</p>")
            elif kind == 8:
                items = "".join(f"<li>{mark('main', sentence())}</li>" for _ in range(rng.randrange(1, 5)))
                out.append(f"<{(t := pick('ul', 'ol'))}>{items}</{t}>")
            elif kind == 9:
                out.append(pick(f"<blockquote><p>{text}</p></blockquote>", f"<pre>{text}</pre>", f"<table><tr><td>{mark('main', words(1, 4))}</td><td>{mark('main', words(1, 4))}</td></tr></table>", f"<figure><figcaption>{text}</figcaption></figure>", f"<div>{text}</div>", f"<section><p>{text}</p></section>"))
            elif kind == 10:
                items = "".join(f"<li><a href='/{word()}'>{mark('main', pick(sentence(), words(1, 5)))}</a></li>" for _ in range(rng.randrange(1, 5)))
                out.append(pick(f"<{(t := pick('ul', 'ol'))}>{items}</{t}>", f"<p><a href='/{word()}'>{text}</a></p>", f"<noscript><p>{text}</p></noscript>"))
            elif kind == 11:
                out.append(pick(text, f"{text}<br><br>{prose()}", f"{text}<br>{sentence()}<br>", f"<b>{text}</b>"))
            elif container:
                out.append(pick(advert(), advert(), form(), f"<div{named('share', 'related', 'notice', 'newsletter', 'tags')}>{pick(links('chrome'), loose('chrome'))}</div>"))
        return "".join(out)

    made = []
    for _ in range(pages):
        body = [pick(chrome, chrome, advert, form)() for _ in range(rng.randrange(0, 5))]
        shape = rng.randrange(10)
        container = named("content", "post", "entry", "article", "story", "body", "text", "main")
        inner = article(shape != 9) if rng.randrange(3) else mark("main", pick("", "<br>", "<br><br>").join([*(prose() for _ in range(rng.randrange(1, 5)))]))
        body.append(
            f"<article{pick('', '', container)}>{inner}</article>" if shape < 4
            else f"<main>{pick('<article>%s</article>', '%s', '<div>%s</div>') % inner}</main>" if shape == 4
            else f"<div{container}>{inner}</div>" if shape < 9
            else inner
        )
        body += [pick(chrome, advert, form, comments, comments, comments)() for _ in range(rng.randrange(0, 5))]
        body.append(pick(footer, footer, lambda: "")())
        if not rng.randrange(12):  # a piece of a page
            made.append(article(False))
            continue
        tail = pick("</body></html>", "</body></html>", "")
        made.append(f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title><style>p{{}}</style></head><body>{''.join(body)}{tail}")
    return made


def fit_field(pages: list[str] | None = None) -> Field:
    """The field fitted on labelled pages."""
    sequences = []
    for page in labelled_pages() if pages is None else pages:
        items, labels = [], []
        for block in leaf_blocks(page):
            found = _LABEL.search(block.text)
            block.text = _LABEL.sub("", block.text) or "."
            items.append(block_features(block))
            labels.append(LABELS.index(found[1]) if found else 1)
        if items:
            sequences.append((items, labels))
    return fit(LABELS, FEATURES, sequences, steps=90)


def extract_all(pages: list[str], field: Field) -> list[list[str]]:
    """The blocks of the main text of each page, in page order. A page with a single block that nothing encloses, not even
    ``body``, is text without markup, and that is its main text by definition."""
    read = [leaf_blocks(p) for p in pages]
    lengths = np.array([len(b) for b in read], np.int64)
    own = [block_features(b) for blocks in read for b in blocks]
    if not own:
        return [[] for _ in pages]
    rows = np.repeat(np.arange(len(own)), [len(f) for f in own])
    labels = field.decode(field.emissions(rows, np.concatenate([np.array(f) for f in own]), len(own)), lengths)
    out, at = [], 0
    for blocks in read:
        bare = len(blocks) == 1 and not blocks[0].around
        out.append([b.text for b, label in zip(blocks, labels[at : at + len(blocks)]) if bare or label == 0])
        at += len(blocks)
    return out


def load(spark: SparkSession, pages: list[str] | None = None):
    """The fitted field as a broadcast of fixed size."""
    return spark.sparkContext.broadcast(fit_field(pages))


def main_blocks(html: str | Column, field) -> Column:
    """Array of the blocks of the article. Null, empty and text-free pages have none; text without markup is one block."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for run in slices((t or "" for t in pieces(batch)), 1_000_000):
                rows += extract_all(run, field.value)
            yield pa.array(rows, pa.list_(pa.string()))

    return extract(html)


def extract_table(df: DataFrame, field, html: str = "html", into: str = "text") -> DataFrame:
    """``df`` with the main text of each page, blocks joined by line ends (a column named ``into`` is replaced)."""
    return df.withColumn(into, F.array_join(main_blocks(F.col(f"`{html}`"), field), "\n"))
