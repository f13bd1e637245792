"""Main text of HTML pages by tree scoring."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geospan.llm.common import map_batches, slices

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role|hidden|style|aria-hidden|itemprop)(?=[\s=/>]|$)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr keygen".split())
RAW = frozenset("script style noscript template textarea title iframe svg object noembed noframes xmp plaintext".split())
#: Elements that are never text, and those that stand around an article unless they hold most of the page.
NEVER = frozenset("head button select option canvas audio video map input annotation annotation-xml".split()) | RAW
OUTSIDE = frozenset("nav aside footer form dialog menu".split())
BLOCK = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
                  "h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: A start tag of the key ends an open element of the values, up to the named boundaries.
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
        "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
#: Words in class, id and role that mark what stands around an article, and what holds one.
AROUND = re.compile(r"(?:^|[-_\s])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|"
                    r"nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|footer|foot|header|masthead|topbar|toolbar|social|share\w*|sharing|"
                    r"comments?|commentlist|respond|reply|replies|disqus|discussion|related|recommend\w*|more|tags?|pager|pagination|"
                    r"newsletter|subscri\w*|signup|login|search\w*|form|widget\w*|copyright|legal|disclaimer|skip|hidden|contentinfo|"
                    r"complementary|navigation|byline|meta|author|rating)(?=$|[-_\s\d])", re.I)
#: Of these, words that also name parts of articles: such an element is left out only if it has no text of its own.
WEAK = re.compile(r"(?:^|[-_\s])(?:related|recommend\w*|more|tags?|legal|disclaimer|copyright|side|header|footer|foot|meta|author|byline|"
                  r"rating|search\w*|form)(?=$|[-_\s\d])", re.I)
#: Sentences of notices, which are no text of an article's own.
NOTICE = re.compile(r"©|copyright|all rights reserved|cookie|privacy policy|subscribe|sign up|newsletter|advertis", re.I)
SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)\]]*\Z")
#: Class words that only speak of such things: 'with-sidebar', 'has-ads'.
ABOUT = re.compile(r"(?:with|without|no|has|not|hide|show)[-_]", re.I)
#: A class word that names the article itself, whatever other words stand beside it.
NAMES = re.compile(r"(?:^|[-_])(?:article|content|main|body|entry|post|story)(?=$|[-_\d])", re.I)
HOLDS = re.compile(r"article|content|main|body|entry|post|story|text|page", re.I)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


@dataclass
class Node:
    tag: str
    parent: "Node | None"
    name: str = ""
    out: bool = False
    around: bool = False  # by its tag or name it stands around the article
    weak: bool = False  # by its name only, and by a word that an article's own parts have, too
    kids: list = field(default_factory=list)  # nodes, and str for text
    score: float = 0.0
    length: int = 0
    linked: int = 0


def parse(page: str) -> Node:
    """A tree of the page.  Bad markup is taken as browsers take it: unclosed paragraphs and list items
    end where the next begins, stray end tags are ignored, what is open at the end is closed."""
    top = node = Node("html", None)
    at, end = 0, len(page)
    while at < end:
        m = MARKUP.search(page, at)
        if not m:
            node.kids.append(page[at:])
            break
        if m.start() > at:
            node.kids.append(page[at:m.start()])
        at = m.end()
        if m.group(1):
            node.kids.append(m.group(1))
        tag = (m.group(3) or "").lower()
        if not tag:
            continue
        if m.group(2):
            seen = node
            while seen is not None and seen.tag != tag:
                # an inline end tag doesn't close the blocks it was opened around
                seen = None if tag not in BLOCK and seen.tag in BLOCK else seen.parent
            if seen is not None and seen.parent is not None:
                node = seen.parent
            elif tag == "p":
                node.kids.append(Node("br", node))
            continue
        if tag in BLOCK:
            node = _end_paragraph(node)
        if tag in ENDS:
            names, bounds = ENDS[tag]
            seen = node
            while seen.parent is not None and seen.tag not in bounds and seen.tag not in names.split():
                seen = seen.parent
            if seen.tag in names.split() and seen.parent is not None:
                node = seen.parent
                if tag == "tr" and node.tag == "tr":
                    node = node.parent or node
        new = Node(tag, node)
        if m.group(4):
            found = {a.group(1).lower(): next((g for g in a.groups()[1:] if g is not None), "") for a in ATTRIBUTE.finditer(m.group(4))}
            new.name = " ".join(found.get(k, "") for k in ("class", "id", "role")).strip()
            new.out = ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
                       or "display:none" in found.get("style", "").replace(" ", "").lower())
        new.out |= tag in NEVER
        new.around = tag in OUTSIDE or bool(new.name and tag not in ("html", "body", "article", "main") and _stands_around(new.name))
        new.weak = new.around and tag not in OUTSIDE and not _stands_around(WEAK.sub(" ", new.name))
        if tag == "header" and not new.around:  # of the page, unless it heads an article
            seen = node
            while seen is not None and seen.tag not in ("article", "main"):
                seen = seen.parent
            new.around = seen is None
        node.kids.append(new)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*(?:>|/)", re.I).search(page, at)
            at = page.find(">", close.start()) + 1 or end if close else end
        elif tag not in VOID and not m.group(0).endswith("/>"):
            node = new
    return top


def _stands_around(name: str) -> bool:
    """Whether a word of a class, id or role says so, and none names the article itself."""
    if not AROUND.search(name):
        return False
    words = [w for w in name.split() if not ABOUT.match(w)]
    return any(AROUND.search(w) for w in words) and not any(NAMES.search(w) and not AROUND.search(w) for w in words)


def _leave_out(top: Node) -> None:
    """Marks as out what stands around the article, but never what holds more than half of the
    page's points for commas and length of text that isn't linked, nor, where the name alone says so and
    by a weak word, what has sentences or a heading and few links.  A button in the midst of a paragraph's text is
    text."""
    order, stack = [], [(top, False)]
    points: dict[int, list[float]] = {}  # points, characters, linked characters, sentences or headings
    while stack:
        node, linked = stack.pop()
        linked |= node.tag == "a"
        order.append(node)
        texts = [k for k in node.kids if isinstance(k, str)]
        size = sum(len(k.strip()) for k in texts)
        told = sum(1 for k in texts if SENTENCE.search(k.strip()) and not NOTICE.search(k)) + (node.tag in HEADINGS)
        points[id(node)] = [0.0 if linked else sum(k.count(",") for k in texts) + size / 100, size, size if linked else 0, told]
        if node.tag == "p" and any(k.strip() for k in texts):
            for k in node.kids:
                if isinstance(k, Node) and k.tag == "button":
                    k.out = False
        stack.extend((k, linked) for k in node.kids if isinstance(k, Node) and not k.out)
    for node in reversed(order):
        if node.parent is not None and id(node.parent) in points:
            above, mine = points[id(node.parent)], points[id(node)]
            for k in range(4):
                above[k] += mine[k]
    half = points[id(top)][0] / 2
    for node in order:
        mine, size, linked, told = points[id(node)]
        own = node.weak and told and size >= 40 and linked < 0.3 * size
        node.out |= node.around and mine <= half and not own


def _end_paragraph(node: Node) -> Node:
    seen = node
    while seen is not None and (seen.tag == "p" or seen.tag not in BLOCK):
        if seen.tag == "p":
            return seen.parent
        seen = seen.parent
    return node


def _clean(text: str) -> str:
    return SPACE.sub(" ", html.unescape(text)).strip()


def blocks(node: Node, linked: bool = False) -> list[tuple[Node, str, float]]:
    """(element, text, share of link text) of the blocks below a node, in page order."""
    out: list[tuple[Node, str, float]] = []
    held: list[str] = []
    held_by, links = node, 0

    def flush():
        nonlocal links
        if held and (text := _clean("".join(held))):
            out.append((held_by, text, min(1.0, links / len(text))))
        held.clear()
        links = 0

    stack = [(node, iter(node.kids), linked)]
    while stack:
        here, kids, inside = stack[-1]
        kid = next(kids, None)
        if kid is None:
            stack.pop()
            if here.tag in BLOCK:
                flush()
                held_by = next((n for n, _, _ in reversed(stack) if n.tag in BLOCK), node)
        elif isinstance(kid, str):
            held.append(kid)
            if inside:
                links += len(kid.strip())
        elif kid.tag == "br":
            held.append(" ")
        elif not kid.out:
            if kid.tag in BLOCK:
                flush()
                held_by = kid
            stack.append((kid, iter(kid.kids), inside or kid.tag == "a"))
        elif kid.tag in BLOCK:
            flush()
    flush()
    return out


def main_text(page: str) -> str:
    """The article's blocks, one to a line; empty if the page has no text outside its surroundings.

    Every block of text passes points to its element's ancestors: one, one for each comma and one for
    every hundred characters, in full to the first, half to the second, less further up; points
    shrink with the share of text that is linked.  The container with the most points is kept, with
    those of its siblings that are text of their own (few links, and either a fifth of its points
    or a paragraph or heading) and bare text beside it that reads like text; of what stands inside, all
    blocks are kept, linked ones and figures too, but menus, forms, notices and the like are left out,
    unless they hold most of the page.  Of containers with equal points the first to be met from below
    counts; a page is held as a tree, so a task's memory follows its longest page.
    """
    top = parse(page)
    _leave_out(top)
    found = blocks(top)
    if not found:
        return ""
    marks: dict[int, Node] = {}
    for element, text, linked in found:
        points = (1 + text.count(",") + min(3.0, len(text) / 100)) * (1 - linked)
        inner = element.tag in HEADINGS or element.tag in ("p", "pre", "blockquote", "li", "td")
        node, share, depth = element.parent or element if inner else element, 1.0, 0
        while node is not None:
            marks[id(node)] = node
            node.score += points * share
            node.length += len(text)
            node.linked += int(len(text) * linked)
            depth += 1
            share = 1.0 / (2 * depth)
            node = node.parent

    def rank(n: Node) -> float:
        bonus = 25.0 if n.tag in ("article", "main") else 5.0 if n.name and HOLDS.search(n.name) else 0.0
        return (n.score + bonus) * (1 - n.linked / max(1, n.length)) * (0.5 if n.around else 1.0)
    best = max((n for n in marks.values() if n.tag not in ("html",) or len(marks) == 1), key=rank, default=top)
    keep = [best]
    if best.parent is not None and best.tag not in ("article", "main", "body"):
        least = 0.2 * rank(best)
        keep = []
        for n in best.parent.kids:
            if n is best:
                keep.append(n)
            elif isinstance(n, str) or n.tag not in BLOCK:
                if keep and keep[-1] is not best and keep[-1].tag == "#run":
                    keep[-1].kids.append(n)
                else:
                    keep.append(Node("#run", best.parent, kids=[n]))
            elif not n.out and not n.around:
                own = blocks(n)
                size = sum(len(t) for _, t, _ in own)
                linked = sum(len(t) * k for _, t, k in own) / max(1, size)
                if rank(n) >= least and linked < 0.3 or n.tag in HEADINGS | {"p", "pre", "blockquote"} and linked < 0.25 and size:
                    keep.append(n)
        keep = [n for n in keep if n.tag != "#run" or _is_text(n)]
    elif best.tag == "article" and best.parent is not None:
        # a page may cut its article into several of one kind
        keep = [n for n in best.parent.kids if n is best or isinstance(n, Node) and n.tag == "article" and not n.out and rank(n) >= 0.2 * rank(best)]
    return "\n".join(t for n in keep for _, t, _ in blocks(n))


def _is_text(run: Node) -> bool:
    """Whether bare text beside the container reads like text: a sentence of three words or more, or 80
    characters; few links; no notice."""
    own = blocks(run)
    text = " ".join(t for _, t, _ in own)
    linked = sum(len(t) * k for _, t, k in own) / max(1, len(text))
    return linked < 0.3 and not NOTICE.search(text) and (len(text) >= 80 or len(text.split()) >= 3 and bool(SENTENCE.search(text)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page, whole; a null page has empty text."""
    def run(batches):
        for batch, texts in slices(batches, "html"):
            out = [main_text(t) for t in texts]
            yield {"page_id": batch.column(0), "url": batch.column(1), "text": out, "n_chars": pa.array([len(t) for t in out], pa.int64())}
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")
