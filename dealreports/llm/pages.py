"""Main text of HTML pages by composite text density.

A page is read into a tree of elements with a small tag reader that closes what HTML leaves open. For every node
``C`` counts the characters of its text, ``T`` its tags (but for those that only mark words), ``LC`` and ``LT`` those inside links. The composite text
density is

    C / T * log(C * T / (LC * LT)) / log(log(C / notLC * LC + C_body / LC_body * C + e))

with counts of 0 taken as 1 (``notLC`` are the characters outside links): characters per tag, adjusted by links. The
density sum of a node adds up the densities of its children. The threshold is the smallest density on the path from
the body to the node with the largest density sum. Where article and main elements hold most of the text outside links,
the main content is those of them whose density reaches it, and the headings directly before them; nothing beside them
is taken. Elsewhere it is every subtree whose density reaches it, taken as high below the body as it does and whole,
and headings go with what they stand before. Within the content menus, forms, adverts, comments and the like are left
out by their tags, roles and class names. Link blocks inside article and main elements stay; elsewhere lists and divisions of
several links with a lower density than the threshold are left out.
"""

import html
import re
from functools import lru_cache
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of HTML: elements without content, with text that is no markup, and elements that begin a new block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
# What an open element is closed by, when HTML lets its end tag be left out.
_LIST, _CELL, _ROW = frozenset(["li"]), frozenset(["td", "th"]), frozenset(["tr"])
CLOSED_BY = {
    "li": (_LIST, frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "td": (_CELL, frozenset("tr table".split())),
    "th": (_CELL, frozenset("tr table".split())),
    "tr": (_ROW | _CELL, frozenset("table tbody thead tfoot".split())),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
}
CLOSES_P = BLOCK - frozenset("body br button caption dd details head html legend optgroup option select summary td th tr title tbody tfoot thead".split())
# Elements that mark words within a text; they do not count as tags, or emphasis would thin a text out.
FORMAT = frozenset("abbr b bdi bdo br cite code data dfn em font i kbd mark q s samp small span strong sub sup time tt u var wbr".split())
# Parts that are never main text, by element, by role, and by words of class and id.
NOT_TEXT = frozenset(
    "nav footer aside script style noscript template iframe object svg canvas button select textarea input "
    "head menu dialog label".split()
)
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disclaimer disqus footer gdpr header latest masthead menu modal nav navbar "
    "navigation newsletter notice overlay pagination pager popular popup promo promoted promotion recommended related "
    "replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar trending widget".split()
)
# After another noun these may mean something else: market-share, oil-alert.
AMBIGUOUS_WORDS = frozenset("alert alerts latest notice popular promotion recommended related respond share sharing social trending".split())
FORMS = frozenset("form fieldset".split())  # some hold the whole page
# Words of compound names that tell about layout, and first words of names that tell about what lies beside a part.
LAYOUT_WORDS = frozenset(
    "area bar block body bottom box buttons col column container content form holder icons inner item items left link "
    "links list main outer panel posts right row section slot text thread top unit wrap wrapper zone".split()
)
BESIDE_WORDS = frozenset("has no with without".split())
# Within an article these words mark its own parts; on an article or main element only those of the second list count.
HEADING_WORDS = frozenset("header banner masthead".split())
ARTICLE_NOT_TEXT_WORDS = frozenset(
    "comment comments replies respond ad ads adsbygoogle advert advertisement related sponsored promo".split()
)
# The shortest listed word that counts at the end of a longer one: usercomments, but not thread.
LEAST_ENDING = 5
ARTICLES = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Outside articles, these parts are left out if their density is low and more of their characters are in several links.
LISTS = frozenset("ul ol dl dir div section center".split())
LINK_DENSE = 0.5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "attributes", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "end")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): (v[1:-1] if v[:1] in "\"'" and v else v) for k, v in _ATTRIBUTE.findall(text)} if text else {}


def parse(source: str) -> Node:
    """The tree of a page. Texts are the strings among a node's children, with character references decoded."""
    root = Node("#root", {})
    stack, at = [root], 0

    def text(raw: str) -> None:
        if raw:
            stack[-1].children.append(html.unescape(raw) if "&" in raw else raw)

    while at < len(source):
        found = _TAG.search(source, at)
        if not found:
            break
        text(source[at : found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if found["cdata"]:
            text(found["cdata"])
        if not name:
            continue
        if found["close"]:
            _end(stack, name)
            continue
        _make_room(stack, name)
        node = Node(name, _attributes(found["rest"]))
        stack[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(source, at)
            stop = end.start() if end else len(source)
            node.children.append(html.unescape(source[at:stop]) if name in ("title", "textarea") else source[at:stop])
            at = (source.find(">", stop) + 1 or len(source)) if end else stop
        elif name not in VOID and not found["rest"].endswith("/") or name not in VOID and name in BLOCK:
            stack.append(node)
    text(source[at:])
    return root


def _end(stack: list[Node], name: str) -> None:
    """Closes the nearest open element of that name; blocks are not closed by the end of an inline element."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name == name:
            del stack[i:]
            return
        if name not in BLOCK and stack[i].name in BLOCK:
            return


def _make_room(stack: list[Node], name: str) -> None:
    if name in CLOSES_P:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name == "p":
                del stack[i:]
                break
            if stack[i].name in BLOCK:
                break
    if name in CLOSED_BY:
        closed, within = CLOSED_BY[name]
        cut = len(stack)
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in within:
                break
            if stack[i].name in closed:
                cut = i
        del stack[cut:]


def nodes(root: Node) -> list[Node]:
    """All nodes, parents before their children."""
    out, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        out.append(node)
        waiting.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def _unwanted(node: Node, in_article: bool) -> bool:
    """Whether a part is no text by its element, its role or as it is hidden."""
    if node.name in NOT_TEXT or node.name == "header" and not in_article:
        return True
    a = node.attributes
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(a.get("style", "")):
        return True
    return a.get("role", "").lower() in NOT_TEXT_ROLES


def _named(node: Node, in_article: bool) -> tuple[int, bool]:
    """How far class and id name a part as no text: 0 not, 1 perhaps, 2 surely; and whether as comments, adverts or such.

    A name is the last of a token's words that does not tell about layout: ``article-footer``, ``cookie-bar``,
    ``commentList``. Before other words (``social-history``), and some after others (``market-share``), it may mean
    something else; ``has-sidebar`` tells about what lies beside.
    """
    if node.name in FORMS:
        return 2, False
    listed = ARTICLE_NOT_TEXT_WORDS if node.name in ARTICLES else NOT_TEXT_WORDS - HEADING_WORDS if in_article else NOT_TEXT_WORDS
    level, alien = 0, False
    for token in f"{node.attributes.get('class', '')} {node.attributes.get('id', '')}".split():
        words = list(_words(token))
        if listed.isdisjoint(words) or words[0] in BESIDE_WORDS:
            continue
        while words[-1] in LAYOUT_WORDS:
            words.pop()
        if words[-1] in listed and (len(words) == 1 or words[-1] not in AMBIGUOUS_WORDS or words[-2] in NOT_TEXT_WORDS):
            level, alien = 2, alien or words[-1] in ARTICLE_NOT_TEXT_WORDS
        else:
            level = max(level, 1)
    return level, alien


@lru_cache(1 << 16)
def _words(token: str) -> tuple[str, ...]:
    """Words of a name, cut at marks and changes of case; compounds of a listed word and another are two words."""
    words = []
    for word in re.findall("[A-Z]+(?![a-z])|[A-Z]?[a-z]+", token):
        word = word.lower()
        if word not in NOT_TEXT_WORDS and word not in LAYOUT_WORDS:
            cuts = [k for k in range(2, len(word) - 1) if word[:k] in NOT_TEXT_WORDS and word[k:] in LAYOUT_WORDS]
            cuts += [k for k in range(2, len(word) - LEAST_ENDING + 1) if word[k:] in NOT_TEXT_WORDS]
            if cuts:
                words.append(word[: cuts[0]])
                word = word[cuts[0] :]
        words.append(word)
    return tuple(words)


def _without(body: Node, unwanted) -> None:
    waiting = [(body, False)]
    while waiting:
        node, in_article = waiting.pop()
        in_article = in_article or node.name in ARTICLES
        node.children = [c for c in node.children if isinstance(c, str) or not unwanted(c, in_article)]
        waiting += [(c, in_article) for c in node.children if isinstance(c, Node)]


def _without_unwanted(body: Node) -> None:
    """Takes out what is never main text; it has no part in the densities either.

    Names are weighed against the text: a part stays if it holds most of the text of articles, or of all text where
    there are none. Comments and the like stay only if no article is outside of them. A doubtful name counts for a
    part that is mostly links or less than half as dense as the body.
    """
    _without(body, _unwanted)
    order = nodes(body)
    _measure(order)
    _score(order, body)
    names: dict[int, tuple[int, bool]] = {}
    waiting = [(body, False, False)]
    outside = 0  # articles that are in no part named as comments or the like
    while waiting:
        node, in_article, in_alien = waiting.pop()
        names[id(node)] = _named(node, in_article) if node is not body and (node.attributes or node.name in FORMS) else (0, False)
        in_alien = in_alien or names[id(node)] == (2, True)
        in_article = in_article or node.name in ARTICLES
        outside += node.name in ARTICLES and not in_alien and node.chars > node.link_chars
        waiting += [(c, in_article, in_alien) for c in node.children if isinstance(c, Node)]
    if not any(level for level, _ in names.values()):
        return
    held = _articles(order, {k for k, name in names.items() if name == (2, True)})
    all_held, plain_body = held[id(body)], body.chars - body.link_chars

    def named_unwanted(node: Node, in_article: bool) -> bool:
        level, alien = names[id(node)]
        if not level or not node.chars:
            return level == 2
        plain = node.chars - node.link_chars
        most = 2 * held[id(node)] > all_held if all_held else 2 * plain > plain_body and not alien
        if most and not (alien and (outside or node.name in ARTICLES)):
            return False
        return level == 2 or 2 * plain < node.chars or 2 * node.density < body.density

    _without(body, named_unwanted)


def _measure(order: list[Node]) -> None:
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        inside = node.name == "a"
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            elif child.name not in ("script", "style", "noscript", "template", "head"):
                node.chars += child.chars
                node.tags += child.tags + (child.name not in FORMAT)
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.name == "a")
        if inside:
            node.link_chars, node.link_tags = node.chars, node.tags


def _score(order: list[Node], body: Node) -> None:
    of_body = max(body.link_chars, 1) / max(body.chars, 1)
    for node in reversed(order):
        chars, tags = max(node.chars, 1), max(node.tags, 1)
        links, link_tags, plain = max(node.link_chars, 1), max(node.link_tags, 1), max(node.chars - node.link_chars, 1)
        if node.chars:
            base = log(chars / plain * links + of_body * chars + e)
            node.density = chars / tags * log(max(chars * tags / (links * link_tags), 1)) / log(base) if base > 1 else 0.0
        node.total = sum(c.density for c in node.children if isinstance(c, Node))


def _articles(order: list[Node], but: set[int] = frozenset()) -> dict[int, int]:
    """For each node the characters outside links that article and main elements hold, itself or below."""
    held: dict[int, int] = {}
    for node in reversed(order):
        if node.name in ARTICLES and id(node) not in but:
            held[id(node)] = node.chars - node.link_chars
        else:
            held[id(node)] = sum(held[id(c)] for c in node.children if isinstance(c, Node))
    return held


def main_nodes(root: Node) -> tuple[list[Node], float]:
    """The subtrees of the main content in page order and the density threshold of the path from the body."""
    order = nodes(root)
    body = next((n for n in order if n.name == "body"), root)
    _without_unwanted(body)
    within = nodes(body)
    _measure(within)
    _score(within, body)
    parents = {id(c): n for n in within for c in n.children if isinstance(c, Node)}
    best = max(within, key=lambda n: n.total)
    path = [best]
    while id(path[-1]) in parents:
        path.append(parents[id(path[-1])])
    threshold = min(n.density for n in path)
    taken, held = {id(n) for n in path}, _articles(within)  # taken whatever their density: the path, and headings
    headings: set[int] = set()
    in_articles = 2 * held[id(body)] > body.chars - body.link_chars

    def whole(node: Node) -> bool:
        if node.name in ARTICLES:
            return True
        if in_articles:
            return id(node) in headings
        if 2 * held[id(node)] > node.chars - node.link_chars:  # what an article or main element holds is looked for in it
            return False
        own = node.chars - sum(c.chars for c in node.children if isinstance(c, Node))
        return node is not body or node is best or 2 * own > node.chars - node.link_chars

    # The highest nodes that are as dense as the threshold asks; the body, which is on the path, only if the text is its own.
    chosen, waiting = [], [body]
    while waiting:
        node = waiting.pop()
        reaches = node.chars and (id(node) in taken or node.density >= threshold)
        if reaches and whole(node):
            chosen.append(node)
            continue
        inner = [c for c in node.children if isinstance(c, Node)]
        for child, after in reversed([*zip(inner, [*inner[1:], None])]):
            if _heads(child, after) and (id(after) in taken or after.density >= threshold):
                taken.add(id(child))
                if 2 * held[id(after)] > after.chars - after.link_chars:
                    headings.add(id(child))
            waiting.append(child)
    return chosen or [body], threshold


def _heads(node: Node, after: Node | None) -> bool:
    """Whether a node is the heading of the node after it, which has none of that rank itself."""
    if node.name not in HEADINGS or after is None or 2 * node.link_chars > node.chars:
        return False
    return after.chars > 0 and all(n.name != node.name for n in nodes(after))


def blocks(node: Node, threshold: float = 0.0) -> list[str]:
    """Texts of the blocks below a node in page order, white space made single spaces."""
    out: list[str] = []
    pieces: list[str] = []

    def flush() -> None:
        text = _SPACES.sub(" ", "".join(pieces)).strip()
        pieces.clear()
        if text:
            out.append(text)

    waiting: list = [(node, False)]
    while waiting:
        item, in_article = waiting.pop()
        if isinstance(item, str):
            pieces.append(item)
        elif item is None:
            flush()
        elif in_article or item is node or not _link_list(item, threshold):
            if item.name in BLOCK:
                flush()
                waiting.append((None, False))
            in_article = in_article or item.name in ARTICLES
            waiting.extend((c, in_article) for c in reversed(item.children))
    flush()
    return out


def _link_list(node: Node, threshold: float) -> bool:
    """Whether a part is a menu by its looks: several links and little else."""
    if node.name not in LISTS or node.density >= threshold or node.link_chars <= LINK_DENSE * node.chars:
        return False
    return sum(n.name == "a" and n.chars > 0 for n in nodes(node)) > 1


def main_text(source: str | None) -> str:
    """The main text of a page: blocks joined by one space; a NULL or empty page has none."""
    if not source:
        return ""
    chosen, threshold = main_nodes(parse(source))
    return " ".join(text for node in chosen for text in blocks(node, threshold))


def with_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``; ``html`` may be NULL. Other columns are not read."""

    def rows(batches):
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                texts = [main_text(source) for source in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kept = pages.select("page_id", "url", "html")
    fields = [*kept.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return kept.mapInArrow(rows, T.StructType(fields))
