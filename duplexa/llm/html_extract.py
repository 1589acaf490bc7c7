"""Main text of web pages: templates from tokens that occur alike on a host's pages, text from what lies between."""

from __future__ import annotations

import hashlib
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duplexa.llm.scratch import Scratch

#: A class is part of a host's template from this many tokens and pages on (all pages of a host with fewer); beyond 500
#: pages, from this share of them on, so that what is gathered for a host is no more than a hundred pages hold.
MIN_PAGES, MIN_SHARE, MIN_TOKENS = 5, 0.01, 3
#: Up to this many template tokens (8 bytes each) the templates are broadcast; beyond, they are joined by host.
BROADCAST_TOKENS = 1_000_000

# Element names of HTML by what they do here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg annotation annotation-xml object canvas audio video select".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
FRAMES = set("#page html body center".split())
PROSE = set("p li blockquote pre dd dt td th caption figcaption h1 h2 h3 h4 h5 h6".split())
SUBHEADS = set("h2 h3 h4 h5 h6".split())
#: A page with this many times more template text than other text is a near copy.
COPY = 10
#: The share of a page's text that may lie beside the region taken for the article.
REST = 0.1
CHROME = set("head nav footer aside form button dialog menu input label fieldset search".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
#: Words of class and id names that mark what surrounds an article.
MARKS = set(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup sidebar sidebars widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs "
    "topbar masthead footer comment comments commentlist reply replies respond disqus share sharing social related recommended recommendations "
    "pagination pager login toolbar copyright banner".split()
)
#: The same as the end of a longer word.
MARK_ENDS = ("nav", "menu", "sidebar", "footer", "comment", "comments", "cookie", "cookies", "banner", "breadcrumbs", "notice", "newsletter", "advert")
REMARKS = set("comment comments reply replies".split())
HEADS = {"header", "heading"}
#: Words, and the form element, that also name boxes around or within articles: what they mark may be kept, see ``_dropped``.
BOXES = set(
    "form header heading promo promotion notice notices sidebar sidebars widget widgets menu menus topbar login toolbar copyright banner related recommended "
    "recommendations pagination pager".split()
)
BOX_ENDS = ("menu", "sidebar", "banner", "notice")
#: Names that tell how a page is laid out, or what it does without: has-sidebar, no-ads, comments-open, ad-free.
LAYOUT = re.compile(r"(?<!\S)(?:(?:has|no|not|with|without|hide)[-_]\S*|\S*[-_](?:open|opened|closed|free|enabled|disabled|off|none))(?!\S)")
WITHOUT = re.compile(r"(?:no|has|with|without)(?=.)")

#: Of RAW, those whose content is never markup, so that an unclosed one takes the rest of the page.
TEXT_ONLY = set("script style iframe textarea title noscript".split())
OPENING = re.compile(r"<(?=[a-zA-Z/!?])")
#: A quote counts as such after an equals sign only. Possessive throughout: nothing is read twice.
TAG = re.compile(r"""<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|)|["'])*+)>""")
CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I) for name in RAW}
#: Elements below this depth are not nested any further.
DEPTH = 256
ATTR = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
WORD = re.compile(r"[a-z]+")


def _markup(source: str):
    """(text, name, attributes, is an end tag) for each tag with the text before it; the last has no name.

    Comments and what RAW elements hold are passed over. Every character is read a bounded
    number of times, whatever is left open: after one tag that only quotes keep from
    ending, all tags end at their first ``>``; no tag begins after the last ``>``; an
    unclosed comment is the rest of the page.
    """
    at, text, last, plain, unclosed = 0, 0, source.rfind(">"), False, set()
    held = []
    while m := OPENING.search(source, at):
        low, mark, comment = m.start(), source[m.start() + 1], source.startswith("<!--", m.start())
        if low > last and not comment:
            break
        if mark in "!?":
            end = source.find("-->" if comment else ">", low + 2)
            held.append(source[text:low])
            at = text = len(source) if end < 0 else end + (3 if comment else 1)
            continue
        tag = None if plain else TAG.match(source, low)
        if tag is None:
            stop = source.find(">", low)
            whole = re.match(r"<(/)?([a-zA-Z][^\s/>]*)(.*)", source[low:stop], re.S)
            if whole is None:
                at = low + 1
                continue
            plain = True
            ends, name, attrs, after = whole[1], whole[2], whole[3], stop + 1
        else:
            ends, name, attrs, after = tag["end"], tag["name"], tag["attrs"], tag.end()
        held.append(source[text:low])
        at = text = after
        name = name.lower()
        if not ends and name in RAW and name not in unclosed and (name in TEXT_ONLY or not attrs.rstrip().endswith("/")):
            close = CLOSING[name].search(source, at)
            if close or name in TEXT_ONLY:
                at = text = close.end() if close else len(source)
                continue
            unclosed.add(name)
        yield "".join(held), name, attrs, bool(ends)
        held = []
    rest = source[text:]
    # An unfinished tag at the very end is markup.
    cut = rest.rfind("<")
    held.append(rest[:cut] if cut >= 0 and re.match(r"<[/a-zA-Z!]", rest[cut:]) and ">" not in rest[cut:] else rest)
    yield "".join(held), None, "", False


class Page:
    """A page's open-element tree and its text blocks, from one tolerant pass over the markup."""

    __slots__ = ("tags", "parents", "paths", "marked", "boxes", "article", "blocks", "links")

    def __init__(self, source: str):
        #: A path is a digest of an element's name and classes and of its parent's path.
        self.tags, self.parents, self.paths = ["#page"], [-1], [b""]
        #: Whether a node is chrome by its markup, or else the names by which it may be; and whether it is an article or in one.
        self.marked, self.boxes, self.article = [False], [frozenset()], [False]
        #: (node, text) in page order, and how many of each block's characters are link text.
        self.blocks: list[tuple[int, str]] = []
        self.links: list[int] = []
        article = self.article
        stack, held, linked, in_link = [0], [], 0, 0
        #: How often each name is open, and of elements not nested any further.
        opened: dict[str, int] = {}
        beyond: dict[str, int] = {}

        def flush():
            nonlocal linked
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                self.blocks.append((stack[-1], text))
                self.links.append(linked)
            held.clear()
            linked = 0

        def pop(n):
            nonlocal in_link
            while len(stack) > n:
                tag = self.tags[stack.pop()]
                opened[tag] -= 1
                in_link -= tag == "a"

        for text, name, attrs, ends in _markup(source):
            if text:
                held.append(text)
                linked += len(text) * (in_link > 0)
            if name is None:
                break
            if name == "br" or name == "wbr":
                held.append(" " if name == "br" else "")
                continue
            block = name in BLOCK
            if ends:
                if beyond.get(name):
                    beyond[name] -= 1
                    if block:
                        flush()
                    continue
                if not opened.get(name):
                    continue
                for n in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[n]] == name:
                        if block:
                            flush()
                        pop(n)
                        break
                    # A stray end tag of inline markup does not close a block around it.
                    if not block and self.tags[stack[n]] in BLOCK:
                        break
                continue
            if block:
                flush()
                # A new block ends an open paragraph with its inline markup, and a new item its predecessor.
                for n in range(len(stack) - 1, 0, -1):
                    tag = self.tags[stack[n]]
                    if tag == "p" or (tag == name and name in ("li", "td", "th", "tr", "dt", "dd", "option")):
                        pop(n)
                        break
                    if tag in BLOCK:
                        break
            words, marks, hidden = set(), set(), False
            if attrs:
                for key, *values in ATTR.findall(attrs):
                    key, value = key.lower(), next((v for v in values if v), "").lower()
                    if key in ("class", "id"):
                        words.update(WORD.findall(value))
                        marks.update(WORD.findall(LAYOUT.sub(" ", value)))
                    elif key == "role":
                        hidden |= value.strip() in ROLES
                    elif key == "style":
                        hidden |= "display:none" in value.replace(" ", "")
                    else:
                        hidden |= key == "hidden" or value == "true"
            parent = stack[-1]
            self.tags.append(name)
            self.parents.append(parent)
            label = name + "".join("." + w for w in sorted(words)) if words else name
            self.paths.append(hashlib.blake2b(self.paths[parent] + label.encode("utf-8", "replace"), digest_size=8).digest())
            heads = {"header"} if not article[parent] and (name == "header" or marks & HEADS) else set()
            article.append(article[parent] or name in ("article", "main"))
            if name in ("body", "html", "article", "main"):
                self.marked.append(hidden or (name == "article" and bool(marks & REMARKS)))
                self.boxes.append(frozenset())
            else:
                named = {w for w in marks if w in MARKS or (w.endswith(MARK_ENDS) and not _without(w))}
                boxes = {w for w in named if w in BOXES or (w not in MARKS and w.endswith(BOX_ENDS))}
                self.marked.append(hidden or (name in CHROME and name != "form") or len(named) > len(boxes))
                self.boxes.append(frozenset(boxes | heads | ({"form"} if name == "form" else set())))
            if name not in VOID and not attrs.rstrip().endswith("/"):
                if len(stack) > DEPTH:
                    beyond[name] = beyond.get(name, 0) + 1
                else:
                    stack.append(len(self.tags) - 1)
                    opened[name] = opened.get(name, 0) + 1
                    in_link += name == "a"
        flush()

    def tokens(self):
        """Each page token once or more, as its key: tags by their path, and texts by path and content."""
        for path in self.paths[1:]:
            yield int.from_bytes(path, "little", signed=True)
        for node, text in self.blocks:
            yield text_key(self.paths[node], text)


def _without(word: str) -> bool:
    """nosidebar, hasbanner: a mark that is said not to be there, or to be somewhere."""
    found = WITHOUT.match(word)
    rest = word[found.end() :] if found else ""
    return rest in MARKS or rest in MARK_ENDS


def text_key(path: bytes, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(path + b" " + text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _below(page: Page, top: int) -> list[bool]:
    """Of each node, whether it is ``top`` or beneath it."""
    inside = [False] * len(page.tags)
    for i in range(len(inside)):
        inside[i] = i == top or (i > 0 and inside[page.parents[i]])
    return inside


def _region(page: Page, blocks: list[int]) -> int:
    """The smallest element that holds ``blocks`` but for REST of their text, link text not counted.

    Within the page's own frame (body and what is around it) that rest may be paragraphs; further
    down, or in a section, paragraphs and headings are the article's and none is left out.
    """
    n = len(page.tags)
    size, prose = [0] * n, [0] * n
    linked = all(page.links[b] >= len(page.blocks[b][1]) for b in blocks)
    for b in blocks:
        node, text = page.blocks[b]
        own = len(text) - (0 if linked else page.links[b])
        size[node] += own
        prose[node] += page.tags[node] in PROSE and 2 * own > len(text)
    # A node's number is larger than its parent's.
    for i in range(n - 1, 0, -1):
        size[page.parents[i]] += size[i]
        prose[page.parents[i]] += prose[i]
    within = [False] * n
    for i in range(1, n):
        within[i] = page.tags[i] == "section" or within[page.parents[i]]
    sections = [0] * n
    for b in blocks:
        node = page.blocks[b][0]
        sections[node] += within[node] and page.tags[node] in PROSE
    for i in range(n - 1, 0, -1):
        sections[page.parents[i]] += sections[i]
    largest = [0] * n
    for i in range(n - 1, 0, -1):
        if not largest[page.parents[i]] or size[i] >= size[largest[page.parents[i]]]:
            largest[page.parents[i]] = i
    top = 0
    while child := largest[top]:
        held = sections if page.tags[top] in FRAMES else prose
        if not size[child] or size[child] < (1 - REST) * size[0] or held[child] < held[top]:
            break
        top = child
    return top


def _between(page: Page, kept: list[int], support: list[int]) -> list[int]:
    """Of the blocks ``kept``, those of the article: the template shows where it begins and ends, and nothing inside it goes."""
    chars = lambda some: sum(len(page.blocks[b][1]) - page.links[b] for b in some)
    # Classes nest by support: a page has those of its layout and, with more pages, those around it.
    levels: dict[int, list[int]] = {}
    for b in kept:
        levels.setdefault(support[b], []).append(b)
    free = levels.pop(0, [])
    # A page of hardly anything besides a class is a near copy of others, and the class is their article.
    for pages in sorted(levels):
        if not free or COPY * chars(free) < chars(levels[pages]):
            free = free + levels.pop(pages)
    free.sort()
    fixed = [True] * len(support)
    for b in free:
        fixed[b] = False
    inside = _below(page, _region(page, free))
    own = [b for b in free if inside[page.blocks[b][0]]]
    start, last = kept.index(own[0]), kept.index(own[-1])
    first = start
    # A heading that many articles have stands before the text that varies.
    while first and fixed[kept[first - 1]] and page.tags[page.blocks[kept[first - 1]][0]] in SUBHEADS:
        first -= 1
    titles = lambda some: [b for b in some if page.tags[page.blocks[b][0]] == "h1" and not fixed[b]]
    # Outside the region, only such headings lie between first and last; the page's title comes with them.
    body = [b for n, b in enumerate(kept) if first <= n <= last and (inside[page.blocks[b][0]] or n < start)]
    return sorted({*body, *titles(kept)})


def _summed(page: Page, of: list[int]) -> list[int]:
    """Of each node, the sum over it and what is beneath it."""
    out = of[:]
    for i in range(len(out) - 1, 0, -1):
        out[page.parents[i]] += out[i]
    return out


def _dropped(page: Page) -> list[bool]:
    """Of each node, whether it lies in what surrounds or interrupts an article.

    Chrome by its markup goes, unless its name alone says so and it holds an article. A name
    or a form that may as well be a box (BOXES) marks nothing on a page where boxes of it
    hold most of the text; within an article a name marks only what is more links than prose.
    """
    n = len(page.tags)
    holds = [t in ("article", "main") and not m for t, m in zip(page.tags, page.marked)]
    for i in range(n - 1, 0, -1):
        holds[page.parents[i]] |= holds[i]
    hard = [False] * n
    for i in range(1, n):
        hard[i] = hard[page.parents[i]] or (page.marked[i] and not (holds[i] and page.tags[i] not in CHROME))
    if not any(page.boxes):
        return hard
    own, prose, links = [0] * n, [0] * n, [0] * n
    for (node, text), linked in zip(page.blocks, page.links):
        if not hard[node]:
            own[node] += len(text) - linked
            links[node] += linked
            prose[node] += len(text) - linked if page.tags[node] in PROSE else 0
    own, prose, links = (_summed(page, x) for x in (own, prose, links))
    # Text in boxes of each name, those within a box of the name not counted again.
    named: dict[str, int] = {}
    within: list[frozenset] = [frozenset()] * n
    for i in range(1, n):
        above = within[page.parents[i]]
        within[i] = above | page.boxes[i] if page.boxes[i] else above
        for word in page.boxes[i] - above:
            if word == "form" or not page.article[page.parents[i]]:
                named[word] = named.get(word, 0) + own[i]
    usual = {word for word, size in named.items() if 2 * size > own[0]}
    out = hard
    for i in range(1, n):
        boxed = page.boxes[i] - usual
        prosaic = page.article[page.parents[i]] and "form" not in boxed and prose[i] > links[i]
        if boxed and not holds[i] and not prosaic:
            out[i] = True
        out[i] = out[i] or out[page.parents[i]]
    return out


def _bodies(page: Page, out: list[bool], support: list[int], kept: list[int]) -> list[int]:
    """The blocks of the article elements that are one text, or of main; none where the page has neither.

    Of several places that have articles, the one with most text that the template does not
    have is taken, ties by all text; there, articles that are more links than text are not
    part of it. Main is taken where it has more text beside its articles than in them.
    """
    n = len(page.tags)
    size, fresh, links = [0] * n, [0] * n, [0] * n
    for b in kept:
        node, text = page.blocks[b]
        size[node] += len(text) - page.links[b]
        fresh[node] += 0 if support[b] else len(text) - page.links[b]
        links[node] += page.links[b]
    size, fresh, links = (_summed(page, x) for x in (size, fresh, links))
    nested = [False] * n
    for i in range(1, n):
        nested[i] = nested[page.parents[i]] or page.tags[page.parents[i]] == "article"
    groups: dict[int, list[int]] = {}
    for i in range(n):
        if page.tags[i] == "article" and not out[i] and not nested[i] and size[i] + links[i]:
            groups.setdefault(page.parents[i], []).append(i)
    score = lambda nodes: (sum(fresh[i] for i in nodes), sum(size[i] for i in nodes), -nodes[0])
    tops: list[int] = []
    if groups:
        tops = max(groups.values(), key=score)
        tops = [i for i in tops if size[i] > links[i]] or tops
    mains = [i for i in range(n) if page.tags[i] == "main" and not out[i] and size[i]]
    if mains:
        main = max(mains, key=lambda i: (size[i], -i))
        below = _below(page, main)
        held = sum(size[i] for nodes in groups.values() for i in nodes if below[i])
        if not tops or (below[tops[0]] and size[main] - held > held):
            tops = [main]
    if not tops:
        return []
    inside = [False] * n
    for i in range(n):
        inside[i] = i in tops or (i > 0 and inside[page.parents[i]])
    # Beside main's own text, an article of more links than text is another page's.
    if page.tags[tops[0]] == "main":
        others = {i for nodes in groups.values() for i in nodes if size[i] <= links[i]}
        for i in range(n):
            inside[i] = inside[i] and i not in others and (i in tops or inside[page.parents[i]])
    return [b for b in kept if inside[page.blocks[b][0]]]


def main_text(source: str, template: dict[int, int] = {}) -> str:  # noqa: B006
    """The article's blocks of a page joined by new lines; ``template`` has the keys of its host's template tokens and the pages each is on."""
    page = Page(source)
    out = _dropped(page)
    kept = [b for b, (node, _) in enumerate(page.blocks) if not out[node]]
    # A class is on all pages of its layout and on no other, so that a page's own tokens match it to its layout.
    support = [template.get(text_key(page.paths[node], text), 0) if template else 0 for node, text in page.blocks]
    if body := _bodies(page, out, support, kept):
        kept = body
    elif kept:
        kept = _between(page, kept, support)
    return "\n".join(page.blocks[b][1] for b in kept)


def _mix(page_key: int, count: int) -> int:
    """A 64-bit share of a token's occurrence vector, to be summed over pages."""
    x = (page_key ^ (count * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 31)) >> 24


def _occurrences(batches):
    """Sums for (host, token) over a task's pages: pages it is on, and its vector's hash."""
    sums: dict[tuple[str, int], list[int]] = {}

    def batch():
        keys = list(sums)
        made = pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array([sums[k][0] for k in keys], pa.int64()),
                pa.array([sums[k][1] for k in keys], pa.int64()),
            ],
            ["host", "token", "pages", "vector"],
        )
        sums.clear()
        return made

    for part in batches:
        for key, host, source in zip(*(part.column(i) for i in range(3))):
            key, host, counts = key.as_py(), host.as_py(), {}
            for token in Page(source.as_py() or "").tokens():
                counts[token] = counts.get(token, 0) + 1
            counts[0] = 1  # the page itself
            for token, n in counts.items():
                into = sums.setdefault((host, token), [0, 0])
                into[0] += 1
                into[1] += _mix(key & 0xFFFFFFFFFFFFFFFF, n)
        if len(sums) > 200_000:
            yield batch()
    if sums:
        yield batch()


def deduce_templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, template array<struct<pages, class>>) of hosts with a template.

    ``pages`` has host, key and html. Tokens whose occurrence vectors over the host's
    pages are equal form a class; vectors are compared by the sum of a hash of (page,
    count), so counts combine before they are shuffled, however many pages a host has.
    Classes of enough tokens on enough pages are valid, those of a layout that only some
    pages have too; each goes with its support, by which classes nest.
    """
    tokens = pages.select("key", "host", "html").mapInArrow(_occurrences, "host string, token long, pages long, vector long")
    tokens = tokens.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"))
    # Written, as the pages would be read twice for what follows.
    tokens = scratch.save(tokens.where((F.col("pages") > 1) | (F.col("token") == 0)), "tokens")
    # The page's own token tells how many pages a host has.
    hosts = tokens.where("token = 0").select("host", F.col("pages").alias("all_pages"))
    common = tokens.join(hosts, "host").where(
        (F.col("all_pages") > 1) & (F.col("pages") >= F.least(F.lit(MIN_PAGES), "all_pages")) & (F.col("pages") >= F.col("all_pages") * MIN_SHARE)
    )
    classes = common.groupBy("host", "all_pages", "pages", "vector").agg(F.collect_list("token").alias("class"))
    valid = classes.where((F.size("class") >= MIN_TOKENS) | (F.col("pages") == F.col("all_pages")))
    template = valid.groupBy("host").agg(F.collect_list(F.struct("pages", "class")).alias("template"))
    return template.where((F.size("template") > 1) | (F.size(F.col("template")[0]["class"]) > 1))


def _extract(batches):
    hosts: dict[str, dict[int, int]] = {}
    for part in batches:
        texts = []
        for source, host, template in zip(part.column("html"), part.column("host"), part.column("template")):
            host = host.as_py()
            if host not in hosts:
                if len(hosts) > 1000 or sum(map(len, hosts.values())) > 500_000:
                    hosts.clear()
                hosts[host] = {token: c["pages"] for c in (template.as_py() or ()) for token in c["class"]}
            texts.append(main_text(source.as_py() or "", hosts[host]))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"]
        )


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars of every page; text is the article alone, its blocks joined by new lines.

    Templates are deduced over all pages of each host. Markup names what is chrome
    (menus, headers, footers, sidebars, notices, adverts, forms, comments), but for boxes that hold most of a page's
    text and for prose within an article. Of the rest the article elements of one place count, that which
    has most text outside the template where there are several, or main; or else the smallest element around the
    text that varies. Template texts are left out before and after the article, never inside it. Templates reach the
    pages by a broadcast up to BROADCAST_TOKENS tokens and by a join on the host beyond.

    Pages are read in time and memory in proportion to their length, whatever tags they
    leave open; elements nested over DEPTH deep count as beside each other.
    Null or empty html: an empty text. Null url: the page is on a host of its own kind,
    read without template. Repeated rows are read each; other columns are ignored; an
    empty table gives an empty result.
    """
    spark = pages.sparkSession
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    keyed = rows.where(F.col("host") != "").select("host", "html", F.xxhash64("id", "url").alias("key"))
    scratch = Scratch(spark, "templates")
    templates = scratch.save(deduce_templates(keyed, scratch), "templates")
    scratch.drop("tokens")
    tokens = templates.agg(F.sum(F.aggregate("template", F.lit(0), lambda n, c: n + F.size(c["class"])))).first()[0] or 0
    small = tokens <= BROADCAST_TOKENS
    joined = rows.join(F.broadcast(templates) if small else templates, "host", "left").select("id", "url", "html", "host", "template")
    kind = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    done = joined.mapInArrow(_extract, f"id {kind[id_col]}, url {kind[url_col]}, text string, n_chars long")
    return done.withColumnsRenamed({"id": id_col, "url": url_col})
