"""Main text of web pages by minimum cut.

A page becomes a row of text blocks. A logistic classifier of the blocks' own text (link share, length, end, element) is
fitted on blocks of known side: those under article or main, and those under nav, footer, aside and the like, of a bounded
sample of the pages (sample_pages rows of at most sample_chars characters; classes weigh the same). Its log-odds, with those
of the landmarks and names of the blocks' ancestors, become capacities to the two terminals. Blocks next to each other, and
the blocks of one parent, are joined by smoothness edges, stronger the closer they stand in the tree and scaled to the
spread of the fitted log-odds. The minimum cut is the labelling of least total cost; the blocks on the content side are the
main text. A block whose own costs differ by more than all its edges together keeps its cheaper label in some minimum cut,
so such blocks are fixed first; what stays undecided falls into separate groups, and a flow is computed in each.

A class, id or role speaks of the element that it names: it never counts on html, body, main or article, and has-sidebar or
no-menu aren't a sidebar or a menu. Null or empty html gives the empty string and 0. Broken markup is read as far as it
goes: unclosed elements end with their parents, a tag that the page breaks off in is left out. Pages are read in one pass,
whatever their tags. Nothing is capped. Repeated rows get equal results, null ids and urls pass through, empty tables give
empty results. Without blocks of both sides in the sample the weights are DEFAULT.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without text of the page.
SILENT = set("script style noscript template title textarea select svg iframe object canvas audio video math button".split())
#: Of these, elements that may close themselves.
FOREIGN = {"svg", "math"}
NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
#: From behind a tag's name to its end. Quotes count only where a value begins.
REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+>")
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Log-odds of content for text under a landmark; a name of either kind on an element likewise.
TAGS = {"nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0, "header": -9.0, "head": -20.0, "fieldset": -9.0, "article": 4.5, "main": 4.0}
NAMED_AGAINST, NAMED_FOR = -9.0, 2.0
AGAINST = re.compile(r"(?:^|[_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|comments?|disqus|respond|sidebar|nav\w*|menu|footer|masthead|breadcrumbs?|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|share|social|related|recommend\w*|widget|login|signup|search|pagination|pager|copyright|contentinfo|complementary)(?:$|[_-])", re.I)
FOR = re.compile(r"(?:^|[_-])(?:article|content|entry|post|story|main|body|text)(?:$|[_-])", re.I)
ABOUT_OTHERS = re.compile(r"(?:has|with|no|not|without|is|hide|show|before|after)[_-]", re.I)
WHOLE_PAGE = {"html", "body", "main", "article"}
NAMED = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACES = re.compile(r"\s+")
#: Weights of features(): bias, link share, words (of 40), an end of a sentence, and the element: p, li, heading, cell, other.
DEFAULT = np.array([-0.5, -5.0, 2.0, 0.5, 0.5, 0.0, 0.8, 0.0, 0.0])
KINDS = {"p": 4, "li": 5, "dd": 5, "dt": 5, **{f"h{k}": 6 for k in range(1, 7)}, "td": 7, "th": 7}
LANDMARKS = {"nav": 0, "footer": 0, "aside": 0, "form": 0, "menu": 0, "article": 1, "main": 1}


class Block:
    """A text block: prior (log-odds of all above it), side (0, 1 or None: that of its landmarks), features of its text."""

    __slots__ = ("depth", "features", "parent", "path", "prior", "side", "text")

    def __init__(self, text, prior, side, features, path):
        self.text, self.prior, self.side, self.features, self.path = text, prior, side, features, path
        self.parent, self.depth = path[-1] if path else 0, len(path)


def features(text: str, linked: int, tag: str) -> list[float]:
    x = [1.0, min(1.0, linked / max(1, len(text))), min(text.count(" ") + 1, 40) / 40, float(text[-1] in ".!?…:;\"”"), 0.0, 0.0, 0.0, 0.0, 0.0]
    x[KINDS.get(tag, 8)] = 1.0
    return x


def tokens(page: str):
    """(start, end, name, is an end tag, attributes) of the tags, in order; name "" for comments and the like. An element of
    SILENT is one token with all that is in it. One pass: no place of the page is searched twice for the same thing."""
    at, last = 0, page.rfind(">")
    while True:
        at = page.find("<", at)
        if at < 0:
            return
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield at, end, "", False, ""
            at = end
            continue
        m = NAME.match(page, at + 1)
        if not m:
            if page[at + 1 : at + 2] in ("!", "?") and last > at:
                end = page.index(">", at) + 1
                yield at, end, "", False, ""
                at = end
            else:
                at += 1
            continue
        rest = REST.match(page, m.end()) if last > at else None
        if not rest:  # the page ends inside the tag
            yield at, len(page), "", False, ""
            return
        name, end = m[2].lower(), rest.end()
        attrs = page[m.end() : end - 1]
        if name in SILENT and not m[1] and not (name in FOREIGN and attrs.endswith("/")):
            close = re.compile(rf"</{name}(?![a-z0-9:-])", re.I).search(page, end)
            gt = page.find(">", close.end()) if close else -1
            end = gt + 1 if gt >= 0 else len(page)
            yield at, end, "", False, ""
        else:
            yield at, end, "" if name in SILENT else name, bool(m[1]), attrs
        at = end


def named(tag: str, attrs: str) -> float:
    """Log-odds that an element's class, id and role say of it."""
    if tag in WHOLE_PAGE or "=" not in attrs:
        return 0.0
    words = [w for found in NAMED.findall(attrs) for w in "".join(found).split() if not ABOUT_OTHERS.match(w)]
    return NAMED_AGAINST * any(map(AGAINST.search, words)) + NAMED_FOR * any(map(FOR.search, words))


def blocks(page: str) -> list[Block]:
    """Text blocks in page order."""
    found: list[Block] = []
    stack: list[tuple[str, int]] = []  # element and its number
    prior: list[float] = [0.0]  # log-odds with all above
    sides: list[int | None] = [None]
    parts: list[str] = []
    linked = number = links = at = 0

    def close():
        nonlocal linked
        if parts:
            text = SPACES.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                found.append(Block(text, prior[-1], sides[-1], features(text, linked, stack[-1][0] if stack else ""), tuple(x[1] for x in stack)))
            parts.clear()
        linked = 0

    def leave(depth):
        del stack[depth:], prior[depth + 1 :], sides[depth + 1 :]

    for start, end, tag, is_end, attrs in tokens(page):
        if start > at:
            parts.append(page[at:start])
            linked += (start - at) * links
        at = end
        if not tag:
            continue
        if tag == "a":
            links = 0 if is_end else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCK:
            continue
        close()
        links = 0
        if is_end:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if k is not None:
                leave(k)
            continue
        if stack and (stack[-1][0] == "p" or (tag in ("li", "td", "th", "tr", "dd", "dt") and stack[-1][0] == tag)):  # any block ends a paragraph
            leave(len(stack) - 1)
        if tag in VOID or attrs.endswith("/"):
            continue
        odds = TAGS.get(tag, 0.0) + named(tag, attrs)
        if tag == "header" and any(x[0] == "article" for x in stack):
            odds -= TAGS["header"]  # an article's own heading
        number += 1
        stack.append((tag, number))
        prior.append(prior[-1] + odds)
        sides.append(0 if odds < -4 else LANDMARKS.get(tag, sides[-1]) if sides[-1] != 0 else 0)
    if at < len(page):
        parts.append(page[at:])
        linked += (len(page) - at) * links
    close()
    return found


def fit(pages: list[str], rounds: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights of features() by Newton steps on the blocks of known side; each side weighs the same. DEFAULT without both."""
    known = [b for page in pages for b in blocks(page) if b.side is not None]
    y = np.array([b.side for b in known], float)
    if not len(y) or y.min() == y.max():
        return DEFAULT
    x = np.array([b.features for b in known])
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * w
        w = w + np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
    return w


def odds_of(found: list[Block], weights: np.ndarray, most: float = 4.0) -> list[float]:
    """Log-odds of each block: those of its text, no more than most either way, and its prior."""
    return (np.clip(np.array([b.features for b in found]) @ weights, -most, most) + np.array([b.prior for b in found])).tolist()


#: Weight of the edge between two neighbours of one parent: half the log-odds that a text alone can have.
NEAR = 2.0


def edges(found: list[Block], near: float = NEAR) -> list[tuple[int, int, float]]:
    """Adjacent blocks and blocks of one parent; the weight falls with the distance in the tree."""
    out, last = [], {}
    for i, b in enumerate(found):
        before = last.get(b.parent)
        if before is not None and before != i - 1:
            out.append((before, i, near / 2))
        if i:
            a = found[i - 1]
            shared = 0
            for x, y in zip(a.path, b.path, strict=False):
                if x != y:
                    break
                shared += 1
            out.append((i - 1, i, near / (1 + (a.depth + b.depth - 2 * shared) / 2)))
        last[b.parent] = i
    return out


def cut(odds: list[float], joined: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the content side of a minimum cut. Capacities are rounded to thousandths."""
    n = len(odds)
    # cost of calling a node boilerplate less that of calling it content is its log-odds: softplus(z) - softplus(-z) = z
    own = [round(1000 * max(-30.0, min(30.0, z))) for z in odds]
    around: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, w in joined:
        c = round(1000 * w)
        around[i][j] = around[i].get(j, 0) + c
        around[j][i] = around[j].get(i, 0) + c
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # what no smoothness can turn
        i = todo.popleft()
        if label[i] is None and abs(own[i]) > sum(around[i].values()):
            label[i] = own[i] > 0
            for j, c in around[i].items():
                own[j] += c if label[i] else -c
                del around[j][i]
                todo.append(j)
            around[i] = {}
    for i in range(n):
        if label[i] is None:
            rest, todo = {i}, deque([i])
            while todo:  # the undecided blocks that hang together
                for j in around[todo.popleft()]:
                    if j not in rest:
                        rest.add(j)
                        todo.append(j)
            side = _source_side(sorted(rest), own, around)
            for j in rest:
                label[j] = j in side
    return label


def _source_side(rest: list[int], own: list[int], around: list[dict[int, int]]) -> set[int]:
    """Nodes reached from the source once shortest augmenting paths have filled a cut."""
    supply = {i: max(0, own[i]) for i in rest}
    drain = {i: max(0, -own[i]) for i in rest}
    left = {i: dict(around[i]) for i in rest}
    while True:
        came: dict[int, int | None] = {i: None for i in rest if supply[i] > 0}
        todo = deque(came)
        end = None
        while todo:
            i = todo.popleft()
            if drain[i] > 0:
                end = i
                break
            for j, c in left[i].items():
                if c > 0 and j not in came:
                    came[j] = i
                    todo.append(j)
        if end is None:
            return set(came)
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        flow = min([supply[path[-1]], drain[end], *(left[b][a] for a, b in zip(path, path[1:], strict=False))])
        supply[path[-1]] -= flow
        drain[end] -= flow
        for a, b in zip(path, path[1:], strict=False):
            left[b][a] -= flow
            left[a][b] = left[a].get(b, 0) + flow


def main_text(page: str | None, weights: np.ndarray = DEFAULT) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    keep = cut(odds_of(found, weights), edges(found))
    return "\n\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame, sample_pages: int = 200, sample_chars: int = 1 << 18) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    weights = fit([r["html"] for r in pages.select("html").filter(F.length("html") <= sample_chars).take(sample_pages)])

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = [main_text(x, weights) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
