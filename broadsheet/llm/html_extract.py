"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements with its runs of text as leaves. Every node is content or not: an element is when
main text lies in it. Potentials tie a node to its own features and to its parent; messages passed up and down the tree give
each leaf's marginal probability. The potentials are counts from labelled pages on top of prior counts; the class, id and role
words of any site are features, so that a site with names of its own is learned from its labelled pages.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.rows import as_bytes, shared, slices

MAX_PAGES = 2000  # labelled pages that the potentials are counted on, at the utmost
PRIOR = 40.0  # what one entry of the prior is worth in nodes
LEAST_PAGES = 3  # labelled pages with a name that is on no list, for the name to count
SMOOTH = 1.0  # pages that speak neither for nor against such a name
CLEAR = 5e-5  # share of main text among elements named as something else
#: Odds that one feature may add or take. Features of one node go together, so that each alone must not decide.
LIMITS = {"words": (-0.7, 0.7), "end": (-0.5, 0.5), "noend": (-0.5, 0.5), "nosign": (-0.2, 0.2), "sign": (-5.0, 0.0), "links": (-2.5, 0.5), "tag": (-0.7, 0.7), "plain": (-1.0, 1.0)}
THRESHOLD = 0.5
MOST_STAYS = 0.75  # of the children of a content element
PLAIN = 0.73  # share of main text in text, and in elements made for running text, before any page

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body title div p article section main nav header footer aside ul ol li menu table caption thead tbody tfoot tr td th h1 h2 h3 "
    "h4 h5 h6 form fieldset legend figure figcaption blockquote pre dl dt dd address details summary dialog button select option label "
    "textarea iframe noscript template center hgroup search audio video canvas svg object".split()
)
CLOSES_P = BLOCK - {"button", "label", "option", "html", "head", "body", "title"}
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "body": ({"head", "title"}, {"html"}),
}

# Prior knowledge, worth a few labelled pages: names that sites give to what is not, or is, the main text.
BOILER_TAGS = frozenset("nav header footer aside form menu dialog button select option label textarea iframe title head fieldset search template noscript".split())
CONTENT_TAGS = frozenset("article main".split())
WHOLE_TAGS = frozenset("html body".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement adbox banner sponsor sponsored promo promotion nav navbar navigation menu sidebar side aside footer "
    "header masthead cookie cookies consent gdpr notice alert popup modal overlay comment comments reply replies discussion disqus respond "
    "share sharing social related recommended breadcrumb breadcrumbs newsletter subscribe signup login widget toolbar pager pagination tags "
    "copyright legal disclaimer search form contentinfo complementary hidden toc metadata byline".split()
)
CONTENT_NAMES = frozenset("article content post entry main story body text prose".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style)\b(?:[^>"']++|"[^"]*"|'[^']*'|["'])*+>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)>|<[!?/][^>]*+>|<(?:/|[a-zA-Z!])[^>]*+\Z""",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "parent", "names", "hidden", "parts", "linked", "chars", "text")

    def __init__(self, tag: str, parent: int, attributes: str = ""):
        self.tag, self.parent = tag, parent
        self.names: frozenset[str] = frozenset()
        if attributes:
            found = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes))
            self.names = frozenset(w.lower() for w in _WORD.findall(found))
        self.hidden = bool(attributes and _HIDDEN.search(attributes))
        self.parts: list[str] = []
        self.linked = self.chars = 0
        self.text = ""


def tree_of(page: str) -> list[Node]:
    """Nodes in page order, parents before children; text leaves have the tag ``#`` and their text with single blanks.

    Elements left open end where HTML lets them end; stray end tags are passed over; markup inside a word does not cut it.
    """
    nodes = [Node("html", -1)]
    stack, leaf, links, at = [0], None, 0, 0

    def put(raw: str) -> None:
        nonlocal leaf
        if not raw or nodes[stack[-1]].tag in ("head", "title"):  # not shown on the page
            return
        if leaf is None:
            if raw.isspace():
                return
            leaf = Node("#", stack[-1])
            nodes.append(leaf)
        text = entities.unescape(raw)
        leaf.parts.append(text)
        leaf.chars += len(text)
        leaf.linked += len(text) if links else 0

    for m in _TAG.finditer(page):
        put(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag == "a":
            links = 0 if m[2] else 1
        elif tag in ("br", "hr", "img"):
            put(" ") if leaf is not None else None
        if tag not in BLOCK or (tag == "html" and not m[2]):
            continue
        links, leaf = 0, None
        if m[2]:
            if tag in (nodes[i].tag for i in stack[1:]):
                while nodes[stack.pop()].tag != tag:
                    pass
            continue
        if tag in CLOSES_P and nodes[stack[-1]].tag == "p":
            stack.pop()
        ends, until = ENDS.get(tag, (frozenset(), frozenset()))
        for depth in range(len(stack) - 1, 0, -1):
            if nodes[stack[depth]].tag in until:
                break
            if nodes[stack[depth]].tag in ends:
                del stack[depth:]
        nodes.append(Node(tag, stack[-1], m[4]))
        if not m[4].endswith("/") or tag in ("p", "div"):
            stack.append(len(nodes) - 1)
    put(page[at:])
    for node in nodes:
        if node.parts:
            node.text = " ".join("".join(node.parts).split())
            node.parts = []
    return nodes


def features(node: Node) -> list[str]:
    """What the node looks like by itself."""
    if node.tag == "#":
        words = node.text.count(" ") + 1 if node.text else 0
        share = node.linked / node.chars if node.chars else 0
        return [
            f"words{min(words.bit_length(), 7)}",
            f"links{0 if share < 0.05 else 1 if share < 0.6 else 2}",
            "end" if node.text[-1:] in ".!?…:\"'»”" else "noend",
            "sign" if "©" in node.text[:40] else "nosign",
            "plain:#",
        ]
    out = [f"tag:{node.tag}"] + [f"name:{w}" for w in sorted(node.names) if not w.isdigit()]
    out += ["plain:p"] if node.tag in TEXT_TAGS else []
    return out + ["hidden"] if node.hidden else out


def prior_counts() -> Counter:
    """Counts of ``(kind, key, label)`` before any page: features of a node, and the label of a child under its parent's."""
    out: Counter = Counter()
    for tag in BLOCK:
        share, worth = (CLEAR, PRIOR) if tag in BOILER_TAGS else (0.9, PRIOR) if tag in CONTENT_TAGS else (0.5, PRIOR)
        if tag in WHOLE_TAGS:  # a page has a main text
            share, worth = 1 - CLEAR, PRIOR
        out["f", f"tag:{tag}", 1], out["f", f"tag:{tag}", 0] = worth * share, worth * (1 - share)
    for name in BOILER_NAMES | CONTENT_NAMES:
        share, worth = (CLEAR, PRIOR) if name in BOILER_NAMES else (0.8, PRIOR)
        out["f", f"name:{name}", 1], out["f", f"name:{name}", 0] = worth * share, worth * (1 - share)
    out["f", "hidden", 1], out["f", "hidden", 0] = PRIOR * CLEAR, PRIOR
    for k, share in zip(range(8), (0.4, 0.4, 0.5, 0.6, 0.65, 0.7, 0.75, 0.8), strict=True):
        out["f", f"words{k}", 1], out["f", f"words{k}", 0] = 2 * share, 2 * (1 - share)
    for key, share in (("links0", 0.6), ("links1", 0.4), ("links2", 0.1), ("end", 0.6), ("noend", 0.4), ("nosign", 0.5), ("sign", 0.05)):
        out["f", key, 1], out["f", key, 0] = 4 * share, 4 * (1 - share)
    for key in ("plain:#", "plain:p"):
        out["f", key, 1], out["f", key, 0] = PRIOR * PLAIN, PRIOR * (1 - PLAIN)
    out["t", "1", 1], out["t", "1", 0] = 0.8 * PRIOR, 0.2 * PRIOR
    out["t", "0", 1], out["t", "0", 0] = 0.002 * PRIOR, PRIOR
    return out


@dataclass
class Potentials:
    """Log odds of content by feature, and the table ``edge[parent label, child label]``."""

    odds: dict[str, float]
    edge: np.ndarray

    @classmethod
    def of(cls, counts: Counter) -> Potentials:
        keys = {key for kind, key, _ in counts if kind == "f"}
        odds = {}
        for k in keys:
            smooth = SMOOTH / 2 if _unlisted(k) else 0.05
            z = float(np.log((counts["f", k, 1] + smooth) / (counts["f", k, 0] + smooth)))
            kind = re.match(r"[a-z]+", k)[0]
            known = k.removeprefix("tag:") in BOILER_TAGS | CONTENT_TAGS | WHOLE_TAGS
            odds[k] = z if known else float(np.clip(z, *LIMITS.get(kind, (-12.0, 12.0))))
        edge = np.array([[counts["t", p, 0] + 0.01, counts["t", p, 1] + 0.01] for p in ("0", "1")])
        edge /= edge.sum(axis=1, keepdims=True)
        # An element of main text may have many other things beside it, which must not speak against it.
        stays = float(np.clip(edge[1, 1], 0.5, MOST_STAYS))
        return cls(odds, np.array([edge[0], [1 - stays, stays]]))

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content of every node, by one pass of messages up the tree and one down."""
        e00, e01, e10, e11 = self.edge.ravel().tolist()
        local = []
        for node in nodes:
            z = sum(self.odds.get(f, 0.0) for f in features(node))
            p = 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))
            local.append((1 - p, p))
        up0, up1 = [x[0] for x in local], [x[1] for x in local]
        messages: list = [None] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            a, b = e00 * up0[i] + e01 * up1[i], e10 * up0[i] + e11 * up1[i]
            messages[i] = a, b
            parent = nodes[i].parent
            up0[parent] *= a
            up1[parent] *= b
            scale = up0[parent] + up1[parent]
            if scale < 1e-150:
                up0[parent], up1[parent] = up0[parent] / scale, up1[parent] / scale
        out = [0.0] * len(nodes)
        belief: list = [None] * len(nodes)
        belief[0] = up0[0] / (up0[0] + up1[0]), up1[0] / (up0[0] + up1[0])
        out[0] = belief[0][1]
        for i in range(1, len(nodes)):
            a, b = messages[i]
            p0, p1 = belief[nodes[i].parent]
            p0, p1 = p0 / max(a, 1e-300), p1 / max(b, 1e-300)  # what the parent knows without this child
            b0, b1 = up0[i] * (p0 * e00 + p1 * e10), up1[i] * (p0 * e01 + p1 * e11)
            belief[i] = b0 / (b0 + b1), b1 / (b0 + b1)
            out[i] = belief[i][1]
        return out

    def extract(self, page: str) -> str:
        nodes = tree_of(page)
        marginals = self.marginals(nodes)
        return " ".join(n.text for n, p in zip(nodes, marginals, strict=True) if n.tag == "#" and n.text and p >= THRESHOLD)


def _unlisted(key: str) -> bool:
    return key.startswith("name:") and key[5:] not in BOILER_NAMES | CONTENT_NAMES


def label_counts(page: str, truth: str) -> Counter:
    """Counts from one labelled page: a leaf is content when it is a line of the true text or how that text begins.

    A name counts once a page and label, since the elements of one page that share it say the same thing.
    """
    nodes = tree_of(page)
    lines = {" ".join(x.split()) for x in truth.split("\n")}
    start = " ".join(truth.split())
    labels = [0] * len(nodes)
    for i, node in enumerate(nodes):
        if node.tag == "#" and node.text and (node.text in lines or (len(node.text) >= 20 and start.startswith(node.text))):
            labels[i] = 1
    for i in range(len(nodes) - 1, 0, -1):
        labels[nodes[i].parent] |= labels[i]
    out: Counter = Counter()
    if not labels[0]:
        return out  # the text is not of this page
    names = set()
    for i, node in enumerate(nodes):
        found = [("f", f, labels[i]) for f in features(node)]
        names.update(f for f in found if f[1].startswith("name:"))
        out.update(f for f in found if not f[1].startswith("name:"))
        if i:
            out["t", str(labels[node.parent]), labels[i]] += 1
    out.update(names)
    return out


def learned(found: dict[tuple[str, str, int], int]) -> Potentials:
    """Potentials from the prior and the counts of labelled pages; names of fewer than ``LEAST_PAGES`` that are on no list are left out."""
    counts = prior_counts()
    for (kind, key, label), n in found.items():
        if kind == "t" or not _unlisted(key) or sum(found.get((kind, key, y), 0) for y in (0, 1)) >= LEAST_PAGES:
            counts[kind, key, label] += n
    return Potentials.of(counts)


def sampled_truths(numbers: DataFrame, docs: DataFrame, most: int = MAX_PAGES) -> DataFrame:
    """``(page_id, truth)`` for at most ``most`` of the ``(page_id, doc_id)`` rows, those of the smallest hashes, so that only
    these documents' texts are moved."""
    some = numbers.where("page_id IS NOT NULL AND doc_id IS NOT NULL").orderBy(F.xxhash64("page_id"), "page_id").limit(most)
    return docs.select("doc_id", F.col("text").alias("truth")).join(F.broadcast(some), "doc_id").select("page_id", "truth")


def train(pages: DataFrame, truths: DataFrame, most: int = MAX_PAGES) -> Potentials:
    """Potentials from pages whose main text is known: ``truths(page_id, truth)`` has at most ``most`` of them used.

    The pages of the smallest hashes are taken; their ids are broadcast. Without labelled pages the prior decides.
    """
    ids = truths.where("truth IS NOT NULL AND page_id IS NOT NULL").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(most)
    known = truths.join(F.broadcast(ids), "page_id").join(pages.select("page_id", "html").join(F.broadcast(ids), "page_id"), "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for piece in slices(batches, 64):
            for page, truth in zip(as_bytes(piece.column(0)), as_bytes(piece.column(1)), strict=True):
                total.update(label_counts(page.decode("utf-8", "replace"), truth.decode("utf-8", "replace")))
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
        rows = [[k[0] for k in total], [k[1] for k in total], [k[2] for k in total], list(total.values())]
        yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=["kind", "key", "label", "n"])

    counted = known.select("html", "truth").mapInArrow(run, "kind string, key string, label int, n bigint").groupBy("kind", "key", "label").agg(F.sum("n").alias("n"))
    return learned({(r.kind, r.key, r.label): r.n for r in counted.collect()})  # no more rows than the sampled pages have features


def extract_text(pages: DataFrame, potentials: Potentials) -> DataFrame:
    """``(page_id, url, text)``: the main text of every page, blocks in page order joined by a blank.

    Null, empty and text-free pages give an empty text. Character references are decoded; white space inside a block is one
    blank. Pages of any length are read whole; repeated rows are extracted each.
    """
    get = shared(pages.sparkSession, potentials)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = get().extract
        for piece in slices(batches, 256):
            texts = [extract(x.decode("utf-8", "replace")) for x in as_bytes(piece.column(2))]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string")
