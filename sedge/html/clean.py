"""Cleaning of pages and the choice of their main content, as one pruning walk over a tree.

Whether an element goes depends on itself and what it lies in alone, so all removal rules are one test,
and formulas are looked for from the outside in.  Where no rule of the page's own says what its content is,
the block that holds most of the text outside links is taken (``densest``).
"""

from __future__ import annotations

import base64
import binascii
import re
from dataclasses import dataclass, field
from html import escape, unescape

from .tree import Node, outermost, parse, pruned, select, selector

#: What never holds content.
NOISE_TAGS = frozenset(["script", "style", "link", "meta", "noscript", "iframe", "template", "object", "embed", "form", "button", "nav"])
CONTEXTUAL_TAGS, KEEPING_TAGS = frozenset(["header", "footer", "aside"]), frozenset(["article", "main"])
NOISE_SELECTORS = [".sf-hidden", "[role=navigation]", "[role=banner]", "[role=complementary]", "[role=contentinfo]", "[role=dialog]", "[aria-modal=true]", ".crp_related", ".yarpp-related", ".jp-relatedposts", "[hidden]"]
FORMULA_RENDERS = frozenset(["MathJax", "MathJax_Display", "MathJax_Preview", "MathJax_SVG", "MathJax_SVG_Display", "MathJax_CHTML"])
TEX = "application/x-tex"
URI_ATTRIBUTES = ("src", "srcset", "href", "poster", "data-src")
ANCHOR_SIGNS = frozenset(["#", "##", "¶", "§"])
SEMANTIC = ("article", "main", "[role=main]")
EXTENSIONS = {"image/png": "png", "image/jpeg": "jpg", "image/gif": "gif", "image/webp": "webp", "image/svg+xml": "svg", "image/avif": "avif"}
PAGE_TITLE, TITLE_CUT = re.compile(r"<title[^>]*>([^<]{1,300})</title>", re.I), re.compile(r"\s+[-–—|·»]\s+")
HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
FALLBACK = "precleaned"


@dataclass(frozen=True)
class Profile:
    """Rules of one site: pages that ``detect`` finds have their content in ``content``, less ``strip``."""

    name: str
    detect: str
    content: str
    strip: tuple[str, ...] = ()


@dataclass(frozen=True)
class Options:
    extra_remove_selectors: tuple[str, ...] = ()
    profiles: tuple[Profile, ...] = ()
    export_images: bool = True
    min_text_chars: int = 250
    min_text_ratio: float = 0.05
    max_data_uri_bytes: int = 4096
    base_url: str = ""
    complete_references: bool = False


@dataclass
class Cleaned:
    """A page's content, how it was found, its sizes, and the images that were taken out of it."""

    html: str
    strategy: str
    title: str
    text: str
    raw_bytes: int
    precleaned_bytes: int
    cleaned_bytes: int
    text_chars: int
    images: list[tuple[int, str, str, bytes]] = field(default_factory=list)


def object_key(value: str) -> str:
    """A document's key as part of an object's name."""
    return re.sub(r"[^A-Za-z0-9/_-]+", "_", value).strip("/_")


def data_uri(value: str) -> tuple[str, bytes] | None:
    """(type, bytes) of a base64 data URI, or None if it is none or is damaged."""
    head, _, body = value.partition(",")
    if not head.startswith("data:") or ";base64" not in head or not body:
        return None
    try:
        return head[5:].split(";")[0] or "application/octet-stream", base64.b64decode("".join(body.split()), validate=True)
    except (binascii.Error, ValueError):
        return None


def page_title(html: str) -> str:
    """The title without the site's name, which is its last part if it has several."""
    found = PAGE_TITLE.search(html)
    if not found:
        return ""
    parts = TITLE_CUT.split(unescape(found[1]).strip())
    return " ".join(parts[:-1]).strip() if len(parts) > 1 else parts[0]


# --- formulas -------------------------------------------------------------------------------------


def _tex(node: Node, spoken: bool = False) -> str:
    for n in node.walk():
        if n.tag == "annotation" and n.attrs.get("encoding") == TEX:
            return n.raw_text()
    return spoken and node.attrs.get("aria-label") or node.text(" ")


def formula(node: Node) -> tuple[str, bool] | None:
    """(LaTeX, displayed) of an element that stands for a formula."""
    if node.tag == "script" and re.match(r"\s*math/tex", node.attrs.get("type", ""), re.I):
        return node.raw_text(), "mode=display" in node.attrs["type"]
    classes = node.classes
    if "katex-display" in classes:
        inner = next((n for n in node.walk() if "katex" in n.classes), None)
        return (_tex(inner), True) if inner else None
    if "katex" in classes:
        return _tex(node), False
    if node.tag == "mjx-container":
        return _tex(node, spoken=True), node.attrs.get("display") == "true"
    if node.tag == "math":
        return _tex(node), node.attrs.get("display") == "block"
    return None


def with_formulas(top: Node) -> None:
    """Formulas become text, $inline$ or $$displayed$$; blank ones and drawn copies go."""
    pruned(top, lambda n: bool(FORMULA_RENDERS.intersection(n.classes)))
    open_ = [top]
    while open_:
        at, out = open_.pop(), []
        for c in at.children:
            told = formula(c) if isinstance(c, Node) else None
            if told is None:
                out.append(c)
                if isinstance(c, Node):
                    open_.append(c)
            elif told[0].strip():
                mark = "$$" if told[1] else "$"
                out.append(f"{mark}{told[0].strip()}{mark}")
        at.children = out


# --- cleaning -------------------------------------------------------------------------------------


def _noise(options: Options):
    tests = [selector(s) for s in [*NOISE_SELECTORS, *options.extra_remove_selectors]]

    def drop(node: Node) -> bool:
        if node.tag in NOISE_TAGS or any(t(node) for t in tests):
            return True
        if node.tag in CONTEXTUAL_TAGS and not any(a.tag in KEEPING_TAGS for a in node.ancestors()):
            return True
        style = node.attrs.get("style", "").replace(" ", "").lower()
        return "display:none" in style or "visibility:hidden" in style

    return drop


def _slim(top: Node, options: Options, doc_key: str) -> list[tuple[int, str, str, bytes]]:
    """Takes styles, handlers and inline data out of the attributes; returns the images that were taken."""
    images: list[tuple[int, str, str, bytes]] = []

    def small_icon(node: Node) -> bool:
        source = node.attrs.get("src", "")
        return node.tag == "img" and source.startswith("data:") and len(source) <= options.max_data_uri_bytes

    pruned(top, small_icon)
    for node in top.walk():
        node.attrs = {k: v for k, v in node.attrs.items() if k != "style" and not k.startswith("on")}
        for name in URI_ATTRIBUTES:
            value = node.attrs.get(name, "")
            if not value.startswith("data:") or len(value) <= options.max_data_uri_bytes:
                continue
            found = data_uri(value) if options.export_images and node.tag == "img" and name == "src" else None
            if found is None:
                del node.attrs[name]
                continue
            kind, payload = found
            key = f"images/html/{object_key(doc_key)}/img_{len(images):04d}.{EXTENSIONS.get(kind.lower(), 'bin')}"
            images.append((len(images), key, kind, payload))
            node.attrs[name] = options.base_url + key
    return images


def precleaned(raw: str, options: Options, doc_key: str = "") -> tuple[Node, list[tuple[int, str, str, bytes]]]:
    """The page's tree without what is no content, whatever strategy follows."""
    top = parse(raw, options.complete_references)
    with_formulas(top)
    pruned(top, _noise(options))
    images = _slim(top, options, doc_key)
    for heading in (n for n in top.walk() if n.tag in HEADINGS):
        heading.children = [c for c in heading.children if (c.strip() if isinstance(c, str) else c.text()) not in ANCHOR_SIGNS]
    return top, images


# --- main content ---------------------------------------------------------------------------------


def by_profile(top: Node, profile: Profile, least: int) -> list[Node] | None:
    if not select(top, profile.detect):
        return None
    nodes = outermost(select(top, profile.content))
    strip = [selector(s) for s in profile.strip]
    if sum(_length(n, strip) for n in nodes) < least:
        return None
    for n in nodes:
        pruned(n, lambda x: any(t(x) for t in strip))
    return nodes


def _length(node: Node, strip: list) -> int:
    """Characters of a node's text, less what is to be stripped."""
    gone = sum(len(n.text()) for n in outermost([n for n in node.walk() if any(t(n) for t in strip)])) if strip else 0
    return len(node.text()) - gone


def by_semantics(top: Node, least: int) -> tuple[str, list[Node]] | None:
    for name in SEMANTIC:
        nodes = outermost(select(top, name))
        if sum(len(n.text()) for n in nodes) >= least:
            return name, nodes
    return None


def densest(top: Node, share: float = 0.6) -> Node | None:
    """The innermost element that still holds ``share`` of the page's text outside links."""

    def weight(node: Node) -> int:
        links = sum(len(n.text()) for n in outermost([n for n in node.walk() if n.tag == "a"]))
        return len(node.text()) - links

    at = next((n for n in top.walk() if n.tag == "body"), top)
    whole = weight(at)
    if whole <= 0:
        return None
    while True:
        inner = max(((weight(c), -i, c) for i, c in enumerate(at.children) if isinstance(c, Node) and c.tag in ("div", "section", "td", "tr", "tbody", "table", "center")), default=None, key=lambda x: x[:2])
        if inner is None or inner[0] < share * whole:
            return None if at is top else at
        at = inner[2]


def clean(raw: str, options: Options = Options(), doc_key: str = "") -> Cleaned:
    """A page's main content: a profile's, else the author's own delimitation, else the densest block, else all."""
    top, images = precleaned(raw, options, doc_key)
    whole = top.html()
    title, reference = page_title(whole), len(top.text(" "))

    def told(html: str, strategy: str, text: str) -> Cleaned:
        size = lambda s: len(s.encode("utf-8", "surrogatepass"))
        return Cleaned(html, strategy, title, text, size(raw), size(whole), size(html), len(text), images)

    def fragment(nodes: list[Node], strategy: str) -> Cleaned:
        html, text = "\n".join(n.html() for n in nodes), " ".join(t for t in (n.text(" ") for n in nodes) if t)
        if title and not re.search(r"<h1[\s>]", html, re.I):
            html, text = f"<h1>{escape(title)}</h1>\n{html}", f"{title} {text}".strip()
        return told(html, strategy, text)

    for profile in options.profiles:
        nodes = by_profile(top, profile, options.min_text_chars)
        if nodes is not None:
            return fragment(nodes, profile.name)
    found = by_semantics(top, options.min_text_chars)
    block = densest(top)
    for name, nodes in [*([found] if found else []), *([("densest", [block])] if block else [])]:
        chars = len(" ".join(t for t in (n.text(" ") for n in nodes) if t))
        if chars >= options.min_text_chars and (reference == 0 or chars / reference >= options.min_text_ratio):
            return fragment(nodes, name)
    return told(whole, FALLBACK, top.text(" "))
