"""Leaf text blocks of an HTML page with what stands above them, and labelled pages to learn from."""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Collection
from dataclasses import dataclass

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]{2,}")

_list = frozenset
VOID = _list("area base br col embed hr img input link meta param source track wbr".split())
RAW = _list("script style textarea".split())  # skipped up to their end tag, or the page's end without one, as in browsers
HIDDEN = _list("template noscript svg iframe".split())  # skipped while open; like any element they end with their parent
INLINE = _list(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr br area math object".split()
) | HIDDEN
# A start tag of the first closes an open one of the second, unless one of the third stands between.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


@dataclass
class Block:
    path: tuple[str, ...]
    tag: str
    text: str
    linked: float


def blocks(page: str, known: Collection[str] | None = None) -> list[Block]:
    """Text blocks in page order. A block ends at each tag that is not inline; its white space is single
    spaces. path has the tags and the words of class, id and role above it, those in ``known`` if given."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    depth: Counter = Counter()
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                inner = next((tag for tag, _ in reversed(stack) if tag not in INLINE), "")
                out.append(Block(stack[-1][1] if stack else (), inner, text, min(1.0, linked / len(text))))
            parts.clear()
            linked = 0

    def data(raw: str) -> None:
        nonlocal linked
        if hidden():
            return
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if depth["a"]:
            linked += len(" ".join(text.split()))

    def hidden() -> bool:
        return any(depth[tag] for tag in HIDDEN)

    def inline(tag: str) -> bool:
        return tag in INLINE or bool(depth["math"]) or hidden()

    def pop(place: int) -> None:
        for tag, _ in stack[place:]:
            depth[tag] -= 1
        del stack[place:]

    def close(tags: Collection[str], until: Collection[str]) -> None:
        for place in range(len(stack) - 1, -1, -1):
            if stack[place][0] in tags:
                return pop(place)
            if stack[place][0] in until:
                return

    at = 0
    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            data(page[at:])
            break
        if found.start() > at:
            data(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if tag is None:
            if found[0].startswith("<![CDATA["):
                data(found[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if found["close"]:
            if not inline(tag):
                flush()
            if depth[tag]:
                pop(max(i for i in range(len(stack)) if stack[i][0] == tag) if len(stack) < 50 else _last(stack, tag))
            continue
        if tag in RAW and not found["rest"].endswith("/"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            parts.append(" ")
            continue
        if tag == "br" or tag in HIDDEN:
            parts.append(" ")
        if not inline(tag):
            flush()
            if depth["p"]:
                close({"p"}, {"table", "div", "section", "article", "body"})
            if tag in _CLOSES and any(depth[t] for t in _CLOSES[tag][0]):
                close(*_CLOSES[tag])
        if tag in VOID or found["rest"].endswith("/"):
            continue
        path = stack[-1][1] if stack else ()
        fresh = [] if depth[tag] else [f"in:{tag}"]
        rest = found["rest"]
        if "=" in rest:
            words = _PARTS.findall(" ".join("".join(m) for m in _NAMES.findall(rest)).lower())
            fresh += [f"name:{w}" for w in words]
        fresh = [f for f in fresh if f not in path and (known is None or f in known)]
        stack.append((tag, path + tuple(dict.fromkeys(fresh)) if fresh else path))
        depth[tag] += 1
    flush()
    return out


def _last(stack: list, tag: str) -> int:
    return next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)


def text_features(block: Block) -> list[str]:
    """Features of a block's own text and element."""
    words = block.text.count(" ") + 1
    size = next(n for n in (2, 5, 10, 20, 40, 1 << 62) if words <= n)
    link = "none" if not block.linked else "part" if block.linked < 0.5 else "most"
    end = "stop" if block.text[-1] in ".!?…:;\"'”»)" else "open"
    out = [f"words:{size}", f"link:{link}", f"end:{end}", f"tag:{block.tag}", f"size:{size}:{link}"]
    if "," in block.text:
        out.append("comma")
    if "©" in block.text or "·" in block.text:
        out.append("mark")
    if sum(map(str.isdigit, block.text)) * 5 > len(block.text):
        out.append("digits")
    return out


# --- labelled pages

_MAIN = ""
_SYLLABLES = "al be ci do en fa gri hu in jo ka lun me no or pe qui ra sol ti um ve wen xi yo zan éc öl ña".split()


class Maker:
    """Writes pages of many layouts; a private character marks the words of the article."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def one(self, text: str) -> str:
        return self.random.choice(text.split())

    def words(self, low: int, high: int, mark: str = "") -> str:
        r = self.random
        made = [mark + "".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high))]
        return " ".join(w + ("," if r.random() < 0.08 else "") for w in made)

    def prose(self, mark: str = "", low: int = 1, high: int = 5) -> str:
        odd = self.random.random()
        if odd < 0.06:
            return " | ".join(self.words(1, 2, mark) for _ in range(self.random.randint(3, 12 * high))) + " |" * self.random.randint(0, 1)
        if odd < 0.1:
            return " ".join(w + self.random.choice(["***", "%%%", "", " 17", "!!"]) for w in self.words(2, 8 * high, mark).split())
        return " ".join(self.words(1, 24, mark).capitalize() + self.random.choice("....!?") for _ in range(self.random.randint(low, high)))

    def links(self, low: int = 2, high: int = 8) -> str:
        r, item = self.random, self.one("li li div p span")
        body = "".join(f'<{item}><a href="/{n}">{self.words(1, 4)}</a></{item}>' for n in range(r.randint(low, high)))
        return f"<ul>{body}</ul>" if item == "li" else body

    def wrapped(self, tags: str, names: str, body: str) -> str:
        tag = self.one(tags)
        plain = tag in ("nav", "aside", "header", "footer", "form") and self.random.random() < 0.5
        name = "" if plain else f' {self.one("class class id")}="{self.one(names)}"'
        return f"<{tag}{name}>{body}</{tag}>"

    def noise(self, kind: str) -> str:
        r = self.random
        if kind == "menu":
            return self.wrapped("nav nav div ul", "menu nav navbar navigation breadcrumb breadcrumbs main-nav topnav", self.links())
        if kind == "header":
            title = self.one("h1 h2 div p a span")
            more = self.links(1, 4) if r.random() < 0.4 else f"<p>{self.words(2, 8)}</p>" * r.randint(0, 1)
            return self.wrapped("header header div", "header masthead site-header top-bar branding banner", f"<{title}>{self.words(1, 5)}</{title}>{more}")
        if kind == "footer":
            body = r.choice([f"&copy; {self.words(1, 3)}", f"<p>&copy; 2020 {self.words(1, 6)} &middot; {self.prose(high=2)}</p>", self.links(), f"<p>{self.prose(high=2)}</p>"])
            return self.wrapped("footer footer div", "footer site-footer copyright bottom colophon", body + (self.links(1, 4) if r.random() < 0.3 else ""))
        if kind == "sidebar":
            body = f"<h3>{self.words(1, 4)}</h3>" * r.randint(0, 1) + r.choice([self.links(), f"<p>{self.prose()}</p>"])
            return self.wrapped("aside aside div section", "sidebar related widget side-bar recommended more-stories trending share social tags", body)
        if kind == "notice":
            return self.wrapped("div div section dialog aside", "cookie cookies notice consent gdpr alert banner cookie-banner notification popup modal newsletter", f"<p>{self.prose(high=2)}</p>" + f"<button>{self.words(1, 2)}</button>" * r.randint(0, 2))
        if kind == "advert":
            body = r.choice([self.prose(high=2), f"<p>{self.prose(high=3)}</p>", f'<a href="/x">{self.words(2, 9)}</a>'])
            return self.wrapped("div div aside section ins", "ad ads advert advertisement sponsored promo ad-slot banner-ad sponsor promotion", body)
        if kind == "form":
            field = f"<label>{self.words(1, 3)}</label><input name=q>"
            return self.wrapped("form", "search login subscribe signup contact", f"<p>{self.prose(high=2)}</p>" * r.randint(0, 1) + field * r.randint(1, 3) + f"<button>{self.words(1, 2)}</button><select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select>")
        said = "".join(
            self.wrapped("div li article p", "comment reply comment-body response", f"<b>{self.words(1, 2)}</b> <span>{r.randint(1, 28)}/3</span><p>{self.prose()}</p>")
            for _ in range(r.randint(1, 5))
        )
        return self.wrapped("div section ol", "comments comment-list replies discussion responses disqus reader-comments", f"<h3>{self.words(1, 3)}</h3>" * r.randint(0, 1) + said)

    def article(self) -> str:
        r, m = self.random, _MAIN
        parts = [f"<h1>{self.words(3, 12, m)}</h1>"] * (r.random() < 0.8)
        for _ in range(r.randint(1, 12)):
            kind = r.random()
            text = self.prose(m, 1, 8)
            if kind < 0.6:
                parts.append(r.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<p>{}<br>" + self.prose(m)]).format(text))
            elif kind < 0.68:
                parts.append(f"<h2>{self.words(1, 7, m)}</h2>")
            elif kind < 0.75:
                parts.append("<ul>" + "".join(f"<li>{self.words(1, 15, m)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.82:
                parts.append(f"<{'blockquote'}><p>{text}</p></blockquote>" if r.random() < 0.6 else f"<pre>{text}</pre>")
            elif kind < 0.88:
                parts.append("<table>" + "".join(f"<tr><td>{self.words(1, 4, m)}<td>{self.words(1, 4, m)}" for _ in range(r.randint(1, 4))) + "</table>")
            else:
                parts.append(f"<p>{self.words(1, 9, m)}.</p>")
            if r.random() < 0.08:
                parts.append(self.noise(self.one("advert advert sidebar form notice")))
            if r.random() < 0.05:
                parts.append("<script>var a = '<p>x</p>';</script>")
        names = "content post entry article article-body story main-content entry-content post-body text body-text"
        tag = self.one("article article article main main div div section td")
        if tag in ("article", "main") and r.random() < 0.6:
            out = f"<{tag}>{''.join(parts)}</{tag}>"
        else:
            out = self.wrapped(tag, names, "".join(parts))
        if tag == "td":
            out = f"<table><tr><td>{self.links()}</td>{out}</table>"
        return out if r.random() < 0.6 else self.wrapped("div main", "page wrapper container main site", out)

    def page(self) -> str:
        r = self.random
        kinds = "menu header sidebar notice advert form".split()
        before = [self.noise(k) for k in r.sample(kinds, r.randint(0, 5))]
        after = [self.noise(k) for k in r.sample(kinds + ["comment"] * 3, r.randint(0, 4))]
        foot = [self.noise("footer")] if r.random() < 0.8 else []
        head = f"<head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style></head>"
        body = "".join([*before, self.article(), *after, *foot])
        if r.random() < 0.3:
            body = self.wrapped("div", "page wrapper container site", body)
        return f"<!DOCTYPE html><html>{head}<body>{body}</body></html>"


def labelled_pages(count: int, seed: int = 0) -> list[tuple[list[Block], list[int]]]:
    """Blocks of ``count`` made pages, and for each block 1 if it is the article's."""
    maker, out = Maker(seed), []
    for _ in range(count):
        found = blocks(maker.page())
        labels = [int(_MAIN in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(_MAIN, "")
        out.append((found, labels))
    return out
