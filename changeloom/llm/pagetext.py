"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks, the leaf sequences of text between block-level tags. Each
block is a vector of its tag path (tags, classes and ids of all its ancestors,
hashed), of its words (hashed) and of a few counts. A bidirectional LSTM in
numpy reads the blocks of a whole page in both directions and labels each as main
text or not, so a block is judged by everything around it.

The labeller is trained here, on TRAIN_PAGES generated pages whose blocks are
labelled by construction; their running text is made of words of up to
WORD_PAGES rows of the table. Blocks inside elements that by definition hold no
article text (navigation, forms, asides, page footers and the like) are never main.

Scripts, styles, frames, text fields, drawings and templates are left out whole;
formulas, and what stands in for scripts and objects, are text like any other. A
drawing left open ends where the next element of the page begins or the one around
it ends; the tag of a template that is never closed is passed over.

Character references are decoded, white space inside a block becomes one blank,
blocks are joined by one line feed. A null or empty page, and a page without
main blocks, gives an empty text. Repeated rows are extracted one by one, pages of
any length whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.frames import RangeHash, blocks, text_of

PATHS, WORDS, NUMBERS = 512, 128, 6
PATH_SIZE, WORD_SIZE, HIDDEN = 24, 8, 16
TRAIN_PAGES, EPOCHS, BATCH, RATE = 1200, 8, 24, 0.02
WORD_PAGES, WORD_CHARS = 40, 20_000
# Blocks labelled at once, padding included.
CELLS = 1 << 14

# Elements by their role in a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre"
    " section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose text ends at their own end tag only; left open, they take the rest of the page.
RAW_TAGS = frozenset("script style iframe textarea title xmp".split())
# Elements that say nothing about the role of what they hold.
PLAIN_TAGS = frozenset("math noscript object".split())
# Start tags that end a drawing left open, and its parts that may hold them.
ENDS_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre"
    " ruby s small span strong strike sub sup table tt u ul var".split()
)
HOLDS_HTML = frozenset("foreignobject desc title".split())
NEVER_MAIN = frozenset("head nav aside form button select option optgroup menu dialog label legend fieldset footer".split())
CLOSES_P = BLOCK_TAGS - {"button", "label", "option", "legend", "caption"}
SAME_CLOSES = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>", re.S)
NAME_END, SPECIAL = re.compile(r"[\s/>]"), re.compile(r"[>\"']")
# Starts of tags that may come to nothing before a page counts as broken and its quotes are followed with care.
OPEN_TAGS = 8
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Za-z]+")


@cache
def path_bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % PATHS


@dataclass
class Block:
    """Text of a leaf sequence, different buckets of its tag path, its link letters, and whether it can be main."""

    text: str
    path: tuple[int, ...]
    linked: int
    never: bool
    tag: str


def element_tokens(tag: str, attributes: str) -> tuple[int, ...]:
    tokens = [tag]
    if "=" in attributes:
        for name, *values in NAMES.findall(attributes):
            mark = {"class": ".", "id": "."}.get(name.lower(), "~")
            tokens += [mark + part.lower() for part in PART.findall(next(filter(None, values), ""))]
    return tuple(path_bucket(t) for t in tokens)


class Tags:
    """The tags of a page, found in time in proportion to its length however broken it is.

    A start of a tag that never ends is text. Whether one ends depends on the next angle bracket
    outside quotes; quotes from which the page ends are remembered, as are the last
    distances looked ahead.
    """

    def __init__(self, page: str):
        self.page, self.last, self.open = page, page.rfind(">"), 0
        self.dead: set[int] = set()
        self.seen: dict[re.Pattern, tuple[int, int]] = {}

    def search(self, at: int) -> re.Match | None:
        """The first tag or comment from `at` on."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if at > self.last:
                # Only a comment may be left open to the end.
                at = page.find("<!--", at)
                return TAG.match(page, at) if at >= 0 else None
            if self.open < OPEN_TAGS or page.startswith(("<!", "<?"), at) or self.ends(at):
                if found := TAG.match(page, at):
                    return found
                self.open += 1
            at += 1
        return None

    def ahead(self, what: re.Pattern, at: int) -> int:
        """Where `what` comes next, the length of the page if nowhere."""
        start, stop = self.seen.get(what, (0, -1))
        if not start <= at <= stop:
            found = what.search(self.page, at)
            start, stop = self.seen[what] = at, found.start() if found else len(self.page)
        return stop

    def ends(self, at: int) -> bool:
        """Whether the tag that starts at `at` ends."""
        page, path = self.page, []
        at = self.ahead(NAME_END, at + 1 + page.startswith("/", at + 1))
        while True:
            stop = self.ahead(SPECIAL, at)
            if stop < len(page) and page[stop] == ">":
                return True
            close = page.find(page[stop], stop + 1) if stop < len(page) and stop not in self.dead else -1
            path.append(stop)
            if close < 0:
                self.dead.update(path)
                return False
            at = close + 1


def raw_end(page: str, tag: str, at: int) -> int:
    """Where the raw element `tag`, open at `at`, has ended."""
    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
    return page.find(">", end.end()) + 1 or len(page) if end else len(page)


def svg_end(page: str, tags: Tags, at: int, around: Counter[str]) -> int:
    """Where the drawing open at `at` has ended; `around` counts the open elements of the page."""
    inner, count = ["svg"], Counter(["svg"])
    while found := tags.search(at):
        tag = (found[2] or "").lower()
        if tag and found[1]:
            if count[tag]:
                while (last := inner.pop()) != tag:
                    count[last] -= 1
                count[tag] -= 1
                if not inner:
                    return found.end()
            elif around[tag] or tag in ("p", "br"):
                return found.start()
        elif tag:
            if tag in ENDS_SVG and not any(count[t] for t in HOLDS_HTML):
                return found.start()
            if not found[3].endswith("/") and not (tag in VOID_TAGS and any(count[t] for t in HOLDS_HTML)):
                inner.append(tag)
                count[tag] += 1
        at = found.end()
    return len(page)


def template_ends(page: str, tags: Tags, at: int) -> dict[int, int]:
    """End of every closed template from `at` on, by the end of its start tag."""
    ends: dict[int, int] = {}
    opened: list[int] = []
    while found := tags.search(at):
        at = found.end()
        tag = (found[2] or "").lower()
        if tag == "template" and found[1]:
            if opened:
                ends[opened.pop()] = at
        elif tag == "template":
            opened.append(at)
        elif tag in RAW_TAGS and not found[1] and not found[3].endswith("/"):
            at = raw_end(page, tag, at)
    return ends


def page_blocks(page: str) -> list[Block]:
    """The blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...], bool]] = []
    # What the stack holds, kept along: open elements by tag, path buckets, block-level tags, never-main elements.
    open_tags: Counter[str] = Counter()
    buckets: dict[int, int] = {}
    block_tags: list[str] = []
    nevers = 0
    templates: dict[int, int] | None = None
    parts: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, tuple(buckets), linked, nevers > 0, block_tags[-1] if block_tags else ""))
            parts.clear()
        linked = 0

    def push(tag: str, tokens: tuple[int, ...], never: bool) -> None:
        nonlocal nevers
        stack.append((tag, tokens, never))
        open_tags[tag] += 1
        nevers += never
        for k in tokens:
            buckets[k] = buckets.get(k, 0) + 1
        if tag in BLOCK_TAGS:
            block_tags.append(tag)

    def pop() -> str:
        nonlocal nevers
        tag, tokens, never = stack.pop()
        open_tags[tag] -= 1
        nevers -= never
        for k in tokens:
            buckets[k] -= 1
            if not buckets[k]:
                del buckets[k]
        if tag in BLOCK_TAGS:
            block_tags.pop()
        return tag

    def close(tag: str) -> None:
        if open_tags[tag]:
            while pop() != tag:
                pass

    n, tags = len(page), Tags(page)
    while at < n:
        found = tags.search(at)
        stop = found.start() if found else n
        if stop > at:
            parts.append(page[at:stop])
            if links:
                linked += stop - at
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag in BLOCK_TAGS:
                flush()
            if tag == "a":
                links = max(0, links - 1)
            close(tag)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in RAW_TAGS or tag in ("svg", "template"):
            if tag in BLOCK_TAGS:
                flush()
            if found[3].endswith("/"):
                continue
            if tag == "svg":
                at = svg_end(page, tags, at, open_tags)
            elif tag == "template":
                templates = template_ends(page, tags, found.start()) if templates is None else templates
                at = templates.get(at, at)
            else:
                at = raw_end(page, tag, at)
            continue
        if tag in BLOCK_TAGS:
            flush()
            if tag in CLOSES_P and open_tags["p"]:
                close("p")
                links = 0
        if tag in VOID_TAGS or found[3].endswith("/"):
            continue
        other = SAME_CLOSES.get(tag)
        if other and stack and stack[-1][0] in (tag, other):
            pop()
        if tag == "a":
            links += 1
        inside_article = open_tags["article"] or open_tags["main"]
        never = tag in NEVER_MAIN and not (tag in ("footer", "label") and inside_article) or tag == "header" and not inside_article
        push(tag, () if tag in PLAIN_TAGS else element_tokens(tag, found[3] or ""), never)
    flush()
    return out


def features(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Path counts, word counts and numbers of all blocks in a row."""
    flat = [b for p in pages for b in p]
    n = len(flat)
    sizes = np.array([len(b.path) for b in flat], np.int64)
    row = np.repeat(np.arange(n), sizes)
    path = np.bincount(row * PATHS + np.fromiter((k for b in flat for k in b.path), np.int64, int(sizes.sum())), minlength=n * PATHS)
    path = np.minimum(path.reshape(n, PATHS), 1).astype(np.float32)
    raw = [b.text.lower().encode() for b in flat]
    lengths = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    blank = data == 32
    ends = np.flatnonzero(blank)
    starts = np.concatenate([[0], ends[:-1] + 1])
    bounds = np.cumsum(lengths + 1)
    owner = np.searchsorted(bounds, ends, side="right")
    owner = np.minimum(owner, max(0, n - 1))
    if n:
        bucket = (RangeHash(data, 0).of(starts, ends) % np.uint64(WORDS)).astype(np.int64)
        word = np.bincount(owner * WORDS + bucket, minlength=n * WORDS).reshape(n, WORDS)
        counts = np.bincount(owner, minlength=n)
    else:
        word, counts = np.zeros((0, WORDS)), np.zeros(0)
    word = (word / np.maximum(counts, 1)[:, None] * 4).astype(np.float32)
    chars = np.array([len(b.text) for b in flat], float)
    place = np.concatenate([(np.arange(len(p)) + 0.5) / len(p) for p in pages if p]) if n else chars
    numbers = np.stack(
        [
            np.log1p(chars) / 4,
            np.log1p(counts) / 3,
            np.array([min(1.0, b.linked / max(1, len(b.text))) for b in flat]),
            np.array([b.text[-1] in ".!?…:;" for b in flat], float),
            place,
            np.ones(n),
        ],
        1,
    ).astype(np.float32) if n else np.zeros((0, NUMBERS), np.float32)
    return path, word, numbers


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + NUMBERS
        scale = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"path": scale(PATHS, PATH_SIZE) * 4, "word": scale(WORDS, WORD_SIZE), "out": scale(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
        for side in ("f", "b"):
            self.p[f"x{side}"] = scale(size, 4 * HIDDEN)
            self.p[f"h{side}"] = scale(HIDDEN, 4 * HIDDEN)
            self.p[f"c{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)

    def _embed(self, path, word, numbers):
        return np.concatenate([path @ self.p["path"], word @ self.p["word"], numbers], 1)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str):
        """Hidden states for (time, page, size) input, with what the backward pass needs."""
        steps, n, _ = x.shape
        pre = x @ self.p[f"x{side}"] + self.p[f"c{side}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        hidden, kept = np.zeros((steps, n, HIDDEN), np.float32), []
        order = range(steps) if side == "f" else range(steps - 1, -1, -1)
        for t in order:
            z = pre[t] + h @ self.p[f"h{side}"]
            gates = sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c_new = (f * c + i * g) * m
            tc = np.tanh(c_new)
            kept.append((t, i, f, o, g, c, h, tc, m))
            c, h = c_new, o * tc * m
            hidden[t] = h
        return hidden, kept

    def _padded(self, flat: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(lengths, default=0)
        x = np.zeros((steps, len(lengths), flat.shape[1]), np.float32)
        mask = np.zeros((steps, len(lengths)), np.float32)
        at = 0
        for k, n in enumerate(lengths):
            x[:n, k] = flat[at : at + n]
            mask[:n, k] = 1
            at += n
        return x, mask

    def chances(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probability of each block of each page to be main text."""
        lengths = [len(p) for p in pages]
        x, mask = self._padded(self._embed(*features(pages)), lengths)
        forward, _ = self._run(x, mask, "f")
        backward, _ = self._run(x, mask, "b")
        score = sigmoid(np.concatenate([forward, backward], 2) @ self.p["out"] + self.p["bias"])[:, :, 0]
        return [score[:n, k] for k, n in enumerate(lengths)]

    def learn(self, pages: list[list[Block]], labels: list[np.ndarray], moments: dict, step: int) -> float:
        """One Adam step on a batch; the loss."""
        lengths = [len(p) for p in pages]
        path, word, numbers = features(pages)
        x, mask = self._padded(self._embed(path, word, numbers), lengths)
        y, _ = self._padded(np.concatenate(labels)[:, None].astype(np.float32), lengths)
        states = {side: self._run(x, mask, side) for side in ("f", "b")}
        both = np.concatenate([states["f"][0], states["b"][0]], 2)
        score = sigmoid(both @ self.p["out"] + self.p["bias"])
        total = mask.sum()
        d_score = (score - y) * mask[:, :, None] / total
        grad = {"out": both.reshape(-1, 2 * HIDDEN).T @ d_score.reshape(-1, 1), "bias": d_score.sum((0, 1))}
        d_both = d_score @ self.p["out"].T
        d_x = np.zeros_like(x)
        for k, side in enumerate(("f", "b")):
            d_hidden = d_both[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            wx, wh = self.p[f"x{side}"], self.p[f"h{side}"]
            g_x, g_h, g_c = np.zeros_like(wx), np.zeros_like(wh), np.zeros(4 * HIDDEN, np.float32)
            d_h_next = np.zeros_like(d_hidden[0])
            d_c_next = np.zeros_like(d_h_next)
            for t, i, f, o, g, c_old, h_old, tc, m in reversed(states[side][1]):
                d_h = (d_hidden[t] + d_h_next) * m
                d_c = (d_h * o * (1 - tc * tc) + d_c_next) * m
                d_z = np.concatenate([d_c * g * i * (1 - i), d_c * c_old * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - g * g)], 1)
                g_x += x[t].T @ d_z
                g_h += h_old.T @ d_z
                g_c += d_z.sum(0)
                d_x[t] += d_z @ wx.T
                d_h_next = d_z @ wh.T
                d_c_next = d_c * f
            grad |= {f"x{side}": g_x, f"h{side}": g_h, f"c{side}": g_c}
        flat = np.concatenate([d_x[:n, k] for k, n in enumerate(lengths)])
        grad["path"] = path.T @ flat[:, :PATH_SIZE]
        grad["word"] = word.T @ flat[:, PATH_SIZE : PATH_SIZE + WORD_SIZE]
        for name, g in grad.items():
            m, v = moments.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            moments[name] = (m, v)
            self.p[name] = (self.p[name] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        chance = np.clip(score[:, :, 0], 1e-7, 1 - 1e-7)
        return float(-((y[:, :, 0] * np.log(chance) + (1 - y[:, :, 0]) * np.log(1 - chance)) * mask).sum() / total)


# Names that sites give to the parts of a page, and words usual in them.
PART_NAMES = {
    "nav": "nav menu navbar navigation breadcrumb topnav links sitemap".split(),
    "header": "header masthead topbar branding banner logo site-header".split(),
    "footer": "footer copyright legal bottom site-footer colophon".split(),
    "aside": "sidebar aside widget related recommended popular trending archive tags rail".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo adbox dfp banner-ad".split(),
    "notice": "cookie consent notice gdpr alert popup modal overlay privacy banner disclaimer".split(),
    "form": "form newsletter subscribe search login signup contact".split(),
    "comments": "comments comment reply discussion responses thread disqus feedback".split(),
    "share": "share social follow buttons meta byline".split(),
}
MAIN_NAMES = "content article post entry story main text body post-content entry-content article-body page".split()
PART_WORDS = {
    "nav": "home about contact news sports world archive help login products blog".split(),
    "header": "welcome to our site daily news home today".split(),
    "footer": "© copyright all rights reserved terms privacy imprint contact 2024".split(),
    "aside": "related popular most read more latest see also tags".split(),
    "ad": "advertisement sponsored buy now offer sale save".split(),
    "notice": "we use cookies to improve accept privacy policy continue agree".split(),
    "form": "subscribe email name search submit password sign up newsletter".split(),
    "comments": "reply posted by says likes ago comment report great thanks".split(),
    "share": "share tweet follow like print email facebook".split(),
}


def made_page(draw: random.Random, lexicon: list[str]) -> tuple[str, list[tuple[str, bool]]]:
    """A generated page and its texts with their labels, in order."""
    texts: list[tuple[str, bool]] = []
    serial = 0

    def sentence(low: int, high: int) -> str:
        words = [draw.choice(lexicon) for _ in range(draw.randint(low, high))]
        return " ".join(words).capitalize() + draw.choice([".", ".", ".", "", "!", "?"])

    def put(tag: str, text: str, main: bool, attributes: str = "") -> str:
        nonlocal serial
        serial += 1
        texts.append((" ".join(text.split()), main))
        inner = html.escape(text, quote=False)
        if main and draw.random() < 0.15:
            inner = f"<b>{inner}<br>" if tag == "p" and draw.random() < 0.3 else f"<b>{inner}</b>"
        end = "" if tag in ("p", "li") and draw.random() < 0.1 else f"</{tag}>"
        return f"<{tag}{attributes}>{inner}{end}"

    def named(kind: str) -> str:
        if draw.random() < 0.12:
            return f' class="{draw.choice("abcxyz")}{draw.randint(1, 99)}"'
        name = draw.choice(PART_NAMES[kind])
        return f' {draw.choice(["class", "class", "id"])}="{name}{draw.choice(["", "", "-box", " wrap", "_inner"])}"'

    def filler(kind: str, low: int, high: int) -> str:
        own = " ".join(draw.choice(PART_WORDS[kind]) for _ in range(draw.randint(1, 4)))
        return draw.choice([own, sentence(low, high), f"{own} {sentence(low, high)}"])

    def part(kind: str) -> str:
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, "div")
        if kind != "form" and draw.random() < 0.4:
            tag = draw.choice(["div", "section"])
        bare = tag in ("nav", "header", "footer", "aside", "form") and draw.random() < 0.6
        attributes = "" if bare else named(kind)
        body = ""
        if kind in ("nav", "share") or kind in ("aside", "footer") and draw.random() < 0.5:
            items = "".join(put("li", filler(kind, 1, 3), False).replace("<li>", '<li><a href="/x">').replace("</li>", "</a></li>") for _ in range(draw.randint(2, 8)))
            body = f"<ul>{items}</ul>"
        elif kind == "comments":
            for _ in range(draw.randint(1, 5)):
                body += f'<div class="{draw.choice(PART_NAMES[kind])}">' + put("span", filler(kind, 1, 3), False).replace("span", "p") + put("p", sentence(3, 40), False) + "</div>"
        elif kind == "form":
            body = put("label", filler(kind, 1, 3), False) + '<input type="text">' + put("button", filler(kind, 1, 2), False)
        elif draw.random() < 0.5:
            return f"<{tag}{attributes}>" + put("p", filler(kind, 2, 16), False) + f"</{tag}>"
        else:
            return put(tag, filler(kind, 2, 16), False, attributes)
        return f"<{tag}{attributes}>{body}</{tag}>"

    def article() -> str:
        wrap = draw.choice(["article", "article", "main", "div", "section"])
        attributes = f' class="{draw.choice(MAIN_NAMES)}"' if wrap in ("div", "section") or draw.random() < 0.3 else ""
        body = put(draw.choice(["h1", "h1", "h2"]), sentence(2, 12), True) if draw.random() < 0.9 else ""
        for _ in range(draw.choice([1, 2, 3, 5, 8, 12, 20])):
            kind = draw.random()
            if kind < 0.75:
                body += put("p", sentence(1, draw.choice([4, 30, 80])), True)
            elif kind < 0.83:
                body += put("h2", sentence(1, 8), True)
            elif kind < 0.9:
                body += "<ul>" + "".join(put("li", sentence(1, 20), True) for _ in range(draw.randint(1, 5))) + "</ul>"
            elif kind < 0.95:
                body += put("blockquote", sentence(5, 30), True)
            else:
                body += part(draw.choice(["ad", "share", "aside"]))
        return f"<{wrap}{attributes}>{body}</{wrap}>"

    before = [part(k) for k in ("notice", "header", "nav", "ad", "aside", "form") if draw.random() < (0.8 if k == "nav" else 0.35)]
    middle = article()
    after = [part(k) for k in ("share", "comments", "aside", "ad", "form", "notice", "footer") if draw.random() < (0.8 if k == "footer" else 0.3)]
    head = f"<head><title>{html.escape(sentence(2, 8))}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head>"
    end = "</body></html>" if draw.random() < 0.8 else ""
    return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}<!-- x -->{middle}{''.join(after)}{end}", texts


def training_set(lexicon: list[str], n: int, seed: int) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Generated pages as blocks, with a label per block; pages whose blocks don't line up are left out."""
    draw = random.Random(seed)
    pages, labels = [], []
    while len(pages) < n:
        page, texts = made_page(draw, lexicon)
        cut = page_blocks(page)
        said = [(t, m) for t, m in texts if t]
        if [b.text for b in cut] == [t for t, _ in said]:
            pages.append(cut)
            labels.append(np.array([m for _, m in said], float))
    return pages, labels


FILLER = "one two three four five six seven eight nine ten people city year water music house small large find make".split()


def train(lexicon: list[str], seed: int = 11) -> Labeller:
    """A labeller fitted to TRAIN_PAGES generated pages."""
    model, moments, step = Labeller(), {}, 0
    pages, labels = training_set(lexicon or FILLER, TRAIN_PAGES, seed)
    draw = random.Random(seed)
    for _ in range(EPOCHS):
        order = sorted(range(len(pages)), key=lambda i: (len(pages[i]) + draw.random() * 8))
        batches = [order[a : a + BATCH] for a in range(0, len(order), BATCH)]
        draw.shuffle(batches)
        for batch in batches:
            step += 1
            model.learn([pages[i] for i in batch], [labels[i] for i in batch], moments, step)
    return model


def lexicon_of(pages: DataFrame, column: str = "html") -> list[str]:
    """Words of the blocks of WORD_PAGES pages, for the text of generated pages.

    Of a page longer than WORD_CHARS a stretch of that length counts, from a hashed place on.
    """
    # Few rows are drawn and equal pages are one, so what reaches the driver does not grow with the table.
    every = max(1, pages.count() // (4 * WORD_PAGES))
    body = text_of(pages, column)
    start = 1 + F.pmod(F.xxhash64(body), F.greatest(F.length(body) - WORD_CHARS + 1, F.lit(1)))
    piece = F.substring(body, start.cast("int"), F.lit(WORD_CHARS)).alias("piece")
    drawn = pages.select(F.xxhash64(body).alias("drawn"), piece).where(F.pmod("drawn", F.lit(every)) == 0)
    rows = drawn.groupBy("drawn").agg(F.first("piece").alias("piece")).orderBy("drawn").limit(WORD_PAGES).select("piece").collect()
    return sorted({w for r in rows for b in page_blocks(r[0]) for w in b.text.split()})


def main_text(model: Labeller, pages: list[str]) -> list[str]:
    """Main text of every page."""
    cut = [page_blocks(p) for p in pages]
    turn = sorted(range(len(cut)), key=lambda i: len(cut[i]))
    out = [""] * len(cut)
    at = 0
    while at < len(turn):
        stop = at + 1
        while stop < len(turn) and (stop + 1 - at) * len(cut[turn[stop]]) <= CELLS:
            stop += 1
        some = [i for i in turn[at:stop] if cut[i]]
        for i, chance in zip(some, model.chances([cut[i] for i in some]), strict=True):
            out[i] = "\n".join(b.text for b, c in zip(cut[i], chance, strict=True) if c >= 0.5 and not b.never)
        at = stop
    return out


def extract(pages: DataFrame, key: str = "page_id", column: str = "html", model: Labeller | None = None) -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train(lexicon_of(pages, column)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(2).to_pylist()
            for a, b in blocks([len(s) for s in sources]):
                texts = main_text(shared.value, sources[a:b])
                columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([len(t) for t in texts], pa.int64())], ["key", "url", "text", "n_chars"])

    source = pages.select(F.col(key).alias("key"), F.col("url").cast("string").alias("url"), text_of(pages, column).alias("body"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, url string, text string, n_chars long").withColumnRenamed("key", key)
