"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks, runs of text between block-level tags, each with its ancestors' tags and class words and
some traits of its text and of all text that stands beside it in one container. The field scores each block as main text or not, and each pair of neighbours; it is trained by
gradient ascent on the likelihood of labelled pages, and decoded by Viterbi. Labelled pages come as (html, labels of the
leaf blocks); `labelled_pages` builds a training set of them from varied page skeletons, with invented words only and,
on a part of the pages, names that say nothing, so that the field learns structure rather than vocabulary. Scoring is a map over pages.

Defined results: a null page is an empty page and gives an empty text; pages without blocks give an empty text; what is
open at the end of a page is closed there, a tag or comment that is cut off is dropped, a cut-off character reference is
text; repeated rows give repeated results; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(script|style|noscript|template|svg|iframe)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S | re.I)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CAMEL = re.compile(r"([a-z])([A-Z])")
# Elements of HTML by how they break text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What stands inside a container of text rather than being one.
LEAFY = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th blockquote pre figure figcaption header hr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


@dataclass
class Block:
    text: str
    features: list[str]


def _words_of(attrs: str) -> tuple[str, ...]:
    out = []
    for a, b, c in _NAMES.findall(attrs):
        out += re.split(r"[^a-z0-9]+", _CAMEL.sub(r"\1 \2", a or b or c).lower())
    return tuple(w for w in dict.fromkeys(out) if w)


def leaf_blocks(page: str) -> list[Block]:
    """Blocks of visible text in page order."""
    out: list[Block] = []
    # Open elements: tag, the features of it and all above it, and the number of the container that its text stands in.
    stack: list[tuple[str, frozenset[str], int]] = []
    parts: list[str] = []
    linked = at = opened = 0
    anchor = False
    inside: list[int] = []
    mass: dict[int, int] = {}

    def put() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text and not (stack and "a:head" in stack[-1][1]):
            share = min(linked / len(text), 1)
            out.append(Block(text, _features(text, share, stack)))
            inside.append(stack[-1][2] if stack else 0)
            mass[inside[-1]] = mass.get(inside[-1], 0) + int((text.count(" ") + 1) * (1 - share))
        linked = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            if anchor:
                linked += m.start() - at
        at = m.end()
        name = m[3]
        if name is None:
            if m[1]:
                parts.append(" ")
            continue
        name = name.lower()
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                anchor = not m[2]
            continue
        put()
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] in ("div", "article", "section", "td", "li", "body"):
                    break
        elif name in ("li", "td", "th", "tr", "dt", "dd", "option") or name == "body":
            same = {"body": ("head",), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(name, (name,))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in same:
                    del stack[k:]
                    break
                if stack[k][0] in ("ul", "ol", "table", "dl", "select"):
                    break
        if name not in VOID:
            above, container = stack[-1][1:] if stack else (frozenset(), 0)
            new = {f"a:{name}", *(f"c:{w}" for w in (_words_of(m[4]) if "=" in m[4] else ()))}
            opened += 1
            stack.append((name, above if new <= above else above | new, container if name in LEAFY else opened))
    if at < len(page):
        parts.append(page[at:])
    put()
    most = max(mass.values(), default=0)
    titled = {k for b, k in zip(out, inside, strict=True) if "a:h1" in b.features}
    for b, k in zip(out, inside, strict=True):
        b.features.append(f"m:{min(mass[k].bit_length(), 9)}")
        if mass[k] == most:
            b.features.append("most")
        if k in titled:
            b.features.append("titled")
    return out


def _features(text: str, link_share: float, stack: list[tuple[str, frozenset[str], int]]) -> list[str]:
    out = sorted(stack[-1][1]) if stack else []
    out.append(f"t:{stack[-1][0] if stack else ''}")
    if len(stack) > 1:
        out.append(f"pp:{stack[-2][0]}")
    out.append(f"n:{min((text.count(' ') + 1).bit_length(), 7)}")
    out.append(f"l:{int(link_share * 4)}")
    out.append(f"e:{text[-1] in '.!?…:\"”'}")
    if "©" in text[:3]:
        out.append("copyright")
    return out


class Field:
    """Two labels, 0 other and 1 main; weights by feature, between neighbours, and at the start."""

    def __init__(self, weights: dict[str, float], bias: float, trans: np.ndarray, start: np.ndarray):
        self.weights, self.bias, self.trans, self.start = weights, bias, trans, start

    def decode(self, blocks: list[Block]) -> list[int]:
        """Viterbi: the best labelling as a whole."""
        w, (t00, t01, t10, t11) = self.weights, self.trans.ravel().tolist()
        s0, s1 = float(self.start[0]), float(self.start[1])
        back = []
        for k, b in enumerate(blocks):
            e = self.bias
            for f in b.features:
                e += w.get(f, 0.0)
            if k:
                from0, from1 = s0 + t00 >= s1 + t10, s0 + t01 >= s1 + t11
                back.append((0 if from0 else 1, 0 if from1 else 1))
                s0, s1 = max(s0 + t00, s1 + t10), max(s0 + t01, s1 + t11) + e
            else:
                s1 += e
        if not blocks:
            return []
        y = [int(s1 > s0)]
        for b in reversed(back):
            y.append(b[y[-1]])
        return y[::-1]


def train(pages: list[tuple[str, list[int]]], *, rounds: int = 150, rate: float = 0.15, decay: float = 1e-3, support: int = 1) -> Field:
    """Maximum likelihood by Adam, forward and backward over all pages at once; `decay` is a Gaussian prior. Features of
    fewer than `support` pages get no weight."""
    seqs = [(b, y) for b, y in ((leaf_blocks(p), y) for p, y in pages) if b]
    for b, y in seqs:
        if len(b) != len(y):
            raise ValueError(f"{len(y)} labels for {len(b)} blocks")
    names: dict[str, int] = {}
    held = Counter(f for b, _ in seqs for f in {f for x in b for f in x.features})
    longest = max(len(b) for b, _ in seqs)
    rows, cols = [], []
    y = np.full((len(seqs), longest), -1)
    for i, (b, lab) in enumerate(seqs):
        y[i, : len(b)] = lab
        for k, x in enumerate(b):
            for f in x.features:
                if held[f] >= support:
                    rows.append(i * longest + k)
                    cols.append(names.setdefault(f, len(names)))
    rows, cols = np.array(rows), np.array(cols)
    real = y >= 0
    theta = np.zeros(len(names) + 7)  # features, bias, transitions, start
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n, k = len(seqs), len(names)
    last = real.sum(1) - 1
    for step in range(1, rounds + 1):
        e = np.zeros((n, longest, 2))
        e[..., 1] = (np.bincount(rows, theta[cols], n * longest).reshape(n, longest) + theta[k]) * real
        tr, st = theta[k + 1 : k + 5].reshape(2, 2), theta[k + 5 :]
        a = np.zeros((n, longest, 2))
        a[:, 0] = st + e[:, 0]
        for t in range(1, longest):
            a[:, t] = np.logaddexp(a[:, t - 1, :1] + tr[0], a[:, t - 1, 1:] + tr[1]) + e[:, t]
        b = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            nxt = b[:, t + 1] + e[:, t + 1]
            new = np.stack([np.logaddexp(tr[s, 0] + nxt[:, 0], tr[s, 1] + nxt[:, 1]) for s in (0, 1)], 1)
            b[:, t] = np.where((t < last)[:, None], new, 0)
        z = np.logaddexp(a[np.arange(n), last, 0], a[np.arange(n), last, 1])
        p1 = np.exp(a[..., 1] + b[..., 1] - z[:, None]) * real
        grad = np.zeros_like(theta)
        diff = ((y == 1) - p1) * real
        grad[:k] = np.bincount(cols, diff.ravel()[rows], k)
        grad[k] = diff.sum()
        both = real[:, 1:]
        for s in (0, 1):
            for u in (0, 1):
                p = np.exp(a[:, :-1, s] + tr[s, u] + e[:, 1:, u] + b[:, 1:, u] - z[:, None]) * both
                grad[k + 1 + 2 * s + u] = ((y[:, :-1] == s) & (y[:, 1:] == u) & both).sum() - p.sum()
        p0 = np.exp(a[:, 0] + b[:, 0] - z[:, None])
        grad[k + 5 :] = [(y[:, 0] == s).sum() - p0[:, s].sum() for s in (0, 1)]
        grad = grad / n - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field({f: float(theta[j]) for f, j in names.items()}, float(theta[k]), theta[k + 1 : k + 5].reshape(2, 2), theta[k + 5 :])


# Names that page parts go by, for the training pages.
OTHER_NAMES = "nav navbar navigation menu topbar header masthead footer bottom copyright legal sidebar aside widget related recommended popular trending ad ads advert advertisement banner sponsor sponsored promo cookie cookies consent notice alert popup modal overlay subscribe newsletter signup login search form comments comment discussion replies reply respond responses reactions reader readers feedback opinions reviews disqus share social sharing follow breadcrumbs breadcrumb pagination pager tags links toolbar skip".split()
MAIN_NAMES = "article content post entry story main body text page blog news single hentry maintext articlebody".split()


def labelled_pages(seed: int = 7, n: int = 1200) -> list[tuple[str, list[int]]]:
    """Pages of varied skeletons with their labels."""
    rng = np.random.default_rng(seed)
    syllables = [c + v for c in "b c d f g k l m n p r s t v z st tr ch".split() for v in "a e i o u ou en".split()]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chance = lambda p: rng.random() < p

    def words(lo: int, hi: int, stop: bool = True) -> str:
        w = ["".join(pick(syllables) for _ in range(int(rng.integers(1, 4)))) for _ in range(int(rng.integers(lo, hi + 1)))]
        return " ".join(w).capitalize() + ("." if stop else "")

    opaque = False

    def named(names: list[str]) -> str:
        if opaque or chance(0.05):
            return pick([f' class="{pick("abcdeghkmqrsuxz")}{int(rng.integers(1, 100))}"', f' id="{pick(syllables)}{pick(syllables)}"', ""])
        x = pick(names)
        return pick([f' class="{x}"', f' id="{x}"', f' class="{x}-{pick(["box", "wrap", "area", "list", "section"])}"', f' class="{pick(["col", "x1", "left", "wide"])} {x}"'])

    out = []
    for _ in range(n):
        bits: list[str] = []
        labels: list[int] = []
        opaque = chance(0.2)

        def leaf(html: str, label: int, bits=bits, labels=labels) -> None:
            bits.append(html)
            labels.append(label)

        def links(tag: str, bits=bits, leaf=leaf) -> None:
            bits.append("<ul>" if tag == "li" else "")
            for _ in range(int(rng.integers(1, 6))):
                leaf(f'<{tag}><a href="/x">{words(1, 3, chance(0.3))}</a></{tag}>', 0)
            bits.append("</ul>" if tag == "li" else "")

        def other(inside: bool, bits=bits, leaf=leaf, links=links) -> None:
            kind = int(rng.integers(6))
            if kind == 0:
                tag = pick(["nav", "header", "footer", "aside"])
                bits.append(f"<{tag}{named(OTHER_NAMES) if chance(0.5) else ''}>")
                if tag == "header" and chance(0.15):  # the site's name
                    leaf(f"<h1>{words(1, 3, False)}</h1>", 0)
                links("li") if chance(0.6) else leaf(f"<{pick(['p', 'div'])}>{words(2, 30)}", 0)
                bits.append(f"</{tag}>")
            elif kind == 1:
                leaf(f"<div{named(OTHER_NAMES)}>{words(1, 25, chance(0.6))}</div>", 0)
            elif kind == 2:
                bits.append(f"<div{named(OTHER_NAMES)}>")
                if chance(0.5):
                    leaf(f"<h3>{words(1, 4, False)}</h3>", 0)
                for _ in range(int(rng.integers(1, 4))):
                    leaf(f"<p>{words(2, 60)}</p>", 0)
                bits.append("</div>")
            elif kind == 3:
                bits.append("<form>")
                leaf(f"<p><label>{words(1, 8, False)}</label></p>", 0)
                leaf(f"<button>{words(1, 3, False)}</button>", 0)
                bits.append("</form>")
            elif kind == 4:
                bits.append(f"<{pick(['section', 'div', 'ol'])}{named(['comments', 'comment', 'discussion', 'replies', 'respond', 'reactions', 'reader', 'responses', 'feedback'])}>")
                if chance(0.5):
                    leaf(f"<h2>{words(1, 3, False)}</h2>", 0)
                for _ in range(int(rng.integers(1, 5))):
                    leaf(f"<{pick(['p', 'li', 'div'])}>{words(3, 60)}", 0)
                bits.append("</section></div></ol>" if not inside else "</section></ol></div>")
            else:
                bits.append(f"<{pick(['aside', 'nav'])}>")
                links("p")
                bits.append("</aside></nav>")

        def main(bits=bits, leaf=leaf, opaque=opaque) -> None:
            headed = chance(0.2)
            bits.append("<header>" if headed else "")
            if chance(0.85):
                leaf(f"<h1>{words(1, 12, chance(0.4))}</h1>", 1)
            bits.append("</header>" if headed else "")
            if not opaque and chance(0.12):  # an article of a few words
                for _ in range(int(rng.integers(1, 3))):
                    leaf(f"<p>{words(1, 4)}</p>" if chance(0.5) else f"<p><b>{words(1, 4, chance(0.5))}<br>", 1)
                return
            for _ in range(int(rng.integers(1, 10))):
                kind = int(rng.integers(12))
                if kind == 10:
                    leaf(f"<figure><img src=x><figcaption>{words(2, 14)}</figcaption></figure>", 1)
                elif kind == 11:
                    for _ in range(int(rng.integers(1, 4))):
                        leaf(f"<table><tr><td>{words(1, 6, chance(0.3))}</td></tr></table>", 1)
                elif kind < 6:
                    leaf(f"<p>{words(1, 90)}</p>" if chance(0.7) else f"<p><b>{words(2, 60)}<br>", 1)
                elif kind == 6:
                    leaf(f"<h2>{words(1, 8, False)}</h2>", 1)
                elif kind == 7:
                    bits.append(pick(["<ul>", "<ol>"]))
                    for _ in range(int(rng.integers(1, 5))):
                        leaf(f"<li>{words(1, 15, chance(0.5))}</li>", 1)
                    bits.append("</ul></ol>")
                elif kind == 8:
                    leaf(f"<{pick(['blockquote', 'pre', 'div'])}>{words(2, 40)}", 1)
                    bits.append("</blockquote></pre></div>")
                else:
                    leaf(f"<p>{words(1, 20)} <a href='/y'>{words(1, 3, False)}</a> {words(1, 20)}</p>", 1)
                if chance(0.25):
                    tag = pick(["aside", "div", "section"])
                    leaf(f"<{tag}{named(['ad', 'ads', 'ad', 'advert', 'advertisement', 'banner', 'sponsor', 'promo', 'share', 'related', 'newsletter', 'notice', 'comments', 'form', 'cookie', 'menu', 'sidebar'])}>{words(1, 12)}</{tag}>", 0)

        bits.append(f"<html><head><title>{words(1, 8, False)}</title></head><body>")
        for _ in range(int(rng.integers(0, 4))):
            other(False)
        tag = pick(["article", "article", "article", "main", "div", "section", "div"])
        name = named(MAIN_NAMES) if tag in ("div", "section") or chance(0.4) else ""
        wrap = chance(0.3)
        bits.append(("<main>" if wrap else "") + f"<{tag}{name}>")
        main()
        bits.append(f"</{tag}>" + ("</main>" if wrap else ""))
        for _ in range(int(rng.integers(0, 4))):
            other(False)
        if chance(0.7):
            leaf(f"<footer>{pick(['&copy; ', ''])}{words(1, 14)}</footer>", 0)
        bits.append("</body></html>")
        page = "".join(bits)
        if len(leaf_blocks(page)) == len(labels):
            out.append((page, labels))
    return out


@lru_cache(maxsize=1)
def default_field() -> Field:
    """The field trained on `labelled_pages()`; the same in every process."""
    return train(labelled_pages(), support=8)


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page or "")
    return "\n".join(b.text for b, y in zip(blocks, field.decode(blocks), strict=True) if y)


def extract(pages: DataFrame, field: Field | None = None, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per page: page_id, url, text, n_chars."""
    field = field or default_field()

    def run(batches):
        for b in batches:
            texts = [main_text(x.as_py(), field) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
