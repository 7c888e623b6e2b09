"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A page is cut into blocks of text, each with its ancestors' tags and the words of their class and id attributes. Features of a block
are its tag and ancestors (also from a short list of what attribute words mean), its length, punctuation, link share, capitals and
place. The field has two labels, main text and the rest, weights for features by label and for label pairs; it is trained by
gradient ascent on the likelihood (forward-backward sums) of labelled pages and decodes a page by the Viterbi path.

Labelled pages are a bounded sample of the table's own pages whose mark-up says what is what (an article or main element, and
nav, aside, footer, form or telling class words outside or inside it), with a set of page patterns that vary structure.
The sample (500 pages of least key hash, the first 100 blocks of each, by default) only fits the weights; every page is decoded.
"""

import html
import re
from collections import defaultdict
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import query
from rowloom.llm.common import text_chunks

TRAINING_PAGES = 500
TRAINING_BLOCKS = 100
STEPS = 80
PENALTY = 1e-3

_BLOCK = frozenset("p div article section main header footer nav aside ul ol li dl dt dd table thead tbody tfoot tr td th h1 h2 h3 h4 h5 h6 blockquote pre form fieldset figure figcaption address hr body html head title details summary dialog menu center caption legend option select noscript".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style template noscript textarea select option button svg math iframe object head title".split())
_NEVER = frozenset(("nav", "aside", "dialog"))
_CLOSES_P = _BLOCK - {"html", "body", "head", "title", "option", "select", "legend", "caption"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_KEEPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
# What words in class and id attributes (and some tags and roles) say about a part of a page.
_MEANS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc skip",
    "head": "header masthead banner topbar logo branding",
    "foot": "footer copyright legal colophon bottom",
    "side": "sidebar aside side rail widget widgets related recommended recommendations trending popular more",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted",
    "note": "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe signup paywall disclaimer",
    "talk": "comment comments commentlist reply replies respond discussion disqus reviews review feedback responses",
    "form": "form search login signin register input",
    "share": "share sharing social follow tags byline meta author date",
    "body": "article content main post entry story text body prose articlebody",
}
_MEANING = {w: m for m, words in _MEANS.items() for w in words.split()}
_OFF = frozenset(("menu", "head", "foot", "side", "ad", "note", "talk", "form"))
_TAG_MEANS = {"nav": "menu", "header": "head", "footer": "foot", "aside": "side", "form": "form", "article": "body", "main": "body", "dialog": "note", "menu": "menu"}
# An attribute's value is quoted only after an equals sign. No part of a token is read twice: groups are possessive, and a tag that
# never closes runs to the end of the page, as in browsers.
_INSIDE = r"(?:[^=>]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)?+)*+"
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(script|style|textarea|title|template|noscript|iframe|xmp)(?=[\s/>]){_INSIDE}>(.*?)(?:</\1(?=[\s/>]|\Z)[^>]*+(?:>|\Z)|\Z)"
    rf"|<svg(?=[\s/>]){_INSIDE}(?<!/)>.*?(?:</svg[^>]*+(?:>|\Z)|\Z)"
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_INSIDE})(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden|aria-label)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


@lru_cache(maxsize=20_000)
def _meanings(tag: str, attributes: str) -> frozenset:
    """What a tag and its attributes say, with "hidden" for parts that are not shown."""
    out = {_TAG_MEANS[tag]} if tag in _TAG_MEANS else set()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value)) or (name == "aria-hidden" and value.lower() == "true"):
            out.add("hidden")
        elif name in ("class", "id", "role"):
            for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
                if w in _MEANING:
                    out.add(_MEANING[w])
                elif w in ("contentinfo", "complementary"):
                    out.add("foot" if w == "contentinfo" else "side")
    return frozenset(out)


class _Open(NamedTuple):
    """An open element with what its blocks inherit."""

    tag: str
    tags: frozenset  # of it and all around it
    means: frozenset
    near: frozenset  # meanings nearest to it
    block: int  # depth of the innermost block element, -1 for none
    shown: bool


_ROOT = _Open("", frozenset(), frozenset(), frozenset(), -1, True)


def blocks(page: str) -> list[tuple[str, str, frozenset, frozenset, frozenset, int]]:
    """(text, tag, ancestor tags, meanings, meanings nearest to the block, characters in links) of the page's leaf blocks.

    Text that is not shown (buttons, scripts, hidden parts), alone or amid a block, is left out. A header inside an article or main element is part of it and counts as a plain division. The time grows with the page's
    length: an element keeps what its blocks inherit, and the places of every open tag are known.
    """
    out, stack, words, linked = [], [], [], 0
    places = defaultdict(list)

    def end_block():
        nonlocal words, linked
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                top = stack[-1] if stack else _ROOT
                tag = stack[top.block].tag if top.block >= 0 else "body"
                out.append((text, tag, top.tags, top.means, top.near, linked))
            words, linked = [], 0

    def close(n):
        while len(stack) > n:
            places[stack.pop().tag].pop()

    def start(tag, attributes):
        top = stack[-1] if stack else _ROOT
        says = _meanings(tag, attributes)
        seen = tag
        if tag == "header" and top.tags & {"article", "main"}:
            seen, says = "div", says - {"head"}
        elif tag in ("html", "body"):
            says = says - {"hidden"}  # shown by a script later
        tags = top.tags if seen in top.tags else top.tags | {seen}
        means = top.means if says <= top.means else top.means | says
        places[tag].append(len(stack))
        stack.append(_Open(tag, tags, means, says or top.near, len(stack) if tag in _BLOCK else top.block, top.shown and tag not in _SILENT and "hidden" not in says))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and (not stack or stack[-1].shown):
            words.append(page[at : m.start()])
            if places["a"]:
                linked += m.start() - at
        at = m.end()
        tag = m[4]
        if tag is None:
            continue
        tag = tag.lower()
        if m[3]:
            if places[tag]:
                place = places[tag][-1]
                if stack[-1].block >= place:
                    if tag not in _BLOCK:
                        continue  # an inline end tag does not end blocks
                    end_block()
                close(place)
            elif tag in _BLOCK or tag == "br":
                end_block() if tag != "br" else words.append(" ")
            continue
        if tag == "br":
            words.append(" ")
            continue
        if tag in _BLOCK:
            end_block()
            if places["head"] and tag not in ("title", "noscript"):
                close(places["head"][-1])
            if tag in _CLOSES_P and places["p"]:
                close(places["p"][-1])
            if tag in _CLOSES:
                shut = max((places[t][-1] for t in _CLOSES[tag] if places[t]), default=-1)
                if shut > max((places[t][-1] for t in _KEEPS[tag] if places[t]), default=-1):
                    close(shut)
        elif tag in ("img", "input", "wbr"):
            continue
        if tag not in _VOID and not m[5].endswith("/"):
            start(tag, m[5])
    if at < len(page) and (not stack or stack[-1].shown):
        words.append(page[at:])
    end_block()
    return out


def left_out(page: list) -> np.ndarray:
    """Blocks that are never main text whatever surrounds them: in a menu, an aside or a dialog."""
    return np.array([bool(b[2] & _NEVER) for b in page], bool)


_NAMES = ["one"]
_NAMES += [f"tag {t}" for t in "p div li td h1 h2 h3 blockquote pre figcaption dd body a other".split()]
_NAMES += [f"in {t}" for t in "article main section nav header footer aside form ul ol table blockquote figure".split()]
_NAMES += [f"{k} {m}" for k in ("means", "near") for m in [*_MEANS, "hidden"]]
_NAMES += ["silent", "off within body", "body alone", "link some", "link half", "link all", "short", "words 4", "words 12", "words 30", "stop", "commas", "capitals", "digits", "mark", "first", "last", "after h1", "before h1", "same parent tags"]
_AT = {n: i for i, n in enumerate(_NAMES)}


def features(page: list) -> np.ndarray:
    x = np.zeros((len(page), len(_NAMES)))
    title = next((i for i, b in enumerate(page) if b[1] == "h1"), None)
    for i, (text, tag, ancestors, means, near, linked) in enumerate(page):
        on = ["one", f"tag {tag}" if f"tag {tag}" in _AT else "tag other"]
        on += [f"in {t}" for t in ancestors if f"in {t}" in _AT]
        on += [f"means {m}" for m in means] + [f"near {m}" for m in near]
        if ancestors & _SILENT:
            on.append("silent")
        if means & _OFF and "body" in means:
            on.append("off within body")
        elif "body" in means:
            on.append("body alone")
        n, share = text.count(" ") + 1, linked / max(1, len(text))
        if share > 0.05:
            on.append("link some")
        if share > 0.5:
            on.append("link half")
        if share > 0.9:
            on.append("link all")
        on.append("short" if n < 4 else "words 4")
        if n >= 12:
            on.append("words 12")
        if n >= 30:
            on.append("words 30")
        if text[-1] in ".!?…\"'":
            on.append("stop")
        if "," in text:
            on.append("commas")
        if text.isupper():
            on.append("capitals")
        if any(c.isdigit() for c in text):
            on.append("digits")
        if "©" in text or "|" in text or "»" in text:
            on.append("mark")
        if i == 0:
            on.append("first")
        if i == len(page) - 1:
            on.append("last")
        if title is not None:
            on.append("after h1" if i > title else "before h1")
        if i and page[i - 1][2] == ancestors:
            on.append("same parent tags")
        x[i, [_AT[f] for f in on]] = 1.0
    return x


def marked(page: list) -> np.ndarray | None:
    """Labels that the mark-up itself gives, None where it names no main part."""
    if not any("article" in b[2] or "main" in b[2] or "body" in b[3] for b in page):
        return None
    return np.array([int(("article" in b[2] or "main" in b[2] or "body" in b[3]) and not (b[3] & _OFF or "hidden" in b[3] or b[2] & _SILENT or b[2] & {"nav", "aside", "footer", "header", "form"})) for b in page])


def patterns() -> list[tuple[str, list[int]]]:
    """Page patterns with a label for every block, in many arrangements of the same parts."""
    line = "Some longer words of a plain sentence, with a comma, that goes on for a while and ends here. It has more than one."
    main = [(f"<h1>A title of words</h1><p>{line}</p><p>{line} <a href=x>link</a> {line}</p>", [1, 1, 1]), (f"<h2>Part</h2><p>{line}</p><ul><li>An item, short.</li><li>{line}</li></ul><blockquote>{line}</blockquote><p>Yes.</p>", [1, 1, 1, 1, 1, 1])]
    off = {
        "menu": ("<ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul>", [0, 0]),
        "head": ("<div>Name of the site</div><p>Daily words</p>", [0, 0]),
        "foot": ("<p>© 2020 A name. All rights reserved.</p>", [0]),
        "side": (f"<h3>More to read</h3><p>{line}</p><a href=x>Another title of a page</a>", [0, 0, 0]),
        "ad": (f"<p>{line}</p>", [0]),
        "note": ("<p>We use cookies to make things better, as you may know. <a href=x>Accept</a></p>", [0]),
        "talk": (f"<h3>Comments</h3><p>A reader</p><p>{line}</p><p>{line}</p>", [0, 0, 0, 0]),
        "form": ("<p>Search the site</p><label>Your name</label>", [0, 0]),
    }
    tag = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}
    out = []
    for n, (wrap, tail) in enumerate((w, t) for w in ("article", "main", "div class=content", "div id=main", "div", "section class='post entry'") for t in ("div", "tag")):
        def part(kind, style=tail):
            body, labels = off[kind]
            word = _MEANS[kind].split()[n % 3]
            return (f"<{tag[kind]}>{body}</{tag[kind]}>" if style == "tag" and kind in tag else f"<div class='{word}'>{body}</div>"), labels

        kinds = list(off)
        inner = [main[n % 2], part(kinds[n % 8]), main[(n + 1) % 2], part(kinds[(n + 3) % 8]), (f"<p>{line}</p>", [1]), part(kinds[(n + 5) % 8]), main[n % 2], part("ad" if n % 2 else "talk")]
        order = [part("head"), part("menu"), part("note"), part("ad"), inner, part("side"), part("talk"), part("form"), part("foot")]
        body, labels = [], []
        for p in order:
            if isinstance(p, list):
                body.append(f"<{wrap}>" + "".join(t for t, _ in p) + f"</{wrap.split()[0]}>")
                labels += [x for _, ls in p for x in ls]
            else:
                body.append(p[0])
                labels += p[1]
        out.append(("<html><body>" + "".join(body) + "</body></html>", labels))
    return out


def train(pages: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, penalty: float = PENALTY):
    """(weights, transitions) of greatest penalised likelihood, by gradient steps with moments. Equal pages are counted once each."""
    size = pages[0][0].shape[1]
    w, t = np.zeros((size, 2)), np.zeros((2, 2))
    length = max(len(y) for _, y in pages)
    x = np.zeros((len(pages), length, size), np.float32)
    y = np.zeros((len(pages), length), np.int64)
    on = np.zeros((len(pages), length), bool)
    for i, (f, labels) in enumerate(pages):
        x[i, : len(labels)], y[i, : len(labels)], on[i, : len(labels)] = f, labels, True
    gold = np.eye(2)[y] * on[..., None]
    pair = np.einsum("nla,nlb->ab", gold[:, :-1], gold[:, 1:])
    rows = on.sum()
    flat = x[on]
    m = [np.zeros_like(w), np.zeros_like(t)]
    v = [np.zeros_like(w), np.zeros_like(t)]
    for step in range(1, steps + 1):
        s = np.zeros((len(pages), length, 2))
        s[on] = flat @ w
        ahead, back = s.copy(), np.zeros_like(s)
        for k in range(1, length):
            ahead[:, k] = np.where(on[:, k, None], s[:, k] + np.logaddexp(ahead[:, k - 1, 0, None] + t[0], ahead[:, k - 1, 1, None] + t[1]), ahead[:, k - 1])
        for k in range(length - 2, -1, -1):
            nxt = s[:, k + 1] + back[:, k + 1]
            back[:, k] = np.where(on[:, k + 1, None], np.logaddexp(t[:, 0] + nxt[:, 0, None], t[:, 1] + nxt[:, 1, None]), 0.0)
        z = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None, None]
        single = np.exp(ahead + back - z) * on[..., None]
        both = np.exp(ahead[:, :-1, :, None] + t + (s + back)[:, 1:, None, :] - z[..., None]) * on[:, 1:, None, None]
        grads = [flat.T @ (gold - single)[on] / rows - penalty * w, (pair - both.sum((0, 1))) / rows - penalty * t]
        for value, g, m1, v1 in zip((w, t), grads, m, v):
            m1 += 0.1 * (g - m1)
            v1 += 0.01 * (g * g - v1)
            value += 0.2 * (m1 / (1 - 0.9**step)) / (np.sqrt(v1 / (1 - 0.99**step)) + 1e-8)
    return w, t


def viterbi(scores: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The best label path; the rest wins ties."""
    best, came = scores[0].copy(), np.zeros(scores.shape, np.int64)
    for k in range(1, len(scores)):
        ways = best[:, None] + t
        came[k] = ways.argmax(0)
        best = ways.max(0) + scores[k]
    path = np.zeros(len(scores), np.int64)
    path[-1] = best.argmax()
    for k in range(len(scores) - 1, 0, -1):
        path[k - 1] = came[k, path[k]]
    return path


def decode(page: list, w: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The best path among those that leave out what is never main text."""
    scores = features(page) @ w
    scores[left_out(page), 1] = -1e9
    return viterbi(scores, t)


def fit(pages: DataFrame, page: str = "html", limit: int = TRAINING_PAGES):
    """Weights from the patterns and from about `limit` pages, those of least hash of the other columns, that carry their own labels."""
    h = F.xxhash64(*([c for c in pages.columns if c != page] or [page]))
    bound = pages.select(h.alias("h")).orderBy("h").limit(limit).agg(F.max("h")).first()[0]
    chosen = pages.filter(h <= F.lit(bound)).select(F.col(page).alias("page"))

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                found = blocks(text) if text else []
                labels = marked(found) if found else None
                if labels is not None:
                    x = features(found)[:TRAINING_BLOCKS]
                    out.append((x.astype(np.uint8).tobytes(), labels[:TRAINING_BLOCKS].astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())], names=["x", "y"])

    rows = chosen.mapInArrow(run, "x binary, y binary").distinct().limit(limit).collect()
    data = [(np.frombuffer(r["x"], np.uint8).reshape(-1, len(_NAMES)).astype(float), np.frombuffer(r["y"], np.uint8).astype(np.int64)) for r in sorted(rows, key=lambda r: (bytes(r["y"]), bytes(r["x"])))]
    made = []
    for text, labels in patterns():
        found = blocks(text)
        made.append((features(found), np.array(labels)))
    again = max(1, len(data) // (4 * len(made)))  # patterns weigh a fifth of the whole
    return train(data + made * again)


def main_text(pages: DataFrame, page: str = "html", model=None) -> DataFrame:
    """Adds text: the main blocks joined by line ends, and n_blocks, n_main: blocks found and kept.

    Null and empty pages, and pages without text, have the empty text. Character references are decoded, white space in a block is one
    space. Rows are independent: repeated pages give repeated results. An empty table gives an empty result. Other columns pass
    through; columns named like the results are replaced.
    """
    pages = pages.drop(*[c for c in ("text", "n_blocks", "n_main") if c != page])
    weights, transitions = model if model is not None else fit(pages, page)
    shipped = pages.sparkSession.sparkContext.broadcast((weights, transitions))
    names = pages.columns
    schema = pages.select(*names, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_blocks"), F.lit(0).cast("long").alias("n_main")).schema

    def run(batches):
        w, t = shipped.value
        for whole in batches:
            for batch, texts in text_chunks(whole, page):
                out, found_n, main_n = [], [], []
                for text in texts:
                    found = blocks(text) if text else []
                    path = decode(found, w, t) if found else []
                    kept = [b[0] for b, keep in zip(found, path) if keep]
                    out.append("\n".join(kept))
                    found_n.append(len(found))
                    main_n.append(len(kept))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string()), pa.array(found_n, pa.int64()), pa.array(main_n, pa.int64())], names=schema.names)

    return pages.mapInArrow(run, schema)


@query("op1_crf_extraction")
def op1_crf_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_main")
