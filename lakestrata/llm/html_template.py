"""HTML extraction: templates deduced from equivalence classes of tokens on the pages of a host.

Tokens are tags and whole text runs, told apart by their path of enclosing elements. Tokens whose
occurrence vectors over the host's pages are equal form a class. A vector is never gathered: it is
stood for by sums of a hash of (page, count), which partial aggregation builds. Classes that occur
on enough pages, hold more than one token and keep one order are valid; as paths nest, so do they,
and together they are the host's template. What a page has between template tokens are its slots;
the slots of the main part are its text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .url_gbt import url_host

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas".split())
TO_THE_END = frozenset("script style textarea title".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
                  "thead tr ul".split())
#: Elements that are never main text, and words of class, id or role that mark such parts.
NOISE_TAGS = frozenset("nav footer aside form button select menu dialog search head".split())
NOISE_WORDS = frozenset("ad adbox ads adsbygoogle advert adverts advertisement advertising banner breadcrumb breadcrumbs comment commentlist comments "
                        "consent cookie cookies disqus feedback footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
                        "pagination popup promo promoted recommended related replies reply respond share sharing sidebar skip social sponsor sponsored "
                        "subscribe teaser teasers toolbar widget complementary contentinfo alert".split())
AD_WORDS = frozenset("ad ads advert adverts advertisement advertising promoted sponsored".split())  # also as the first word of a name
#: Elements that no name marks as noise, words that deny the last word of a name, parts
#: that a header may head, last words that say no more than the word before.
NEVER_NAMED = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
MODIFIERS = frozenset("has have no not non with without is hide free".split())
OWN_HEADER = frozenset("post entry article story content main".split())
GENERIC = frozenset("area articles bar block bottom box container content group inner item items left link links list outer posts right row section slot stories top unit wrap wrapper".split())
#: A quote only opens a value behind "=", and a value holds no "<": else it is a character like others.
ATTRIBUTES = r"""((?:[^>"'=]|=\s*+(?:"[^"<]*"|'[^'<]*')?+|["'])*+)"""
TAG = re.compile(rf"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*){ATTRIBUTES}>", re.S)
NAMED = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}


@dataclass
class Block:
    """A text run between block borders: its path, the share of characters in links, where it lies.

    ``noise`` has a number for each noise element around it (-1: one that nothing overrules).
    """

    path: str
    text: str
    linked: int
    noise: tuple[int, ...]
    main: bool


@dataclass
class _Open:
    tag: str
    path: str
    noise: tuple[int, ...]
    main: bool


def _noise_name(token: str) -> bool:
    """Whether a class, id or role marks noise: the whole token, or its last word that says more than "list" or "box", unless a modifier precedes it."""
    if token in NOISE_WORDS:
        return True
    parts = [w for w in re.split(r"[^a-z]+", token) if w]
    if parts and parts[0] in AD_WORDS and not MODIFIERS.intersection(parts):
        return True
    while parts and parts[-1] in GENERIC:
        parts.pop()
    if not parts or parts[-1] not in NOISE_WORDS or MODIFIERS.intersection(parts[:-1]):
        return False
    return not (parts[-1] == "header" and OWN_HEADER.intersection(parts[:-1]))


def _marks(attributes: str) -> tuple[str, bool, bool, bool]:
    """Class and id words as a path suffix; whether the element is hidden; whether a name marks noise; whether one marks the main part."""
    words, hidden, noise, main = [], False, False, False
    for name, *values in NAMED.findall(attributes):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        hidden |= name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and bool(UNSEEN.search(value))
        if name in ("class", "id", "role"):
            parts = [w for w in re.split(r"[^a-z]+", value) if w]
            words += parts
            noise |= any(_noise_name(t) for t in value.split())
            main |= name == "role" and "main" in parts
    return "." + ".".join(sorted(set(words))) if words else "", hidden, noise, main


def parse(page: str) -> tuple[list[Block], list[str]]:
    """Text blocks in page order and the tag tokens (path of each element that opens)."""
    stack: list[_Open] = [_Open("", "", (), False)]
    blocks: list[Block] = []
    tags: list[str] = []
    text: list[str] = []
    linked = depth_a = named = 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            # the run belongs to the nearest block element
            top = next(x for x in reversed(stack) if x.tag in BLOCK or not x.tag)
            blocks.append(Block(top.path, joined, linked, top.noise, stack[-1].main))
        text.clear()
        linked = 0

    def close(until: int) -> None:
        nonlocal depth_a
        if any(x.tag in BLOCK for x in stack[until:]):
            flush()
        depth_a -= sum(x.tag == "a" for x in stack[until:])
        del stack[until:]

    at = 0
    size = len(page)
    while at < size:
        m = TAG.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece:
            plain = entities.unescape(piece)
            holder = next(x for x in reversed(stack) if x.tag in BLOCK or not x.tag)
            if len(stack[-1].noise) > len(holder.noise):  # noise inside a line: a block of its own, the line goes on without it
                if plain.strip():
                    blocks.append(Block(holder.path, " ".join(plain.split()), len(plain.strip()) if depth_a else 0, stack[-1].noise, stack[-1].main))
            else:
                text.append(plain)
                if depth_a:
                    linked += len(plain.strip())
        if not m:
            break
        at = m.end()
        ending, tag, attributes = m.group(1), m.group(2), m.group(3)
        if not tag:
            continue
        tag = tag.lower()
        if ending:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if k:
                close(k)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            # what isn't closed runs to the end of the page where it is text to the browser, else it holds nothing
            at = at if attributes.endswith("/") else end.end() if end else size if tag in TO_THE_END else at
            if tag == "title" or tag == "textarea":
                flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
            if k:
                close(k)
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SCOPE[tag]:
                    break
                if stack[i].tag in CLOSES[tag]:
                    close(i)
                    break
        suffix, hidden, noise, main = _marks(attributes) if attributes else ("", False, False, False)
        up = stack[-1]
        main_here = up.main or main or tag in ("article", "main")
        noise_here = up.noise
        if hidden or tag in NOISE_TAGS and tag != "form" or tag == "header" and not up.main:
            noise_here += (-1,)
        elif tag == "form" or noise and tag not in NEVER_NAMED:
            named += 1
            noise_here += (named,)
        path = f"{up.path}/{tag}{suffix}" if tag in BLOCK else up.path
        if tag in BLOCK:
            tags.append(path)
        stack.append(_Open(tag, path, noise_here, main_here))
        depth_a += tag == "a"
    flush()
    return blocks, tags


def _hash(kind: str, *parts: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("\x00".join((kind, *parts))) - (1 << 63)


def tokens_of(page: str) -> tuple[int, dict[int, tuple[int, int]]]:
    """Hash of the page's text (without noise and links, if it has other text) and token -> (occurrences, place of the first)."""
    blocks, tags = parse(page)
    told = [b.text for b in blocks if not b.noise and 2 * b.linked <= len(b.text)] or [b.text for b in blocks]
    names = [_hash("tag", t) for t in tags] + [_hash("text", b.path, b.text) for b in blocks]
    counts = Counter(names)
    places: dict[int, int] = {}
    for k, n in enumerate(names):
        places.setdefault(n, k)
    return _hash("page", *told), {n: (c, places[n]) for n, c in counts.items()}


def deduce_templates(pages: DataFrame, *, host: str = "host", html: str = "html", least_pages: int = 3, least_share: float = 0.1) -> DataFrame:
    """``host tokens``: the tokens of each host's template, from equivalence classes over all its pages.

    A class is valid if its tokens occur on ``least_pages`` pages and a share ``least_share`` of
    the host's, if it has two tokens or more, and if no two tokens swap places between pages (the
    first-place sums of its tokens are all different). Pages of a host that agree in their text
    count as one page, so the text of copies is no template. A host's template holds at most (tokens of
    a page) / ``least_share`` tokens, however many pages it has.
    """
    rows = pages.select(F.coalesce(F.col(host), F.lit("")).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for h, page in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                number, tokens = tokens_of(page)
                out.append((h, None, number, 1, 0))
                out += [(h, t, number, c, k) for t, (c, k) in tokens.items()]
                if len(out) > 50_000:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    seen = rows.mapInArrow(run, "host string, token long, page long, n int, place int")
    seen = seen.groupBy("host", "token", "page").agg(F.max("n").alias("n"), F.min("place").alias("place"))
    # two 31-bit hashes of (page, count): their sums stand for the vector and cannot overflow
    mark = lambda salt: F.sum(F.xxhash64("page", "n", F.lit(salt)).bitwiseAND(F.lit((1 << 31) - 1)))
    vectors = stage(seen.groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.sum("n").alias("total"), F.sum("place").alias("places"), mark(1).alias("v1"), mark(2).alias("v2"))
        .where(F.col("token").isNull() | (F.col("pages") >= least_pages)), "vectors")
    sizes = vectors.where("token IS NULL").select("host", F.col("pages").alias("of"))
    frequent = vectors.where("token IS NOT NULL").join(sizes, "host").where(F.col("pages") >= F.greatest(F.lit(least_pages), least_share * F.col("of")))
    classes = frequent.groupBy("host", "pages", "total", "v1", "v2").agg(
        F.collect_list("token").alias("tokens"), F.count("*").alias("size"), F.count_distinct("places").alias("orders"))
    valid = classes.where("size >= 2 AND orders = size")
    return valid.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    h, t, p, n, k = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(h, pa.string()), pa.array(t, pa.int64()), pa.array(p, pa.int64()), pa.array(n, pa.int32()), pa.array(k, pa.int32())],
                                      names=["host", "token", "page", "n", "place"])


def main_text(page: str, template: set[int]) -> str:
    """The main slots of a page, a block a line.

    Text tokens of the template are no slots, nor is what lies in noise elements. A form, or an
    element that is noise by its name, is none if it holds most of the page's other text, unless a
    main element stands outside of noise. If the page has a main element, its slots are the text (there a run that all pages share is still text: copies
    of one article would otherwise lose it); else all slots but those that are mostly links.
    """
    blocks, _ = parse(page)
    slots = [b for b in blocks if b.main or _hash("text", b.path, b.text) not in template]
    if any(b.noise for b in slots) and not any(b.main and not b.noise for b in slots):
        held: Counter[int] = Counter()
        total = 0
        for b in slots:
            if -1 not in b.noise and 2 * b.linked <= len(b.text):
                total += len(b.text)
                held.update({k: len(b.text) for k in b.noise})
        slots = [b for b in slots if all(k >= 0 and 2 * held[k] > total for k in b.noise)]
    else:
        slots = [b for b in slots if not b.noise]
    if any(b.main for b in slots):
        slots = [b for b in slots if b.main]
    else:
        slots = [b for b in slots if 2 * b.linked <= len(b.text)]
    return "\n".join(b.text for b in slots)


def extract_main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", **options) -> DataFrame:
    """``page_id url text n_chars`` of every row of ``pages``.

    Character references are decoded, white space in a block becomes one space, blocks are trimmed
    and joined by one line feed. Null and empty pages give an empty text, null URLs the empty
    host. Hosts with few pages have an empty template and go by their elements alone. Broken
    markup is read as far as it goes. Repeated rows all come back; other columns are ignored.
    """
    base = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    base = base.withColumn("host", url_host(F.col("url")))
    templates = stage(deduce_templates(base, **options), "templates")
    rows = base.join(templates, "host", "left").select("page_id", "url", "html", "host", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[int]] = {}
        for batch in batches:
            hosts = batch.column(3).to_pylist()
            texts = []
            for k, (h, page) in enumerate(zip(hosts, batch.column(2).to_pylist(), strict=True)):
                if h not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[h] = set(batch.column(4)[k].as_py() or ())
                texts.append(main_text(page or "", known[h]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    kind = base.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
