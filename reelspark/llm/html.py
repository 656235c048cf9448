"""HTML extraction by equivalence-class template deduction.

A page is a sequence of tokens: start tags, told apart by their path from the root, and text nodes, told
apart by path and words. A token's occurrence vector is its number of occurrences on every page of a
host. Tokens of a host with equal vectors form an equivalence class; a class is valid if it stands on
at least `SUPPORT` of the host's pages, on two at least, and has two tokens or more. Paths nest the
valid classes, which are the host's template. What the template does not hold are the slots; the main
text are the slots inside the article, or, on pages without one, all slots outside other page parts.
Inside an article a text is template only if its class holds a start tag, as text of the page's frame does:
sentences that copies of one article share are no frame. An article or page that is all template (a host
of copies) keeps its text. Blanks between elements stay as one blank.

Vectors are never gathered: a task folds the pages it reads into sums of page-and-count hashes (both halves
of 64 bits, each modulo 2^32) per token, and Spark combines these before and after the shuffle, so a hot host
costs each task one row per token. A page is named by its key and content, so rows without a key differ by
what they hold, and rows that repeat weigh alike in every token of theirs. Templates are broadcast if they are at most `BROADCAST_TOKENS` tokens, else joined by host.

Defined cases: a null or empty page has an empty text; a null url is a host of its own name (empty); a host
with one page has no template; keys may be null or repeat, each row gives one row (a row that
repeats counts as often in support and vectors); unclosed elements end with their parent; nothing is capped.
"""
from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

SUPPORT = 0.5
BROADCAST_TOKENS = 500_000
MASK = (1 << 32) - 1

#: What HTML says about elements, and names of page parts that are no main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp")
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
MAIN = frozenset(("article", "main"))
OUTSIDE = frozenset("nav footer aside form button select option label input dialog menu head object video audio canvas".split())
OUTSIDE_NAMES = frozenset("""ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments cookie cookies
    copyright disqus footer menu modal nav navbar navigation newsletter notice pagination popup promo related share sharing sidebar
    social sponsor sponsored subscribe subscription toolbar widget""".split())
CLOSED_BY = {"p": BLOCKS - {"br"}, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
             "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",))}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden)(?![\w-])\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_NAME = re.compile(r"[a-z0-9]+")


def nodes(page: str) -> Iterator[tuple[int, str, str, bool, bool]]:
    """(token, tag or "", text, inside the main element, outside of main text) of start tags, ends of blocks and texts."""
    from xxhash import xxh3_64_intdigest as digest
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]       # tag, path, in main, outside
    at = 0

    def token(path: int, what: str) -> int:
        return digest(f"{path}|{what}".encode("utf-8", "surrogatepass"))

    def text(raw: str) -> Iterator[tuple[int, str, str, bool, bool]]:
        if raw:
            _, path, main, outside = stack[-1]
            yield 0 if raw.isspace() else token(path, " ".join(raw.split())), "", raw, main, outside

    size = len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            yield from text(page[at:])
            break
        if found.start() > at:
            yield from text(page[at:found.start()])
        at = found.end()
        if not found["tag"]:
            continue
        tag = found["tag"].lower()
        if found["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            if tag in BLOCKS:
                yield 0, tag, "", stack[-1][2], stack[-1][3]
            continue
        while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1][0], ()):
            stack.pop()
        if tag in BLOCKS and any(s[0] == "p" for s in stack[-4:]):           # an open p, below inline elements
            i = max(i for i, s in enumerate(stack) if s[0] == "p")
            if not any(s[0] in BLOCKS for s in stack[i + 1:]) and tag in CLOSED_BY["p"]:
                del stack[i:]
        names, hidden = [], False
        for name, value in _ATTR.findall(found["attrs"]):
            name = name.lower()
            hidden |= name == "hidden"
            names += _NAME.findall(value.lower()) if name != "hidden" else []
        parent = stack[-1]
        main = parent[2] or tag in MAIN or (parent[0] != "" and "main" in names and "role" in found["attrs"].lower())
        outside = (parent[3] or hidden or tag in OUTSIDE or (tag == "header" and not main)
                   or (tag not in MAIN and tag not in ("html", "body") and not OUTSIDE_NAMES.isdisjoint(names)))
        path = token(parent[1], " ".join((tag, *names)))
        yield path, tag, "", main, outside
        if tag in RAW:
            close = re.compile(rf"</{tag}(?![\w-])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else size
        elif tag not in VOID and not found["attrs"].endswith("/"):
            stack.append((tag, path, main, outside))


def extract(page: str | None, template: set[int], frame: set[int]) -> str:
    """Main text of a page: slots of its article, else its slots outside other page parts; frame: template texts beside tags."""
    if not page:
        return ""
    seen = list(nodes(page))
    whole = any(tag in MAIN or main for _, tag, _, main, _ in seen)

    def kept(known: set[int]) -> str:
        blocks: list[list[str]] = [[]]
        for token, tag, text, main, outside in seen:
            if tag:
                if tag in BLOCKS:
                    blocks.append([])
            elif not outside and (main or not whole) and token not in known:
                blocks[-1].append(text)
        joined = (" ".join(entities.unescape("".join(b)).split()) for b in blocks if b)
        return "\n".join(b for b in joined if b)
    return kept(frame if whole else template) or kept(set())


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", support: float = SUPPORT) -> DataFrame:
    """(host, token, tag, frame, cls, pages): tokens of every host's valid classes; tag: a start tag; frame: its class holds
    one; cls names the class by its vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        from xxhash import xxh3_64_intdigest as digest
        for batch in batches:
            seen: dict[tuple[str, int], list[int]] = {}
            for name, key, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = [(t, tag != "") for t, tag, *_ in nodes(source or "") if t]
                counts, tags = Counter(t for t, _ in found), {t for t, is_tag in found if is_tag}
                counts[0] = 1                                                # the page itself
                row = f"{key}|{digest((source or '').encode('utf-8', 'surrogatepass'))}"
                for token, n in counts.items():
                    own = seen.setdefault((name, token), [0, 0, 0, False])
                    code = digest(f"{row}|{n}".encode())
                    own[0] = own[0] + (code >> 32) & MASK
                    own[1] = own[1] + (code & MASK) & MASK
                    own[2] += 1
                    own[3] |= token in tags

            def signed(x: int) -> int:
                return x - (1 << 64) if x >> 63 else x
            yield pa.RecordBatch.from_arrays([
                pa.array([h for h, _ in seen], pa.string()), pa.array([signed(t) for _, t in seen], pa.int64()),
                *(pa.array([own[i] for own in seen.values()], pa.int64()) for i in range(3)),
                pa.array([own[3] for own in seen.values()], pa.bool_())], names=["host", "token", "high", "low", "pages", "tag"])

    read = pages.select(host(F.col(url)).alias("host"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("page"), F.col(html).alias("html"))
    half = lambda c: F.sum(c).bitwiseAND(F.lit(MASK))
    tokens = (read.mapInArrow(run, "host string, token long, high long, low long, pages long, tag boolean")
              .groupBy("host", "token").agg(F.xxhash64(half("high"), half("low")).alias("vector"), F.sum("pages").alias("pages"), F.max("tag").alias("tag"))
              .filter("pages > 1"))
    tokens = checkpointed(tokens)
    whole = tokens.filter("token = 0").select("host", F.col("pages").alias("of"))
    classes = tokens.filter("token <> 0").groupBy("host", "vector", "pages").agg(
        F.count("*").alias("size"), F.max("tag").alias("frame")).filter("size > 1")
    valid = classes.join(whole, "host").filter(F.col("pages") >= support * F.col("of")).select("host", "vector", "pages", "frame")
    return (tokens.filter("token <> 0").join(valid, ["host", "vector", "pages"])
            .select("host", "token", "tag", "frame", F.col("vector").alias("cls"), "pages"))


def main_text(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", support: float = SUPPORT) -> DataFrame:
    """(page, url, text) of every row."""
    per_host = checkpointed(templates(pages, page, url, html, support).filter("not tag").groupBy("host").agg(
        F.array_sort(F.collect_list("token")).alias("template"),
        F.array_sort(F.collect_list(F.when(F.col("frame"), F.col("token")))).alias("frame")))
    size = per_host.agg(F.coalesce(F.sum(F.size("template") + F.size("frame")), F.lit(0))).first()[0]
    small = F.broadcast(per_host) if size <= BROADCAST_TOKENS else per_host
    kind = pages.schema[page].dataType.simpleString()
    read = pages.select(F.col(page).alias("page"), F.col(url).alias("url"), F.col(html).alias("html"), host(F.col(url)).alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for source, *known in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                made.append(extract(source.as_py(), *({t & (1 << 64) - 1 for t in x or ()} for x in known)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string())], names=["page", "url", "text"])

    return (read.join(small, "host", "left").select("page", "url", "html", "template", "frame")
            .mapInArrow(run, f"page {kind}, url string, text string").withColumnRenamed("page", page).withColumnRenamed("url", url))
