"""Main text of web pages: markup says what it can, a host's suffix arrays decide the rest.

**Markup.** A page is read once by a tag scanner. Elements that are chrome by name (menus, asides, forms, scripts ...), by
role or by a word of their class or id are left out; names that say has, no, with or without do not count, and neither do
the ids of headings and paragraphs, which are made from their text. A name of several words is sure only if the others are usual
in layouts (``site-footer``, ``ad-slot``) or it names comments; others (``related-work``, ``ad-hoc``) leave a block in doubt. An
article inside a wrapper that is chrome (but not an aside, hidden, a comment or a related block) is text again. If the page marks its article (``article``, ``main``, their
roles), the article's remaining blocks are the text; of them only those in doubt can be dropped for being repeated elsewhere.

**Suffix arrays.** A page without such a mark, and a block in doubt, keeps what does not repeat on its host. The token streams of
a host's pages (whole unmarked pages, and of marked ones what stands outside the article or is in doubt) are concatenated, sorted as a suffix array,
and common prefixes of neighbours give the runs of ``RUN`` tokens together with the number of distinct pages that hold
them. A host with many pages is dealt over several groups; each counts its runs, and the counts are summed by host and
run, so that dealing does not change the result. Runs on ``PAGES`` pages or more are boilerplate: a block with
half of its tokens or more inside such runs is removed, blocks of unique runs stay. Pages with the same text
count as one, so that a mirrored page is not taken for boilerplate.

Hosts on which every page marks its article and has nothing in doubt skip the second part; it could not change their text.

Defined results: null or empty html gives an empty text; a page that is cut off counts as far as it goes, and an unfinished
tag at its end is dropped; white space, also from character references, becomes one space; a null or odd url is the host
""; repeated rows are treated alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import ship_package, staged
from churnlake.llm.near_duplicates import small_batches
from churnlake.llm.suffix_dedup import common_prefixes, suffix_order
from churnlake.llm.textbytes import mix, word_hashes

RUN, PAGES, GROUP = 6, 3, 1_000

#: Fixed values of HTML: elements without content, elements that begin a block, elements closed by their like.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr "
    "ul".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
#: What is not main text, by element, role, and word of a class or id.
CHROME = frozenset(
    "aside button dialog footer form head iframe menu nav noscript object option script select style svg template "
    "textarea title".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
WORDS = frozenset(
    "ad adbox ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted related replies respond share sharing sidebar social sponsor sponsored subscribe "
    "toolbar topbar widget".split())
#: Words that name reader comments in any company, words that are in doubt alone, and words that stand beside others in layouts.
READERS = frozenset("comment comments disqus replies reply respond".split())
DOUBTFUL = frozenset({"discussion"})
LAYOUT = frozenset(
    "area article articles bar block blocks body bottom box btn button buttons card cards center col column container content count "
    "desktop embed entry fixed form global google header heading home icon icons image inner item items js label layout left link "
    "links list location main message meta mobile module outer overlay page pane panel placement post posts primary right root "
    "row secondary section signup site slot sticky stories story strip tag tags text thread title toggle tools top unit user "
    "wrap wrapper zone".split())
#: Elements whose id is commonly a slug of their own text.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 p dt".split())
OUTSIDE_ONLY = frozenset({"header", "masthead", "banner"})
#: Chrome that an article inside does not leave: all elements and roles but these, and these words.
WRAPPERS = frozenset({"form", "head"})
APART = frozenset(
    "ad adbox ads adsense advert advertisement adverts comment comments discussion disqus promo promoted related replies "
    "respond sidebar sponsor sponsored widget".split())
RELATION = frozenset({"has", "no", "with", "without"})
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
_PARTS = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|textarea|noscript|template|iframe)\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-z][^>]*\Z", re.S | re.I)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)


def _words(name: str, found: dict[str, str]) -> tuple[set[str], bool]:
    """The chrome words that an element's class names and id are sure to mean, and whether there are others, in doubt."""
    sure, doubt = set(), False
    for own in (found.get("class", "") + " " + ("" if name in TITLED else found.get("id", ""))).split():
        parts = _SPLIT.split(own)
        words = WORDS.intersection(parts)
        if not words or RELATION.intersection(parts):
            continue
        clear = all(p in WORDS or p in LAYOUT or len(p) <= 2 or p.isdigit() for p in parts) and not words <= DOUBTFUL
        if clear or words & READERS:
            sure |= words
        else:
            doubt = True
    return sure, doubt


def _kind(name: str, rest: str, in_article: bool) -> tuple[int, bool, bool]:
    """Whether an element is chrome (2: also for an article inside), marks the article, and is in doubt."""
    found = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(rest)} if "=" in rest else {}
    role = found.get("role", "")
    marks = name in ("article", "main") or role in ("main", "article") or found.get("itemprop") == "articlebody"
    if name in ("html", "body") or name in ("article", "main") and role not in ROLES:
        words = _words(name, found)[0] if name == "article" else set()
        return 2 * bool(words & {"comment", "comments", "reply", "replies"}), marks, False
    words, doubt = _words(name, found)
    out = name in CHROME or role in ROLES or bool(words & WORDS) or name == "header" and not in_article
    unseen = found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    unseen = unseen or bool(_HIDDEN.search(_VALUE.sub("=", rest)))
    out = out or unseen
    if in_article and out and (name == "header" or words & OUTSIDE_ONLY) and not words & (WORDS - OUTSIDE_ONLY):
        out = name in CHROME
    apart = unseen or name in CHROME - WRAPPERS or role in ROLES - WRAPPERS or bool(words & APART)
    return (2 if apart else 1) if out else 0, marks, doubt and not out


def blocks_of(page: str) -> tuple[list[str], list[str], list[str], bool]:
    """Blocks inside the marked article, blocks outside that are not chrome, chrome, and whether there is a mark."""
    inside, outside, chrome, marked = _scan(page)
    return [text for text, _ in inside], outside, chrome, marked


def _scan(page: str) -> tuple[list[tuple[str, bool]], list[str], list[str], bool]:
    """As ``blocks_of``; with the article's blocks whether they are in doubt."""
    inside, outside, chrome = [], [], []
    stack: list[tuple[str, int, bool, bool]] = []  # name, chrome, inside an article, in doubt; they include what is around
    piece: list[str] = []
    marked, at = False, 0

    def flush() -> None:
        text = " ".join("".join(piece).split())
        piece.clear()
        if text:
            out, article, doubt = stack[-1][1:] if stack else (0, False, False)
            if article and not out:
                inside.append((text, doubt))
            else:
                (chrome if out else outside).append(text)

    def close(index: int) -> None:
        """Close the elements from ``index`` on; text that is held belongs to the innermost one."""
        while len(stack) > index:
            around = stack[-2][1:] if len(stack) > 1 else (0, False, False)
            if stack[-1][0] in BLOCK or around != stack[-1][1:]:
                flush()
            stack.pop()

    for part in _PARTS.finditer(page):
        if part.start() > at:
            piece.append(references.unescape(page[at:part.start()]))
        at = part.end()
        name = (part["name"] or "").lower()
        if not name:
            continue
        if part["end"]:
            index = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if index is not None:
                if name in BLOCK:
                    flush()
                close(index)
            elif name == "p":
                flush()
            continue
        if name == "br" or name in ("td", "th"):
            piece.append(" ")
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in BLOCK:
            flush()
        for index in range(len(stack) - 1, -1, -1):
            if stack[index][0] in CLOSES.get(name, ("p",) if name in BLOCK else ()):
                close(index)
                break
            if stack[index][0] in BLOCK:
                break
        if name == "body" or stack and stack[-1][0] == "head" and name not in IN_HEAD:
            index = next((i for i, held in enumerate(stack) if held[0] == "head"), None)
            if index is not None:
                close(index)
        out, article, doubt = stack[-1][1:] if stack else (0, False, False)
        own, marks, doubts = _kind(name, part["rest"], article)
        if marks and out == 1 and not article:
            out = 0
        marked |= marks and not out and not own
        begins = marks and not out and not own and not article
        after = (max(out, own), article or begins, (doubt or doubts) and not begins)
        if not stack or after != stack[-1][1:]:
            flush()
        if not part["rest"].endswith("/") or name in BLOCK:
            stack.append((name, *after))
    if at < len(page):
        piece.append(references.unescape(page[at:]))
    flush()
    return inside, outside, chrome, marked


def run_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token codes of all texts in order, and the text of each."""
    return word_hashes([t.encode("utf-8", "surrogatepass") for t in texts])


def _run_hash(tokens: np.ndarray, width: int) -> np.ndarray:
    n = max(0, len(tokens) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = mix(out ^ tokens[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
    return out


def repeated_runs(streams: list[str], width: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all distinct runs of ``width`` tokens of the streams, and on how many streams each stands.

    The streams are one sequence of token numbers in which every stream ends with a number of its own; in its suffix
    array equal runs are neighbours, a stretch with common prefixes of ``width`` or more.
    """
    tokens, owner = run_codes(streams)
    if len(tokens) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    _, numbers = np.unique(tokens, return_inverse=True)
    ends = np.searchsorted(owner, np.arange(len(streams)), side="right")
    sequence = np.insert(numbers.astype(np.int64), ends, numbers.max() + 1 + np.arange(len(streams)))
    page = np.insert(owner, ends, np.arange(len(streams)))
    order = suffix_order(sequence)
    long = common_prefixes(sequence, order, width) >= width
    whole = np.zeros(len(sequence), dtype=bool)
    whole[:len(sequence) - width + 1] = page[width - 1:] == page[:len(sequence) - width + 1]
    whole &= np.concatenate([sequence[width - 1:] <= numbers.max(), np.zeros(width - 1, bool)])
    group = np.cumsum(~long) - 1
    use = whole[order]
    pairs = np.unique(np.stack([group[use], page[order][use]]), axis=1)[0]
    pages = np.bincount(pairs, minlength=group[-1] + 1)
    first = np.full(group[-1] + 1, -1, dtype=np.int64)
    first[group[use]] = order[use]
    known = np.flatnonzero(first >= 0)
    spread = np.zeros(len(sequence), dtype=np.uint64)
    spread[np.delete(np.arange(len(sequence)), ends + np.arange(len(streams)))] = tokens
    return _run_hash(spread, width)[first[known]], pages[known]


def kept_blocks(blocks: list[str], boilerplate: set[int], doubts: list[bool], width: int = RUN) -> list[str]:
    """The blocks that are not in doubt or of which less than half of the tokens lie in boilerplate runs."""
    if not blocks:
        return []
    tokens, owner = run_codes(blocks)
    hit = np.array([h in boilerplate for h in _run_hash(tokens, width).view(np.int64).tolist()], dtype=bool)
    covered = np.zeros(len(tokens), dtype=bool)
    for k in range(width):
        covered[k:k + len(hit)] |= hit
    share = np.bincount(owner, weights=covered, minlength=len(blocks))
    sizes = np.bincount(owner, minlength=len(blocks))
    return [b for b, c, n, doubt in zip(blocks, share, sizes, doubts) if not doubt or 2 * c < n]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group: int = GROUP) -> DataFrame:
    """id, url, text, n_chars of every page."""
    ship_package(pages.sparkSession)
    spark = pages.sparkSession
    kind = pages.select(F.col(f"`{id_col}`").alias("id")).schema[0].dataType.simpleString()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page in batch["html"]:
                inside, outside, chrome, marked = _scan(page)
                texts, doubts = [t for t, _ in inside], [d for _, d in inside]
                stream = "\n".join(outside + chrome + [t for t, d in inside if d] if marked else outside)
                whole = hashlib.md5("\n".join([*texts, "", stream] if marked else [stream]).encode("utf-8", "surrogatepass")).hexdigest()
                if marked and not any(doubts):
                    out.append(("\n".join(texts), None, None, stream, whole))
                else:
                    out.append((None, texts if marked else outside, doubts if marked else [True] * len(outside), stream, whole))
            table = pd.DataFrame(out, columns=["text", "blocks", "doubts", "stream", "whole"])
            for k, name in enumerate(("id", "url", "host", "key")):
                table.insert(k, name, batch[name].array)
            yield table

    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url_col}`"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    source = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    ready = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), host.alias("host"),
                         F.md5(source).alias("key"), source.alias("html"))
    schema = f"id {kind}, url string, host string, key string, text string, blocks array<string>, doubts array<boolean>, stream string, whole string"
    with small_batches(spark):
        parsed = staged(ready.mapInPandas(parse, schema), "pages-parsed")
    marked = parsed.where("text IS NOT NULL").select("id", "url", "text")
    open_ = parsed.where("text IS NULL AND size(blocks) > 0")
    empty = parsed.where("text IS NULL AND size(blocks) = 0").select("id", "url", F.lit("").alias("text"))
    done = marked.unionByName(empty)
    if open_.limit(1).count():
        done = done.unionByName(_by_host(parsed, open_, group, kind))
    return done.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                       F.length("text").cast("long").alias("n_chars"))


def _by_host(parsed: DataFrame, open_: DataFrame, group: int, kind: str) -> DataFrame:
    hosts = open_.select(F.col("host").alias("h")).distinct()
    streams = parsed.join(hosts, F.col("host") == F.col("h"), "left_semi").where("stream <> ''").select(
        "host", "whole", "stream").dropDuplicates(["host", "whole"])
    dealt = streams.groupBy(F.col("host").alias("h")).agg(F.ceil(F.count(F.lit(1)) / group).cast("long").alias("groups"))
    dealt = streams.join(dealt, F.col("host") == F.col("h")).withColumn("part", F.pmod(F.xxhash64("whole"), "groups"))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        runs, pages = repeated_runs(rows["stream"].tolist())
        return pd.DataFrame({"host": rows["host"].iloc[0], "run": runs.view(np.int64), "pages": pages})

    counts = dealt.groupBy("host", "part").applyInPandas(count, "host string, run long, pages long")
    boilerplate = staged(counts.groupBy("host", "run").agg(F.sum("pages").alias("pages")).where(f"pages >= {PAGES}")
                         .select(F.col("host").alias("h"), F.col("run").alias("r")), "pages-runs")

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for host, key, blocks in zip(batch["host"], batch["key"], batch["blocks"]):
                found = np.unique(_run_hash(run_codes(list(blocks))[0], RUN))
                yield pd.DataFrame({"host": host, "key": key, "run": found.view(np.int64)})

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = ["\n".join(kept_blocks(list(b), set() if h is None else set(h), list(d)))
                     for b, h, d in zip(batch["blocks"], batch["hits"], batch["doubts"])]
            yield batch[["id", "url"]].assign(text=texts)

    own = open_.select("host", "key", "blocks").dropDuplicates(["host", "key"]).mapInPandas(runs, "host string, key string, run long")
    hits = own.join(boilerplate, (F.col("host") == F.col("h")) & (F.col("run") == F.col("r"))).groupBy(
        F.col("host").alias("hh"), F.col("key").alias("kk")).agg(F.collect_set("run").alias("hits"))
    joined = open_.join(hits, (F.col("host") == F.col("hh")) & (F.col("key") == F.col("kk")), "left").select(
        "id", "url", "blocks", "doubts", "hits")
    return joined.mapInPandas(keep, f"id {kind}, url string, text string")
