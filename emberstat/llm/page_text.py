"""Main text of web pages.

Each page is parsed into blocks of text. Menus, page headers and footers,
sidebars, notices, adverts, forms, scripts, styles and comments are known by
their elements and roles, or else by a class or id all of whose words say so
("cookie-notice", not "related-work" or "has-sidebar"); text inside an article
element (or else a main element) is the article. A name alone doesn't remove
most of an article's words, unless it is that of reader comments or a menu or
most of it is links.

All pages are compared within their whole host: in shards of bounded size the
token streams of the pages are put one behind the other and a suffix array
finds the runs of ``LEAST_RUN`` tokens and on how many distinct pages they
stand; these counts are summed up over the host. Tokens covered by runs of
enough of the host's pages are boilerplate and the other runs are kept. Of a
page that marks its article the stream is what stands around the article, and a
run of such boilerplate also goes from the article if ``LEAST_PAGES`` different
articles of the host hold it, and no more than hold it outside. Other repeats
in articles stay: articles share passages, a page may be a copy, and a sidebar
may show how another article begins.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html.parser import HTMLParser
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, mix64, pieces, shingles, small_batches, stage, with_results
from .decontaminate import suffix_array
from .url_rules import host_of

#: Tokens of a run; distinct pages that it stands on at least, as a number and as a share of the host's distinct pages.
LEAST_RUN, LEAST_PAGES, LEAST_SHARE = 8, 3, 0.01

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("script style noscript template iframe object svg canvas annotation annotation-xml head title datalist audio video".split())
_SKIP = frozenset("nav footer aside form script style noscript template button select option textarea label fieldset iframe object svg canvas annotation annotation-xml menu dialog head title datalist audio video".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow msub msup msubsup mfrac msqrt mroot munder mover munderover mfenced mtable mtr mtd mspace mstyle semantics".split())
_HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_NOISE = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsored sponsor promo promotion banner banners cookie cookies consent gdpr
notice notices disclaimer alert nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside masthead footer comment comments commentlist
disqus respond reply replies share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay pagination pager toolbar
widget widgets skip""".split())
#: Words that may stand beside these in a name, and first words that say the opposite.
_BESIDE = frozenset("""area articles author bar block body bottom box button buttons col column component container content count desktop float fixed frame global group
header headline holder id inner item items left line link links list main media message mobile module outer page panel placeholder posts post primary region right row
secondary section site slot sticky stories strip thread title to top trail unit wrap wrapper zone""".split())
_NOT = frozenset("no not has have with without hide is supports".split())
_HEADER = frozenset(["header", "masthead"])
#: Names that hold however much of an article they cover.
_SURE = frozenset("comment comments commentlist disqus respond nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def named(names: str, words: frozenset) -> set[str]:
    """The ``words`` that names (classes, ids) consist of, with nothing but fillers beside them."""
    out: set[str] = set()
    for name in names.split():
        parts = [x.lower() for x in _PART.findall(name) if len(x) > 1]
        if parts and parts[0] not in _NOT and all(x in words or x in _BESIDE for x in parts):
            out.update(x for x in parts if x in words)
    return out


class _Blocks(HTMLParser):
    """Blocks of one page as (zone, text, doubt): zone 2 in an article, 1 in main, 0 elsewhere; what structure shows to be noise
    is left out. ``doubt`` is the number of the outermost element around that only its name calls noise (0: none); ``sure``
    holds those whose name is enough, ``links`` the characters of each that are links. ``around`` is the text of the noise."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str, int]] = []
        self.now: list[str] = []
        self.around: list[str] = []
        self.open: list[tuple[str, str]] = []  # open elements that matter: (tag, kind)
        self.doubts = 0
        self.sure: set[int] = set()
        self.links: Counter = Counter()
        self.in_link = 0

    def cut(self) -> None:
        text = " ".join("".join(self.now).split())
        if text:
            self.blocks.append((self.zone(), text, self.doubt()))
        self.now = []

    def zone(self) -> int:
        kinds = [k for _, k in self.open]
        return 2 if "article" in kinds else 1 if "main" in kinds else 0

    def doubt(self) -> int:
        return next((int(k[5:]) for _, k in self.open if k.startswith("doubt")), 0)

    def muted(self) -> bool:
        return any(k == "noise" for _, k in self.open) or any(k == "header" for _, k in self.open) and not any(k == "heading" for _, k in self.open)

    def kind(self, tag: str, attrs: dict[str, str | None]) -> str:
        role = (attrs.get("role") or "").lower()
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        if tag in _SKIP:
            return "noise"
        if tag in ("article", "main") or role in ("main", "article") or "articlebody" in (attrs.get("itemprop") or "").lower():
            inside = any(k == "article" for _, k in self.open)
            if inside and (self.doubt() or self.muted()):
                return "same"
            return "noise" if inside and named(names, _NOISE) else "main" if tag == "main" or role == "main" else "article"
        if tag in ("body", "html"):
            return ""
        if role in _ROLES or "hidden" in attrs:
            return "noise" if tag not in _HEADINGS else "heading"
        said = named(names, _NOISE)
        if said and tag not in _HEADINGS:
            self.doubts += 1
            if said & _SURE:
                self.sure.add(self.doubts)
            return f"doubt{self.doubts}"
        if tag == "header" or named(names, _HEADER) and tag not in _HEADINGS:
            return "header" if any(k in ("article", "main") for _, k in self.open) else "noise"
        return "heading" if tag in _HEADINGS else "same"

    def handle_starttag(self, tag, attrs) -> None:
        kind = self.kind(tag, dict(attrs))
        if kind in ("article", "main"):  # noise that was never closed ends here
            while self.open and self.open[-1][1].rstrip("0123456789") in ("noise", "doubt", "same", "heading", "header") and not any(t in ("aside", "nav", "footer", "form") for t, _ in self.open):
                self.open.pop()
        if tag not in _INLINE or kind == "noise" or kind.startswith("doubt"):
            self.cut_if_heard()
        if tag in _VOID:
            return
        self.in_link += tag == "a"
        if tag == "p" and any(t == "p" for t, _ in self.open):  # a paragraph ends the one before
            self.finish("p")
        # plain elements only count inside others of their name, so that ends are matched
        if kind not in ("same", "") or any(t == tag and k != "same" for t, k in self.open):
            self.open.append((tag, kind))

    def handle_endtag(self, tag) -> None:
        if tag not in _INLINE:
            self.cut_if_heard()
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        self.finish(tag)

    def finish(self, tag: str) -> None:
        at = max((i for i, (t, _) in enumerate(self.open) if t == tag), default=-1)
        if at >= 0:
            self.cut_if_heard()
            del self.open[at:]

    def cut_if_heard(self) -> None:
        if not self.muted():
            self.cut()
        else:
            self.now = []

    def handle_data(self, data) -> None:
        if self.muted():
            if not any(t in _UNSEEN for t, _ in self.open):
                self.around.append(data)
        else:
            self.now.append(data)
            if self.in_link and (doubt := self.doubt()):
                self.links[doubt] += len(data.strip())


def read_page(html: str | None) -> tuple[bool, str, str]:
    """Whether the page marks its article, its text, and what stands around that."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.cut_if_heard()
    best = max((z for z, _, d in parser.blocks if d not in parser.sure), default=0)
    words, chars = Counter(), Counter()
    for z, text, doubt in parser.blocks:
        if z == best:
            words[doubt] += len(text.split())
            chars[doubt] += len(text)
    total = sum(n for d, n in words.items() if d not in parser.sure)
    stays = {0} | {d for d, n in words.items() if d not in parser.sure and best > 0 and 2 * n > total and 2 * parser.links[d] < chars[d]}
    is_text = [z == best and d in stays for z, _, d in parser.blocks]
    around = [t for (_, t, _), own in zip(parser.blocks, is_text) if not own] + " ".join(parser.around).split()
    return best > 0, " ".join(t for (_, t, _), own in zip(parser.blocks, is_text) if own), " ".join(around)


def article_of(html: str | None) -> tuple[bool, str]:
    """Whether the page marks its article, and its text."""
    return read_page(html)[:2]


class Runs(NamedTuple):
    """The runs of ``LEAST_RUN`` tokens of a shard's pages in suffix order: place in the stream, group of equal runs, page,
    and the run's tokens as places in ``names``."""

    tokens: list[list[str]]
    names: list[str]
    order: np.ndarray
    group: np.ndarray
    page: np.ndarray
    run: np.ndarray


def runs_of(texts: list[str]) -> Runs:
    tokens = [t.split() for t in texts]
    names: dict[str, int] = {}
    code = np.array([names.setdefault(w, len(names)) for t in tokens for w in t], np.uint64)
    n = len(code)
    place = np.arange(n) + np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])  # an end mark stands behind each page
    symbols = np.zeros(n + len(texts) + LEAST_RUN, np.uint64)
    symbols[place] = code + np.uint64(1)
    owner = np.repeat(np.arange(len(texts)), np.array([len(t) + 1 for t in tokens], np.int64))
    order = suffix_array(symbols[: n + len(texts)], LEAST_RUN)
    run = symbols[order[:, None] + np.arange(LEAST_RUN)[None, :]]
    whole = (run != 0).all(axis=1)
    order, run = order[whole], run[whole]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (run[1:] != run[:-1]).any(axis=1)
    return Runs(tokens, list(names), order, np.cumsum(fresh) - 1, owner[order], run.astype(np.int64) - 1)


def without(text: str, own: list[str], at: np.ndarray) -> str:
    """The text without the runs that start at the tokens ``at``. A page that would keep nothing is a copy of others, not
    boilerplate, and stays whole."""
    step = np.zeros(len(own) + LEAST_RUN + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + LEAST_RUN, -1)
    covered = np.cumsum(step) > 0
    keep = [w for w, c in zip(own, covered) if not c]
    return " ".join(keep) if keep else text


def unique_runs(texts: list[str]) -> list[str]:
    """The texts of one host's pages without tokens that stand in runs repeated across pages."""
    r = runs_of(texts)
    pages = np.unique(np.stack([r.group, r.page]), axis=1)[0]
    common = (np.bincount(pages) >= max(LEAST_PAGES, LEAST_SHARE * len(set(texts))))[r.group] if len(r.order) else np.zeros(0, bool)
    start = np.cumsum([0, *[len(t) + 1 for t in r.tokens]])
    return [without(t, own, r.order[common & (r.page == k)] - start[k]) for k, (t, own) in enumerate(zip(texts, r.tokens))]


def _hashes(tokens: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(w.encode(errors="surrogatepass"), digest_size=8).digest(), "little") for w in tokens], np.uint64)


def run_keys(run: np.ndarray) -> np.ndarray:
    """What ``shingles`` gives for each row of token hashes."""
    wide = np.zeros((len(run), 2 * LEAST_RUN - 1), np.uint64)
    wide[:, :LEAST_RUN] = run
    return shingles(wide.ravel(), LEAST_RUN)[:: 2 * LEAST_RUN - 1] if len(run) else run[:, 0]


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pages (host, text) to rows (host, run, n): on how many a run stands; a null run counts the pages."""
    for batch in batches:
        for piece in pieces(batch, 1):
            hosts, host = np.unique(piece.column(0).to_numpy(), return_inverse=True)
            r = runs_of(piece.column(1).to_pylist())
            pairs = np.unique(np.stack([r.group, r.page]), axis=1)
            (group, of), n = np.unique(np.stack([pairs[0], host[pairs[1]]]), axis=1, return_counts=True)
            run = _hashes(r.names)[r.run[np.searchsorted(r.group, group)]] if len(group) else np.zeros((0, LEAST_RUN), np.uint64)
            own = mix64(run_keys(run) ^ hosts[of].view(np.uint64)).view(np.int64)
            pages = np.bincount(host, minlength=len(hosts))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([hosts, hosts[of]])), pa.concat_arrays([pa.nulls(len(hosts), pa.int64()), pa.array(own)]),
                                              pa.array(np.concatenate([pages, n]).astype(np.int64))], ["host", "run", "n"])


def _windows(tokens: list[str], host: int, known: dict[str, int]) -> np.ndarray:
    """The key of the run at each token of one page that has one."""
    if len(tokens) < LEAST_RUN:
        return np.zeros(0, np.int64)
    new = list({w for w in tokens if w not in known})
    known.update(zip(new, _hashes(new).tolist()))
    own = shingles(np.array([known[w] for w in tokens], np.uint64), LEAST_RUN)
    return mix64(own ^ np.array([host], np.int64).view(np.uint64)).view(np.int64)


def _page_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, 2):
            known: dict[str, int] = {}
            found = [np.unique(_windows(t.split(), h, known)) for h, t in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))),
                                              pa.array(np.concatenate(found))], ["at", "run"])


def _drop_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, 2):
            known: dict[str, int] = {}
            out = []
            for host, text, runs in zip(*[piece.column(k).to_pylist() for k in (1, 2, 3)]):
                tokens = text.split() if runs else []
                out.append(without(text, tokens, np.flatnonzero(np.isin(_windows(tokens, host, known), runs))) if runs else text)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(out, pa.string())], ["row", "text"])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, 1):
            marked, text, around = zip(*[read_page(h) for h in piece.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(marked, pa.bool_()), pa.array(text, pa.string()), pa.array(around, pa.string())],
                                             ["row", "marked", "text", "around"])


def without_boilerplate(pages: DataFrame) -> DataFrame:
    """Pages (rid, row, host, marked, text, around; written) as (row, text), without the runs that stand on ``LEAST_PAGES``
    distinct texts of their host or more and on ``LEAST_SHARE`` of them or more: of unmarked pages in ``text``, of marked ones in
    ``around``. From the text of marked pages they go if they stand in ``LEAST_PAGES`` distinct texts too, and in no more
    than in ``around``."""
    pages = pages.withColumn("host", F.xxhash64("host", "marked"))
    streams = pages.select("host", F.when(F.col("marked"), F.col("around")).otherwise(F.col("text")).alias("text"))
    distinct = streams.groupBy("host", F.md5("text")).agg(F.first("text").alias("text")).select("host", "text")
    runs = distinct.mapInArrow(_count_runs, "host long, run long, n long").groupBy("host", "run").agg(F.sum("n").alias("n"))
    runs = stage(runs.filter(F.col("run").isNull() | (F.col("n") >= LEAST_PAGES)), "runs")
    sizes = runs.filter("run IS NULL").select("host", F.col("n").alias("pages"))
    common = runs.filter("run IS NOT NULL").join(sizes, "host").filter(F.col("n") >= LEAST_SHARE * F.col("pages"))
    common = checked_broadcast(stage(common.groupBy("run").agg(F.max("n").alias("n")), "boilerplate"), 24)

    def found(of: DataFrame) -> DataFrame:
        texts = of.select(F.struct("rid", F.xxhash64("text").alias("print")).alias("at"), "host", "text")
        return texts.mapInArrow(_page_runs, "at struct<rid: long, print: long>, run long").join(common, "run").select("at.*", "run", "n")

    inside = stage(found(pages.filter("marked")), "article-runs")
    repeated = inside.groupBy("run", "n").agg(F.count_distinct("print").alias("texts")).filter((F.col("texts") >= LEAST_PAGES) & (F.col("texts") <= F.col("n")))
    inside = inside.join(checked_broadcast(stage(repeated.select("run"), "article-boilerplate"), 16), "run", "left_semi")
    gone = found(pages.filter("NOT marked")).select("rid", "run").unionByName(inside.select("rid", "run"))
    gone = stage(gone.groupBy("rid").agg(F.collect_list("run").alias("runs")), "page-runs")
    named = pages.join(checked_broadcast(gone, 8 * F.size("runs") + 32), "rid", "left").select("row", "host", "text", "runs")
    return named.mapInArrow(_drop_runs, f"row {pages.schema['row'].dataType.simpleString()}, text string")


def extract_text(pages: DataFrame, keep: list[str] | None = None, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """The columns ``keep`` (all by default) with ``text`` and ``n_chars`` (code points) of each whole page; an input
    column of such a name is replaced.

    Character references are decoded, white space inside a block is one space, blocks are joined by one space in page
    order. A null, empty or text-free page gives an empty text. Pages are compared with all others of their host (those
    with a null URL or one without a host with each other; equal texts count once), the unmarked and the marked ones by
    themselves: a run goes if it stands on ``LEAST_PAGES`` texts and on ``LEAST_SHARE`` of the host's texts or more, from a marked
    article only if both the articles and what is around them repeat it. Repeated rows each give a row; an empty table
    stays empty.
    """
    small_batches(pages.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or pages.columns)]).alias("row")
    df = pages.select(F.struct(row, host_of(F.col(f"`{url_col}`")).alias("host")).alias("row"), F.col(f"`{html_col}`").alias("html"))
    schema = f"row {df.schema['row'].dataType.simpleString()}, marked boolean, text string, around string"
    parsed = df.mapInArrow(_parse, schema).select(F.monotonically_increasing_id().alias("rid"), "row.row", "row.host", "marked", "text", "around")
    out = without_boilerplate(stage(parsed, "articles"))
    return with_results(out.withColumn("n_chars", F.length("text").cast("long")), "row", ["text", "n_chars"])
