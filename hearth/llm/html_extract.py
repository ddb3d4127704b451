"""Main text of web pages by nearest-URL differencing (operator 1).

Pages are sorted by (host, path), so that the page with the nearest URL path of the
same host is a neighbour.  Each page becomes lines (blocks of text); the lines of a
page and of its neighbour are aligned by longest common subsequence and the shared
ones, the host's furniture, are deleted.

Differencing alone cannot give right results: pages that carry copies of one article
share the article too, and the only page of a host shares nothing.  An exact check on
the markup therefore follows, line by line: shared lines inside an article (article or
a container named as one) come back, and lines of elements that are furniture by their
tag, role or class go, shared or not.  main and containers named as content may hold
the host's furniture: there, and in unnamed containers, the differencing decides.  A class or id names
furniture as a whole, or joined only with words of place and shape ("site-header"),
not by any part ("has-sidebar"); an article or main inside such an element is content.

The sort is a range partitioning on (host, path, page_id): a host with a third of all
pages spreads over many tasks, and a task reads its pages one by one, holding three.
The first and last page of a task have one neighbour instead of two.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed lists of HTML names.
BLOCKS = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol
    optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas audio video textarea title noembed noframes xmp".split())
FURNITURE_TAGS = frozenset("nav footer aside form button select menu dialog head search fieldset".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
FURNITURE_WORDS = frozenset("""ad ads advert advertisement advertising adverts adbox adslot banner breadcrumb breadcrumbs comment comments
    consent cookie cookies copyright disqus footer form gdpr header login masthead menu menubar modal nav navbar navigation
    newsletter notice notices overlay pager pagination popup promo promotion related replies reply search share sharing
    sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget""".split())
#: Of these, words that name parts of a text as well: they count on containers, not on text elements.
SOFT_WORDS = frozenset("""banner comment footer form header login menu notice notices overlay related replies reply search share sharing
    signup skip social toolbar widget""".split())
COMMENT_WORDS = frozenset("comment comments disqus replies reply".split())
ARTICLE_WORDS = frozenset("article entry post story".split())
CONTENT_WORDS = ARTICLE_WORDS | {"content", "main"}
#: Words of place and shape: beside them another word names the element.
NEUTRAL_WORDS = frozenset("""area bar block body bottom box button buttons column container center desktop global group icon icons inner item items left
    links list main mobile module outer page panel posts primary right row secondary section single site slot text top unit wrap wrapper""".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dl dt dd span a b i em strong".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# possessive throughout, and attributes are tried at the start of a name only: time linear in what is read
_TAG = re.compile(r"""</?[a-zA-Z][^\s/>]*+(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""(?<![^\s=/>"'])([^\s=/>"']++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")
#: Elements that a start tag of these closes.
_CLOSED_BY = {"p": frozenset(("p",)), "li": frozenset(("li",)), "option": frozenset(("option",)),
              "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")),
              "td": frozenset(("td", "th")), "th": frozenset(("td", "th"))}

#: States of an element, handed down to what is inside: furniture, furniture by its name (by a soft word only), content, article.
FURNITURE, NAMED, SOFT, CONTENT, ARTICLE = 1, 2, 4, 8, 16


def _named(token: str) -> tuple[int, set[str]]:
    """State that a whole class or id says, and its furniture words."""
    parts = {w.lower() for w in _PARTS.findall(token) if len(w) > 1 and not w.isdigit()}
    bad = parts & FURNITURE_WORDS
    if bad:
        if parts - bad - NEUTRAL_WORDS - CONTENT_WORDS or bad == {"header"} and parts & ARTICLE_WORDS:
            return 0, set()  # "has-sidebar" is a state, "post-header" a part of the text
        return (SOFT if bad <= SOFT_WORDS else NAMED), bad
    if parts & CONTENT_WORDS and not parts - CONTENT_WORDS - NEUTRAL_WORDS:
        return (ARTICLE if parts & ARTICLE_WORDS else CONTENT), bad
    return 0, set()


def _state(tag: str, raw: str, state: int) -> int:
    """State inside an element that opens within ``state``."""
    if tag in FURNITURE_TAGS:
        return state | FURNITURE
    attrs = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw, len(tag) + 1)} if "=" in raw else {}
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return state | FURNITURE
    in_content = state & (CONTENT | ARTICLE)
    role = attrs.get("role", "").lower()
    if tag == "header" and not in_content or role in FURNITURE_ROLES:
        return state | FURNITURE
    said, bad = 0, set()
    for token in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        kind, words = _named(token)
        if words == {"header"} and in_content:
            continue  # the head of the text
        said, bad = said | kind, bad | words
    whole = tag in ("article", "main") or role in ("main", "article")
    if tag in ("html", "body") or tag in HEADINGS and in_content:
        said = 0
    if tag in TEXT_TAGS or said & (CONTENT | ARTICLE) and not said & NAMED:
        said &= ~SOFT
    if said & (NAMED | SOFT):
        # articles among comments are comments
        return state | (FURNITURE if bad & COMMENT_WORDS and tag not in TEXT_TAGS else NAMED if said & NAMED else SOFT)
    if whole:
        return state & ~(NAMED | SOFT) | (ARTICLE if "article" in (tag, role) else CONTENT)
    if tag in ("div", "section", "td") and said:
        return state & ~SOFT | said
    return state


def _ends(source: str) -> tuple[list[int], list[int]]:
    """Places of all quotes and closing angles, and for each the end of a tag whose inside it is the next of (-1: none)."""
    at = [m.start() for m in re.finditer("[>\"']", source)]
    end = [-1] * (len(at) + 1)
    following = {'"': len(at), "'": len(at)}  # the next quote of each kind
    for k in range(len(at) - 1, -1, -1):
        c = source[at[k]]
        if c == ">":
            end[k] = at[k] + 1
        else:
            close = following[c]
            end[k] = end[close + 1] if close < len(at) else -1
            following[c] = k
    return at, end


def tokens(source: str) -> Generator[tuple[int, int], int, None]:
    """(start, end) of every comment, declaration and tag, in order; what begins like one and never ends is text.

    Linear in the page: a tag that cannot be read at once is looked up in a table made in one pass.
    """
    at, n = 0, len(source)
    last = source.rfind(">")
    table: tuple[list[int], list[int]] | None = None
    while True:
        at = source.find("<" if at <= last else "<!--", at)
        if at < 0:
            return
        after = source[at + 1:at + 2]
        end = -1
        if source.startswith("<!--", at):
            close = source.find("-->", at + 4)
            end = n if close < 0 else close + 3
        elif at > last:
            pass
        elif after in ("!", "?"):
            end = source.find(">", at + 2) + 1 or -1
        elif name := _NAME.match(source, at):
            if table is None:
                whole = _TAG.match(source, at)
                end = whole.end() if whole else -1
                if not whole:
                    table = _ends(source)
            else:
                k = bisect_left(table[0], name.end())
                end = table[1][k]
        if end < 0:
            at += 1
            continue
        got = yield at, end
        at = end if got is None else got


def _send(found: Generator[tuple[int, int], int, None], at: int) -> tuple[int, int] | None:
    """The next token from ``at`` on."""
    try:
        return found.send(at)
    except StopIteration:
        return None


def page_lines(source: str) -> list[tuple[str, bool, bool]]:
    """(text, in furniture, in an article) of every block of a page, in page order."""
    out: list[tuple[str, bool, bool]] = []
    open_: list[tuple[str, int]] = [("", 0)]  # tags and the states inside them
    n_open: Counter[str] = Counter()
    text: list[str] = []

    def flush() -> None:
        line = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if line:
            state = open_[-1][1]
            out.append((line, state & (FURNITURE | NAMED | SOFT) > 0, state & ARTICLE > 0))

    at, n = 0, len(source)
    last = source.rfind(">")
    found = tokens(source)
    token = next(found, None)
    while token is not None:
        start, end = token
        text.append(source[at:start])
        at = end
        raw = source[start:end]
        token = None
        if raw[1] not in "!?":
            tag = _NAME.match(raw)[1].lower()
            if tag in BLOCKS:
                flush()
            if raw[1] == "/":
                if n_open[tag]:
                    while open_[-1][0] != tag:
                        n_open[open_.pop()[0]] -= 1
                    n_open[open_.pop()[0]] -= 1
            elif tag in RAW and not raw.endswith("/>"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at) if at <= last else None
                at = close.end() if close else n
                token = _send(found, at)
                if token is None:
                    break
                continue
            elif tag not in VOID and not raw.endswith("/>"):
                ends = _CLOSED_BY.get(tag)
                if ends and open_[-1][0] in ends:
                    n_open[open_.pop()[0]] -= 1
                open_.append((tag, _state(tag, raw, open_[-1][1])))
                n_open[tag] += 1
        token = next(found, None)
    text.append(source[at:])
    flush()
    return out


#: Rows of the alignment's dynamic program are kept where they take this many bits at most; longer pages are halved first.
ALIGN_BITS = 1 << 26


def _row(x: list[str], y: list[str]) -> list[int]:
    """Rows of the dynamic program of ``x`` (down) and ``y``, one integer each: zeros among the low j bits count."""
    places: dict[str, int] = {}
    for j, line in enumerate(y):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows, v = [full], full
    keep = len(x) * len(y) <= ALIGN_BITS
    for line in x:
        u = v & places.get(line, 0)
        v = ((v + u) | (v - u)) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def _lengths(row: int, n: int) -> np.ndarray:
    """Length of the common subsequence with each prefix, from none to all ``n`` lines."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of the lines on a longest common subsequence with ``b``.

    Bit-parallel: one row of the dynamic program is one integer.  Rows are kept to walk back; where they
    would take more than ``ALIGN_BITS``, ``a`` is halved where the two halves' subsequences add up to the longest.
    """
    out: set[int] = set()
    work = [(0, len(a), 0, len(b))]
    while work:
        lo, hi, down, up = work.pop()
        while lo < hi and down < up and a[lo] == b[down]:
            out.add(lo)
            lo, down = lo + 1, down + 1
        while lo < hi and down < up and a[hi - 1] == b[up - 1]:
            hi, up = hi - 1, up - 1
            out.add(hi)
        x, y = a[lo:hi], b[down:up]
        if not x or not y:
            continue
        if len(x) > 1 and len(x) * len(y) > ALIGN_BITS:
            mid, n = len(x) // 2, len(y)
            head = _lengths(_row(x[:mid], y)[-1], n)
            tail = _lengths(_row(x[mid:][::-1], y[::-1])[-1], n)
            cut = int(np.argmax(head + tail[::-1]))
            work += [(lo, lo + mid, down, down + cut), (lo + mid, hi, down + cut, up)]
            continue
        rows = _row(x, y)
        i, j = len(x), len(y)
        if len(rows) == 1:  # one line against very many
            if x[0] in set(y):
                out.add(lo)
            continue

        def length(i: int, j: int) -> int:  # zeros among the low j bits
            return j - (rows[i] & ((1 << j) - 1)).bit_count()

        while i and j:
            if x[i - 1] == y[j - 1]:
                out.add(lo + i - 1)
                i, j = i - 1, j - 1
            elif length(i - 1, j) >= length(i, j - 1):
                i -= 1
            else:
                j -= 1
    return out


def main_text(lines: list[tuple[str, bool, bool]], near: list[tuple[str, bool, bool]] | None,
              gone: set[int] | None = None) -> str:
    """The page's own lines: those that ``near`` does not share (``gone``, if known), then the check on the markup."""
    if gone is None:
        gone = shared_lines([x[0] for x in lines], [x[0] for x in near]) if near else set()
    kept = []
    for i, (line, furniture, article) in enumerate(lines):
        # an article is whole though its copies share it
        if (i not in gone or article) and not furniture:
            kept.append(line)
    return "\n".join(kept)


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_shared) of every row of ``pages``.

    Null html is empty; a page without main text has empty text.  Null URLs have no
    host and no neighbour.  Repeated rows are pages of their own.  n_shared is the
    number of lines shared with the nearest page.
    """
    rest = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    # numbers in a path compare by size, so that /9 and /10 are near
    keyed = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host.alias("host"), path.alias("path"))
    dealt = keyed.repartitionByRange("host", "path", "page_id").sortWithinPartitions("host", "path", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pages_in() -> Iterator[tuple]:
            for batch in batches:
                for i in range(0, batch.num_rows, 100):
                    for r in batch.slice(i, 100).to_pylist():
                        yield r["page_id"], r["url"], r["host"], r["path"], page_lines(r["html"] or "")

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [()] * 5
            kinds = (pages_type, pa.string(), pa.string(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)],
                                   names=["page_id", "url", "text", "n_chars", "n_shared"])

        def result(page: tuple, before: tuple | None, after: tuple | None) -> tuple:
            pid, url, h, p, lines = page
            near = [x for x in (before, after) if x is not None and h and x[2] == h]
            other = max(near, key=lambda x: _common(p, x[3]))[4] if near else None  # the earlier one if both are as near
            gone = shared_lines([x[0] for x in lines], [x[0] for x in other]) if other else set()
            text = main_text(lines, other, gone)
            return pid, url, text, len(text), len(gone)

        out: list[tuple] = []
        before = page = None
        for after in pages_in():
            if page is not None:
                out.append(result(page, before, after))
                if len(out) >= 500:
                    yield batch_of(out)
                    out = []
            before, page = page, after
        if page is not None:
            out.append(result(page, before, None))
        yield batch_of(out)

    pages_type = pa.int64()
    return dealt.withColumn("page_id", F.col("page_id").cast("long")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_shared long")
