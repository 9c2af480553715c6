"""Main text of web pages as the best-scoring contiguous run of words and tags.

A page is a sequence of words and tags.  Each has a weight, the log-odds of lying inside
the main content, learned from pages that mark their content (a single article or main
element): plain words come out positive; tags, and words in links or in menus, adverts,
forms and the like, negative.  One linear scan finds the run of the largest sum.  The text
of that run is the result, without the parts inside it that are boilerplate by name.
Inside marked content links weigh as much as words, and tags and boilerplate nothing, so
none of them cuts the run.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tidemark.llm.batches import annotate

SAMPLE_PAGES = 5000
MAX_CLASSES = 2000

# Elements by their role, and words of class, id and role attributes that mark boilerplate.
RAW = "script style textarea".split()
RAW_UNLESS_EMPTY = "iframe noscript".split()
EMBEDDED = "template object svg math canvas select audio video".split()
BOILERPLATE = "head nav footer aside form button menu dialog label fieldset datalist".split()
BLOCKS = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody tfoot thead "
    "title tr ul"
).split()
SPACING = ["br", "td", "th", "wbr", *EMBEDDED]
VOID = "area base br col embed hr img input link meta param source track wbr".split()
SIGNS = (
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus disclaimer footer gdpr login masthead menu modal nav navbar navigation newsletter "
    "notice notification overlay pager pagination popup promo promoted promotion recommended related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar "
    "topbar widget alert complementary contentinfo"
).split()
# Words that add nothing to a sign: "share-bar" is a sign, "related-work" is not.
PLAIN = (
    "area bar bars block blocks body bottom box boxes btn button buttons card cards center col column container content "
    "count cta feed fixed float form frame grid group head icon icons id inline inner item items large left link links "
    "list message module outer panel placeholder post posts right row section size slot small space stories story strip "
    "text thread title top unit wrap wrapper zone"
).split()
PROSE = ("p", "h1")  # a link in one of these is text
HEADINGS = ("header", "banner", "masthead", "topbar")  # boilerplate unless inside the marked content

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<held>" + "|".join(RAW_UNLESS_EMPTY) + r")\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*(?<!/)>.*?(?:</(?P=held)\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_PARTS = re.compile(r"[a-z]+|[0-9]+")
_BOILERPLATE, _BLOCKS, _SPACING, _VOID, _SIGNS = map(frozenset, (BOILERPLATE + EMBEDDED, BLOCKS, SPACING, VOID, SIGNS))
_WHOLE = _SIGNS | set(PLAIN) | {"header"}
_MARKS = ("article", "main")
_HIDDEN = " hidden"  # no word of an attribute


@dataclass(frozen=True)
class Weights:
    """Weight by class of token; ``outside`` is that of a word beside the marked content."""

    of: dict[str, float]
    outside: float = -4.0


#: Used where no page marks its content.
DEFAULT = Weights({"word": 3.0, "link": -1.0, "boiler": -2.0, "tag": -0.5})


@dataclass
class Token:
    kind: str  # "text", "block" (an end of a block), "space" or "tag"
    text: str
    name: str  # class of the token, for its weight
    words: int
    boiler: bool
    marked: bool
    within: bool  # in a marked element, or in an aside in one


def _signs(attrs: str, whole: bool) -> set[str]:
    """Words of class, id and role; with ``whole`` only of names made of signs and plain words alone."""
    out: set[str] = set()
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            out.add(_HIDDEN)
        elif key in ("class", "id", "role"):
            for name in value.split():
                parts = _PARTS.findall(name)
                if not whole or all(p in _WHOLE or p.isdigit() for p in parts):
                    out.update(parts)
    return out


def tokens(page: str) -> list[Token]:
    """The page in order.  Elements left open end with the element around them.

    Sign words say nothing about an element around more than half of the words of the
    marked content or, on a page without, of all words.
    """
    out, signed = _tokens(page, frozenset())
    inner = [0]
    every = [0]
    for t in out:
        inner.append(inner[-1] + t.words * t.marked)
        every.append(every[-1] + t.words)
    sums = inner if inner[-1] else every
    spared = frozenset(
        place for place, first, last, marked in signed
        if not (marked and inner[-1]) and 2 * (sums[min(last, len(out))] - sums[first]) > sums[-1]
    )
    return _tokens(page, spared)[0] if spared else out


def _tokens(page: str, spared: frozenset[int]) -> tuple[list[Token], list[tuple[int, int, int, bool]]]:
    """Tokens, and place, first and last token and mark of elements with sign words; those of ``spared`` places count as without."""
    out: list[Token] = []
    signed: list[tuple[int, int, int, bool]] = []
    open_signs: list[tuple[int, int, int, bool]] = []  # depth, place, first token, marked
    stack: list[tuple[str, bool, bool, bool, bool, bool]] = []  # name, boilerplate, link, marked, within, prose
    opened: Counter[str] = Counter()  # names in the stack
    boiler = link = marked = within = prose = False
    at = 0

    def close() -> None:
        while open_signs and open_signs[-1][0] > len(stack):
            signed.append((open_signs[-1][1], open_signs[-1][2], len(out), open_signs.pop()[3]))

    def pop() -> str:
        gone = stack.pop()[0]
        opened[gone] -= 1
        return gone

    def text(raw: str) -> None:
        if raw:
            plain = html.unescape(raw)
            kind = "boiler" if boiler else "link" if link and not prose else "word"
            out.append(Token("text", plain, kind, len(plain.split()), boiler, marked, within))

    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        if m["name"] is None:
            if raw := m["raw"] or m["held"]:
                out.append(Token("space", " ", f"<{raw.lower()}", 0, True, marked, within))
            continue
        name = m["name"].lower()
        kind = "block" if name in _BLOCKS else "space" if name in _SPACING else "tag"
        if page[m.start() + 1] == "/":
            if opened[name]:
                while pop() != name:
                    pass
                boiler, link, marked, within, prose = stack[-1][1:] if stack else (False,) * 5
                close()
            out.append(Token(kind, "", f"</{name}", 0, boiler, marked, within))
            continue
        if name == "body":  # whatever the head left open ends here
            stack = [s for s in stack if s[0] == "html"]
            opened = Counter(s[0] for s in stack)
            boiler = link = marked = within = prose = False
            close()
        if name == "p" and stack and stack[-1][0] == "p":
            pop()
            boiler, link, marked, within, prose = stack[-1][1:] if stack else (False,) * 5
            close()
        out.append(Token(kind, "", f"<{name}", 0, boiler, marked, within))
        if name in _VOID or m["attrs"].rstrip().endswith("/"):
            continue
        signs = _signs(m["attrs"], marked) if m["attrs"] else set()
        if signs & (_SIGNS | {"header"}) and name not in ("html", "body", "article", "main"):
            open_signs.append((len(stack) + 1, m.start(), len(out), marked))
            if m.start() in spared:
                signs &= {_HIDDEN}
        inside = marked or name in _MARKS
        odd = name in _BOILERPLATE or _HIDDEN in signs or bool(signs & _SIGNS) or not marked and (name in HEADINGS or "header" in signs)
        if name in ("html", "body", "article", "main"):
            odd = False
        elif marked and odd and signs & set(HEADINGS) and name not in _BOILERPLATE:
            odd = bool((signs & (_SIGNS | {_HIDDEN})) - set(HEADINGS))
        within = within or name in _MARKS
        prose = name in PROSE if name in _BLOCKS else prose
        boiler, link, marked = boiler or odd, link or name == "a", inside and not (name == "aside")
        stack.append((name, boiler, link, marked, within, prose))
        opened[name] += 1
    text(page[at:])
    stack = []
    close()
    return out, signed


def _marked_once(sequence: list[Token]) -> bool:
    opened = Counter(t.name for t in sequence if t.name in ("<article", "<main"))
    return max(opened.values(), default=0) == 1 and any(t.marked and t.words for t in sequence)


def _class(token: Token) -> str:
    return token.name if token.kind == "text" else "tag " + token.name.strip("</")


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside, outside = Counter(), Counter()
    for batch in batches:
        for page in batch.column(0).to_pylist():
            sequence = tokens(page)
            if _marked_once(sequence):
                for t in sequence:
                    where = inside if t.marked and not t.boiler else outside
                    where[_class(t)] += t.words if t.kind == "text" else 1
    names = sorted(inside.keys() | outside.keys())
    counts = [pa.array([c[n] for n in names], pa.int64()) for c in (inside, outside)]
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], names=["name", "inside", "outside"])


def learn(pages: DataFrame, text: str = "html", page_id: str = "page_id", sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from about ``sample_pages`` pages, of which those with one marked content count.

    The sample goes by a hash of the id.  Counts are added by Spark; the driver gets at
    most the ``MAX_CLASSES`` most frequent classes.  Tags stay a little below zero and plain
    words above it; bounds keep a single odd element from cutting a text in two.
    """
    rows = pages.filter(F.col(text).isNotNull())
    total = rows.count()
    place = F.pmod(F.xxhash64(F.col(page_id).cast("string"), F.lit("pages")), F.lit(1 << 30))
    if total > sample_pages:
        rows = rows.filter(place < int(sample_pages / total * (1 << 30)))
    counted = rows.select(F.col(text).cast("string").alias("html")).mapInArrow(
        _count_task, "name string, inside long, outside long"
    )
    summed = counted.groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    found = summed.orderBy((F.col("inside") + F.col("outside")).desc(), "name").limit(MAX_CLASSES).collect()
    words = sum(r["inside"] for r in found if r["name"] == "word")
    if not words:
        return DEFAULT
    weights = dict(DEFAULT.of)
    for r in found:
        odds = math.log((r["inside"] + 1) / (r["outside"] + 1))
        if r["name"] == "word":
            weights["word"] = min(max(odds, 0.2), 3.0)
        elif r["name"] in ("link", "boiler"):
            weights[r["name"]] = min(max(odds, -2.0), -0.2)
        else:
            weights[r["name"]] = min(max(odds, -1.0), -0.05)
    return Weights(weights)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run of the largest sum above zero; the first of equals."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, found = run, (start, i + 1)
    return found


def extract(page: str | None, weights: Weights = DEFAULT) -> str:
    """The main text: blocks in page order joined by two line ends."""
    sequence = tokens(page or "")
    has_mark = any(t.marked and t.words and not t.boiler for t in sequence)
    scores = []
    for t in sequence:
        if t.kind == "text":
            score = weights.of[t.name] * t.words
        else:
            score = weights.of.get(_class(t), weights.of["tag"])
        if has_mark and t.within:
            score = 0.0 if t.boiler or t.kind != "text" else weights.of["word"] * t.words
        elif has_mark:
            score = min(score, weights.outside * max(t.words, 1))
        scores.append(score)
    start, end = best_run(scores)
    blocks: list[str] = []
    held: list[str] = []
    for t in sequence[start:end]:
        if t.kind == "block":
            blocks.append("".join(held))
            held = []
        elif t.kind == "space":
            held.append(" ")
        elif t.kind == "text" and not t.boiler:
            held.append(t.text)
    blocks.append("".join(held))
    return "\n\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


FIELDS = [StructField("text", StringType()), StructField("n_chars", LongType())]


def extract_pages(
    pages: DataFrame, weights: Weights, text: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """The ``keep`` columns with the main text of each whole page and its number of code points.

    A null or empty page, or one without a word of content, has an empty text.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def make():
        held = shared.value

        def work(texts: pa.Array):
            found = [extract(t.as_py(), held) for t in texts]
            return [pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())]

        return work

    return annotate(pages, text, make, FIELDS, keep)


def main_text(pages: DataFrame) -> DataFrame:
    return extract_pages(pages, learn(pages))
