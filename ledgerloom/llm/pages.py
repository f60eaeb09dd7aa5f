"""Main text of HTML pages by two passes over blocks.

The first pass classifies each block by stop-word density, length and link density; blocks inside page furniture (menus,
forms, notices and the like, by element or by class and id) are never text, but a wrapper that holds an article is layout
and not furniture, whatever its class says.  In the second pass short and undecided blocks take the label of their nearest
decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LENGTH_LOW, LENGTH_HIGH = 70, 200
STOP_LOW, STOP_HIGH = 0.20, 0.28
MAX_LINK_DENSITY = 0.2

#: Frequent function words of the languages at hand.
STOP_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there
would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two
de la le les et des en un une du que qui dans est pour pas au sur se plus par avec son il sont ce ou ne aux elle mais nous cette
der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch
el los las y del que en por con para una su al lo como más pero sus este ya o fue ha sí porque esta entre cuando muy sin sobre ser también
""".split())

_RAW = r"script|style|noscript|template|svg|math|iframe|object|canvas|select|textarea|title"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(?:svg|math|canvas|object)(?![\w:-])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*(?<=/)>|<({_RAW})(?![\w:-])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z|(?=<))", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Other people's texts and teasers: an article in there is none of the page's own.
_FOREIGN = re.compile(r"ad|ads|advert[a-z]*|sponsor[a-z]*|promo[a-z]*|related|recommend[a-z]*|comments?|disqus|replies")
_FURNITURE = re.compile(rf"{_FOREIGN.pattern}|banner|menu|nav[a-z]*|breadcrumbs?|sidebar|aside|footer|foot|header|masthead|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|"
                        r"share|sharing|social|login|signup|search|pagination|pager|widget|copyright|legal|disclaimer|complementary|contentinfo")
#: Parts of a name that say where or in what form the furniture stands; any other part makes it a name of something else.
_NEUTRAL = frozenset("area bar block bottom box button buttons column container form global group icons inner item items left links list main outer page panel primary right "
                     "secondary section site slot top unit wrap wrapper".split())
_LETTERS = re.compile(r"[a-z]+")
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr".split())
_BARE = frozenset("nav header footer aside form button menu dialog fieldset head input option noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SPACES = re.compile(r"[\s ]+")
_WORDS = re.compile(r"\w+")


@dataclass
class Wrapper:
    """An element that is furniture by class or id alone, or a form, until it turns out to hold an article."""
    foreign: bool
    holds: bool = False


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    bare: bool = False
    wrappers: list[Wrapper] = field(default_factory=list)
    heading: bool = False
    inside: bool = False
    text: str = ""

    @property
    def furniture(self) -> bool:
        """Holds once the whole page was read."""
        return self.bare or any(not w.holds for w in self.wrappers)


def _named(marks: str) -> Wrapper | None:
    """Furniture by a whole class, id or role: each part of it is a furniture word or says where that stands."""
    parts = [found for mark in marks.lower().split() if (found := _LETTERS.findall(mark)) and all(len(x) == 1 or x in _NEUTRAL or _FURNITURE.fullmatch(x) for x in found)]
    names = [x for found in parts for x in found if _FURNITURE.fullmatch(x)]
    return Wrapper(any(_FOREIGN.fullmatch(x) for x in names)) if names else None


def blocks(page: str) -> Iterator[Block]:
    """Text blocks in page order; references are decoded and white space is one space."""
    block, stack, links = Block(), [], 0
    wrappers: list[Wrapper] = []
    bad = inside = 0

    def closed() -> Block | None:
        block.text = _SPACES.sub(" ", html.unescape("".join(block.parts))).strip()
        return block if block.text else None

    def add(text: str) -> None:
        if text:
            block.parts.append(text)
            block.bare |= bad > 0
            block.wrappers += wrappers
            block.inside |= inside > 0
            if links:
                block.linked += len(_SPACES.sub(" ", text).strip())

    at = 0
    for token in _TOKEN.finditer(page):
        add(page[at:token.start()])
        at = token.end()
        name = (token[3] or "").lower()
        if not name:
            continue
        if name in _INLINE:
            if name == "a":
                links = 0 if token[2] else 1
            elif name == "br":
                block.parts.append(" ")
            continue
        if (done := closed()) is not None:
            yield done
        block, links = Block(), 0
        if token[2]:
            if any(entry[0] == name for entry in stack):
                while stack:
                    old, was_bad, was_inside, was_wrapper = stack.pop()
                    bad, inside = bad - was_bad, inside - was_inside
                    if was_wrapper:
                        wrappers.pop()
                    if old == name:
                        break
        elif name not in _VOID and not token[4].rstrip().endswith("/"):
            if name in ("p", "li", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == name:
                _, was_bad, was_inside, was_wrapper = stack.pop()
                bad, inside = bad - was_bad, inside - was_inside
                if was_wrapper:
                    wrappers.pop()
            marks = " ".join(a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(token[4])) if token[4] else ""
            own = name in ("article", "main")
            # a header within an article holds its heading
            is_bad = name in _BARE and name != "form" and not (name == "header" and inside)
            wrapper = Wrapper(False) if name == "form" else _named(marks) if marks and not own and name not in ("html", "body") else None
            if wrapper:
                wrappers.append(wrapper)
            if name == "main" or own and not any(w.foreign for w in wrappers):
                for w in wrappers:
                    w.holds = True
            stack.append((name, int(is_bad), int(own), bool(wrapper)))
            bad, inside = bad + int(is_bad), inside + int(own)
        block.heading = bool(re.fullmatch("h[1-6]", name)) and not token[2]
    add(page[at:])
    if (done := closed()) is not None:
        yield done


def first_label(block: Block) -> str:
    """good, bad, near (good if a good one is around) or short, without regard to the neighbours."""
    if block.furniture:
        return "bad"
    words = [w.lower() for w in _WORDS.findall(block.text)]
    if not words:
        return "short"
    if block.linked > MAX_LINK_DENSITY * len(block.text):
        return "bad"
    stop = sum(w in STOP_WORDS for w in words) / len(words)
    if len(block.text) < LENGTH_LOW:
        return "short"
    if stop >= STOP_HIGH:
        return "good" if len(block.text) > LENGTH_HIGH else "near"
    if stop >= STOP_LOW:
        return "near"
    return "near" if block.inside else "bad"


def main_text(page: str | None) -> str:
    """Text blocks joined by line feeds.

    Undecided blocks take the label of the nearest decided block on both sides: bad only if both are bad, and between two
    different ones what the element says (inside an article or main element they are text).  Where nothing is decided as
    good, the undecided blocks inside an article stand, or else all undecided ones.
    """
    found = list(blocks(page or ""))
    labels = [first_label(b) for b in found]
    decided = [i for i, x in enumerate(labels) if x in ("good", "bad") and not found[i].furniture]
    out = []
    before = None
    following = iter([*decided, None])
    after = next(following)
    for i, block in enumerate(found):
        while after is not None and after < i:
            before, after = after, next(following)
        label = labels[i]
        if label in ("near", "short"):
            sides = {labels[j] for j in (before, after) if j is not None}
            if block.inside:
                label = "bad" if sides == {"bad"} and label == "short" and not block.heading and block.linked else "good"
            elif sides == {"good"}:
                label = "good"
            elif not sides or sides == {"bad"}:
                label = "good" if not sides and not any(b.inside for b in found) else "bad"
            else:
                label = "good" if label == "near" or block.heading else "bad"
        if label == "good":
            out.append(block.text)
    return "\n".join(out)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All other columns and ``text``, ``n_chars``.  Null or empty html gives an empty text; rows are handled one by one."""
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(h.as_py()) for h in batch.column("_html")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=[*kept, "text", "n_chars"])

    types = dict(pages.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "text string, n_chars long"])
    return pages.select(*kept, F.col(html_col).alias("_html")).mapInArrow(run, schema)
