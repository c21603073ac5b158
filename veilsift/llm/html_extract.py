"""Main text of web pages as the maximum-scoring run of page tokens.

A page is a sequence of tags and words. A word scores by its block: the block's element, its length
and its share of links; tags score by name, always below zero. The weights are log odds learnt from
labelled pages, those that mark their article with an element of that name; the mark itself is no
feature, so they hold for pages without one. Where a page has the mark, words inside of it score
above zero and words beside it below. One linear scan finds the contiguous run with the largest
sum. Text of framing elements inside of the run (forms, adverts, comments, ...) is left out, and what
is left is written block by block.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Expected pages of the training sample at most.
TRAIN_PAGES = 4_000
#: Elements whose content is no markup.
RAW = "script|style|textarea|title|xmp|iframe"
ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<({RAW})(?=[\s/>]){ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end tag may be missing: another of the same group ends them.
IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that frame a page, and elements that show no text of it.
FRAMES = frozenset("head nav header footer aside form menu dialog button noscript template svg math object select datalist canvas audio video".split())
#: Of these an end in "/>" ends the element.
FOREIGN = frozenset(("svg", "math"))
ARTICLES = frozenset(("article", "main"))
#: Inside of an article these frame nothing: its own head, and a list.
PARTS = frozenset(("header", "menu"))
#: Parts of a name (in class, id, role or aria-label) that tell a frame if the rest of the name is such parts or layout.
FRAME_PARTS = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|nav|navbar|navigation|breadcrumbs?|masthead|cookies?|consent|gdpr|popup|modal|"
    r"newsletter|pagination|pager|toolbar|complementary|contentinfo|disqus|commentlist)\Z"
)
#: Words that could as well be what a text is about; inside of an article they tell a frame the same way.
FRAME_ALONE = re.compile(
    r"(?:side|widgets?|menu|footer|header|notices?|overlay|subscribe|subscription|signup|login|search|shar(?:e|ing)|social|related|recommend\w*|copyright|legal|"
    r"disclaimer)\Z"
)
#: Parts that tell readers' comments if the rest of the name says no more than LAYOUT_PARTS.
COMMENT_PARTS = re.compile(r"(?:comments?|commentlist|disqus|replies|reply|respond|discussion)\Z")
LAYOUT_PARTS = re.compile(
    r"(?:box|list|links?|block|area|section|container|wrap|wrapper|inner|outer|bar|column|col|row|left|right|top|bottom|main|site|page|global|primary|"
    r"secondary|slots?|units?|zones?|placements?|leaderboard|skyscraper|rectangle|mpu|spaces?|panels?|strips?|modules?|components?|boxes|rail|holder|labels?|"
    r"messages?|banners?|bars|forms?|dialogs?|images?|img|text|desktop|mobile|sticky|fixed|floating|inline|above|below|after|before|middle|center|centre|"
    r"large|small|big|wide|slim|dark|light|active|open|closed|hide|show|visible|js|posts?|articles?|entry|entries|items?|content|body|form|button|buttons|icons?|thread|author|meta|title|heading|text|reader|readers|user|users|"
    r"and|the|\d+)\Z"
)
#: Inside of an article these are parts of it.
HEADS = frozenset(("header", "masthead"))
#: Inside of an article the id of such an element is the mark of its heading, so it names a topic.
TOPICS = frozenset("section h1 h2 h3 h4 h5 h6 p dt dd li figure table blockquote pre a span".split())
#: Names of a layout that has a part are no part.
LAYOUT = re.compile(r"\b(?:with|has|no|without|is)[-_]\S+", re.I)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Scores of a word by feature of its block, where no labelled page shows it.
PRIOR = {
    ("block", "p"): 0.8, ("block", "pre"): 0.8, ("block", "blockquote"): 0.8, ("length", "1-3"): -0.5, ("length", "4-9"): 0.0, ("length", "10+"): 0.6,
    ("link", "most"): -1.5, ("link", "few"): 0.3, **{("block", f"h{i}"): 0.8 for i in range(1, 7)},
}
#: A feature's weight is this at most, either way.
LIMIT = 1.5
#: What a word has besides: on a page without a mark, inside of the mark, beside it; and what it has there at least or at most.
PLAIN, MARKED, LEAST = 0.6, 2.0, 0.2
TAG_PRIOR, TAG_MOST, TAG_LEAST = -0.3, -0.05, -1.0
#: What one framing element, which is left out of the text anyway, can cost a run at most.
FRAME_MOST, LITTLE = 1.5, 0.001


def frame_of(attributes: str, inside: bool, element: str = "div") -> int:
    """2: what has these attributes is hidden or holds readers' comments; 1: its name frames; 0: neither.

    A name frames by all its parts: one that says what the text is about ("sponsor-interview") is no frame.
    """
    given = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or UNSEEN.search(given.get("style", "")):
        return 2
    found = 0
    for key in ("class", "id", "role", "aria-label"):
        if key == "id" and inside and element in TOPICS:
            continue
        for name in LAYOUT.sub(" ", given.get(key, "")).split():
            parts = [x for x in re.split(r"[\W_]+", CAMEL.sub("-", name).lower()) if x]
            rest = [x for x in parts if not LAYOUT_PARTS.match(x)]
            if rest and all(COMMENT_PARTS.match(x) for x in rest):
                return 2
            if inside:
                parts, rest = ([x for x in y if x not in HEADS] for y in (parts, rest))
            if any(FRAME_PARTS.match(x) for x in parts) or rest:
                if all(FRAME_PARTS.match(x) or FRAME_ALONE.match(x) or COMMENT_PARTS.match(x) for x in rest):
                    found = 1
    return found


def tokens(page: str | None, by_name: bool = True) -> list[tuple]:
    """(kind, value, place, block element, in a link) of a page: kind "tag" with a name, or "text" with raw text.

    Elements frame by tag, hidden, or as readers' comments, and with ``by_name`` by class, id or role. A wrapper that
    frames by name gives way to an article or main element in it, unless its name speaks of readers' comments.
    """
    out = []
    # name, frame (1 by name, 2 for good), in an article, name of the block, its place in the stack (-1: none), links open
    stack: list[tuple[str, int, bool, str, int, int]] = []
    none = ("", 0, False, "", -1, 0)
    opened: Counter[str] = Counter()

    def cut(at: int) -> None:
        for name, *_ in stack[at:]:
            opened[name] -= 1
        del stack[at:]

    for m in TOKEN.finditer(page or ""):
        name = m[3]
        above = stack[-1] if stack else none
        frame = "frame" if above[1] else None
        if name is None:
            t = m[0]
            if m[1] is not None:
                out.append(("tag", m[1].lower(), frame, "", False))
            elif t[:2] not in ("<!", "<?"):
                out.append(("text", t, frame or ("article" if above[2] else "out"), above[3], above[5] > 0))
            continue
        name = name.lower()
        if m[2]:
            if opened[name]:  # a stray end tag ends nothing
                at = len(stack) - 1
                while stack[at][0] != name:
                    at -= 1
                cut(at)
        elif not m[0].endswith(">"):
            continue  # a page that is cut inside of a tag
        elif name not in VOID and not (m[4].endswith("/") and name in FOREIGN):
            ends = IMPLIED.get(name)
            if ends and stack and above[0] in ends:
                cut(len(stack) - 1)
            elif name in BLOCKS and name != "p" and above[3] == "p":
                cut(above[4])
            above = stack[-1] if stack else none
            inside = above[2] or name in ARTICLES
            found = above[1]
            if name in FRAMES and not (name in PARTS and inside):
                found = 2
            if m[4] and found < 2 and name not in ("html", "body"):
                said = frame_of(m[4], inside, name)
                if said == 2 or (said and by_name and name not in ARTICLES):
                    found = said
            if name in ARTICLES and found == 1:
                found = 0
            block = (name, len(stack)) if name in BLOCKS else above[3:5]
            stack.append((name, found, inside, *block, above[5] + (name == "a")))
            opened[name] += 1
        out.append(("tag", ("/" if m[2] else "") + name, "frame" if stack and stack[-1][1] else None, "", False))
    return out


def features(found: list[tuple]) -> list[tuple | None]:
    """For each text token its words and its block's features; None for tags."""
    out: list[tuple | None] = [None] * len(found)
    at, words, linked = [], 0, 0

    def close():
        length = ("length", "1-3" if words < 4 else "4-9" if words < 10 else "10+")
        link = ("link", "most" if 2 * linked > words else "few")
        for i, n in at:
            out[i] = (n, (("block", found[i][3]), length, link))

    for i, (kind, value, _, _, link) in enumerate(found):
        if kind == "text":
            n = len(value.split())
            at.append((i, n))
            words += n
            linked += n * link
        elif value.lstrip("/") in BLOCKS:
            close()
            at, words, linked = [], 0, 0
    close()
    return out


def learn(pages) -> tuple[Counter, Counter]:
    """Counts inside and outside of the marked article: of words by feature, of tags by name, of all words."""
    inside, outside = Counter(), Counter()
    for page in pages:
        found = tokens(page)
        if not any(k == "tag" and v == "article" for k, v, *_ in found):
            continue
        depth = 0
        for (kind, value, place, *_), feature in zip(found, features(found), strict=True):
            if kind == "tag":
                name = value.lstrip("/")
                if name == "article":
                    depth = max(0, depth + (1 if value == name else -1))
                elif name in BLOCKS or name in VOID or name in ("a", "b", "i", "em", "strong", "span", "u", "small", "code"):
                    (inside if depth else outside)["tag", name] += 1
                continue
            if depth and place == "frame":
                continue  # what frames inside of an article is neither
            to = inside if depth else outside
            to["words", ""] += feature[0]
            for key in feature[1]:
                to[key] += feature[0]
    return inside, outside


def weights(inside: Counter, outside: Counter) -> dict[tuple[str, str], float]:
    """Log odds of lying in the article against those of all words; tags stay below zero."""
    n_in, n_out = (max(1, c["words", ""]) for c in (inside, outside))
    out = dict(PRIOR)
    for key in {*inside, *outside} - {("words", "")}:
        odds = math.log((inside[key] + 0.5) / (outside[key] + 0.5) * n_out / n_in)
        low, high = (TAG_LEAST, TAG_MOST) if key[0] == "tag" else (-LIMIT, LIMIT)
        out[key] = max(low, min(high, odds))
    return out


def gains(found: list[tuple], score: dict[tuple[str, str], float]) -> list[float]:
    """What each token adds to a run; a framing element costs FRAME_MOST at most, all told.

    From the first marked word to the last, tags, framing elements and words without a mark cost next to nothing.
    """
    inside = [i for i, (k, v, p, *_) in enumerate(found) if k == "text" and p == "article" and v.strip()]
    marked = bool(inside)
    out, framed = [], FRAME_MOST
    for (kind, value, place, *_), feature in zip(found, features(found), strict=True):
        if kind == "tag":
            gain = score.get(("tag", value.lstrip("/")), TAG_PRIOR)
        else:
            word = sum(score.get(key, 0.0) for key in feature[1])
            if place == "article":
                word = max(LEAST, word + MARKED)
            else:
                word = min(-LEAST, word - MARKED) if marked or place == "frame" else word + PLAIN
            gain = word * feature[0]
        if place == "frame":
            gain = max(gain, -framed)
            framed += gain
        else:
            framed = FRAME_MOST
        out.append(gain)
    for i in range(inside[0], inside[-1]) if marked else ():
        if found[i][0] == "tag" or found[i][2] != "article":
            out[i] = max(out[i], -LITTLE)
    return out


def best_run(gain: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum above zero, the first of such; (0, 0) if there is none."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, g in enumerate(gain):
        if total <= 0:
            total, start = 0.0, i
        total += g
        if total > best:
            best, at = total, (start, i + 1)
    return at


def extract(page: str | None, score: dict[tuple[str, str], float]) -> str:
    """The text of the best run, its blocks joined by line ends.

    Where no run scores above zero, the page is taken whole but for blocks of links. A page whose every
    word stands in elements that frame by name is read again without names.
    """
    return _extract(tokens(page), score) or (_extract(tokens(page, False), score) if page else "")


def _extract(found: list[tuple], score: dict[tuple[str, str], float]) -> str:
    blocks, block = [], []

    def close():
        text = " ".join(html.unescape("".join(block)).split())
        if text:
            blocks.append(text)
        block.clear()

    first, end = best_run(gains(found, score))
    whole = first == end
    about = features(found) if whole else []
    for i, (kind, value, place, *_) in enumerate(found[slice(first, None if whole else end)]):
        if kind == "tag":
            name = value.lstrip("/")
            if name in BLOCKS:
                close()
            elif name == "br":
                block.append(" ")
        elif place != "frame" and not (whole and ("link", "most") in about[i][1]):
            block.append(value)
    close()
    return "\n".join(blocks)


def fit(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", train_pages: int = TRAIN_PAGES) -> dict[tuple[str, str], float]:
    """Weights from a sample of about ``train_pages`` pages, chosen by a hash of id and page; a table without pages gives the priors.

    The features are a fixed vocabulary (elements of BLOCKS and VOID and a few more, three lengths, two
    shares of links), so what comes to the driver is bounded whatever the pages hold.
    """
    n = pages.count()
    share = min(1.0, train_pages / max(n, 1))
    u = F.shiftrightunsigned(F.xxhash64(F.lit("html"), F.col(id_col).cast("string"), F.col(body_col)), 12)
    sample = pages.where(u < int(share * 2**52)).select(body_col)

    def run(batches):
        inside, outside = Counter(), Counter()
        for b in batches:
            a, z = learn(b[body_col])
            inside.update(a)
            outside.update(z)
        keys = list({*inside, *outside})
        yield {"kind": [k for k, _ in keys], "name": [v for _, v in keys], "a": [inside[k] for k in keys], "b": [outside[k] for k in keys]}

    got = map_rows(sample, [body_col], "kind string, name string, a long, b long", run).groupBy("kind", "name").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    rows = got.collect()
    return weights(Counter({(r["kind"], r["name"]): r["a"] for r in rows}), Counter({(r["kind"], r["name"]): r["b"] for r in rows}))


def main_text(pages: DataFrame, score: dict, id_col: str = "page_id", body_col: str = "html", url_col: str = "url") -> DataFrame:
    """id, url, text, n_chars (code points) of every page from its whole html; null html gives an empty text.

    Ids may be null or repeated; each row gives a row; other columns are not read; of runs with equal
    sums the first is taken; an empty table gives an empty result.
    """

    def run(batches):
        for b in batches:
            text = [extract(x, score) for x in b[body_col]]
            yield {id_col: b[id_col], url_col: b[url_col], "text": text, "n_chars": [len(t) for t in text]}

    kinds = f"{id_col} {pages.schema[id_col].dataType.simpleString()}, {url_col} {pages.schema[url_col].dataType.simpleString()}"
    return map_rows(pages, [id_col, url_col, body_col], f"{kinds}, text string, n_chars long", run)


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Rows in are rows out, whatever their ids; of runs with equal sums the first is taken. Only page_id, url and html are read,
    so further columns clash with nothing; null and empty pages have an empty text, and an empty table gives none.
    """
    return main_text(pages, fit(pages))
