"""Main text of web pages by gradient-boosted trees over DOM-node features.

Every block element and text block of a page is a node.  Features: tag and
attribute words of the node and of its ancestors, size and density of its
subtree, links, punctuation, depth, position and statistics of its siblings.
Boosted trees give each node the odds of being main text; a decoding over the
tree then picks the most probable consistent choice: a node taken as a whole
takes all its descendants, a node left out leaves all of them out, and only a
node marked as mixed lets its children differ.

Training pages: text blocks of a bounded sample of the given pages (``SAMPLE``)
fill page layouts of many kinds (with semantic elements, with class names only,
and bare), in which menus, headers, notices, adverts, forms, sidebars, related
links, hidden parts, reader comments and footers stand at known places.  So the
labels are certain, the texts are those of the corpus, and no page is read by a
rule.  The sampled pages are read whole, in tasks; of all their blocks and words
bounded numbers, chosen by hash, come to the driver.

Null and empty pages have an empty text.  Pages are read whole.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajex.llm.boosting import Boosted
from trajex.llm.common import append_columns, bounded_sample, hash_share, stage, text
from trajex.llm.html_tree import TEXT, Tree, parse
from trajex.session import ship_package

#: Pages whose texts fill the layouts, and layouts made; text blocks and words
#: of these pages that are used, and characters of such blocks in all.  Blocks
#: are whole: one that no longer fits is passed over.
SAMPLE, LAYOUTS, BLOCKS, WORDS, ROOM = 200, 900, 2000, 4000, 4_000_000
#: What a mixed node costs in log probability.
MIXED = 3.0
#: Pages whose nodes are scored at once.
AT_ONCE = 200

#: Words of class, id and role values, by what they speak for.
ATTRIBUTE_WORDS = {
    "main": "article articlebody main content contents maincontent post entry body story text prose page postbody",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager topbar toolbar tabs tab skip toc",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion adsense adbox banner",
    "comments": "comment comments commentlist reply replies respond disqus discussion thread reader readers feedback responses",
    "side": "sidebar side aside widget widgets rail related recommended trending popular more teaser teasers secondary complementary",
    "header": "header masthead head logo branding brand hero",
    "footer": "footer foot copyright legal colophon contentinfo imprint",
    "share": "share shares sharing social tweet facebook twitter follow",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe signup paywall privacy message warning",
    "form": "form login signin search register contact poll field input",
}
GROUPS = list(ATTRIBUTE_WORDS)
BIT_OF_WORD = {w: 1 << k for k, v in enumerate(ATTRIBUTE_WORDS.values()) for w in v.split()}
TAG_GROUPS = ["article main", "nav menu", "header hgroup", "footer", "aside", "form fieldset button select label legend input dialog",
              "h1 h2 h3 h4 h5 h6", "p pre blockquote", "li ul ol dl dt dd", "table tbody tr td th", "div section body", "figure figcaption details summary"]
BIT_OF_TAG = {t: 1 << (len(GROUPS) + k) for k, v in enumerate(TAG_GROUPS) for t in v.split()}
BIT_HIDDEN = 1 << (len(GROUPS) + len(TAG_GROUPS))
BITS = len(GROUPS) + len(TAG_GROUPS) + 1
SPLIT = re.compile(r"[^a-z]+")
MARK = re.compile(r"[.,;:!?]")
HIDDEN = re.compile(r"(?:^| )hidden=|display:\s*none", re.I)


def own_bits(tag: str, attributes: str) -> int:
    bits = BIT_OF_TAG.get(tag, 0)
    if attributes:
        bits |= BIT_HIDDEN if HIDDEN.search(attributes) else 0
        shown = re.sub(r"(?:^| )(?:data-y|style)=\S*", " ", attributes)
        spaced = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", shown)
        for word in SPLIT.split(spaced.lower()):
            bits |= BIT_OF_WORD.get(word, 0)
    return bits


def features(trees: list[Tree]) -> np.ndarray:
    """A row for each node of the trees, in order.  Nodes are in page order, so
    sums over subtrees are differences of running sums."""
    counts, own, above, parent, end, depth, page, is_text = [], [], [], [], [], [], [], []
    offset = 0
    for number, t in enumerate(trees):
        bits, reach = [], []
        for tag, up, attributes in zip(t.tag, t.parent, t.attributes, strict=True):
            mine = own_bits(tag, attributes)
            bits.append(mine if tag != TEXT else bits[up])
            reach.append(reach[up] | bits[up] if up >= 0 else 0)
        own += bits
        above += reach
        counts += [(len(s), s.count(" ") + 1, len(MARK.findall(s)), n, k, 1) if s else (0, 0, 0, 0, 0, 0)
                   for s, n, k in zip(t.text, t.links, t.inner, strict=True)]
        parent += [offset + p if p >= 0 else offset for p in t.parent]
        end += [offset + e for e in t.end]
        depth += t.depth
        page += [number] * len(t.tag)
        is_text += [s == TEXT for s in t.tag]
        offset += len(t.tag)
    n = offset
    counts, own, above, parent, end, depth, page, is_text = (np.array(v) for v in (counts, own, above, parent, end, depth, page, is_text))
    index = np.arange(n)
    running = np.vstack([np.zeros((1, counts.shape[1]), np.int64), counts.cumsum(0)])
    sub = (running[end] - running[index]).astype(float)
    chars, words, marks, links, inner, blocks = sub.T
    nodes = (end - index).astype(float)
    first = np.searchsorted(page, np.arange(len(trees)))[page]  # the page's root
    total = np.maximum(chars[first], 1)
    before = running[index][:, 0] - running[first][:, 0]
    children = np.maximum(np.bincount(parent, minlength=n) - (parent == index), 1)  # roots are their own parents
    lines = np.log1p(chars)
    same = np.bincount(parent, lines, n) - np.where(parent == index, lines, 0)
    link_share = links / np.maximum(chars, 1)
    share_sum = np.bincount(parent, link_share, n) - np.where(parent == index, link_share, 0)
    order = np.lexsort((index, parent))  # siblings in page order
    place = np.empty(n)
    place[order] = index - np.searchsorted(parent[order], parent[order], "left")
    up = parent
    columns = [
        lines, np.log1p(words), chars / np.maximum(words, 1), marks / np.maximum(words, 1), link_share, np.log1p(blocks),
        np.log1p(chars / np.maximum(blocks, 1)), np.log1p(chars / nodes), inner / np.maximum(words, 1), depth, is_text,
        np.log(children[up]), place[index] / children[up], same[up] / children[up], lines - same[up] / children[up], share_sum[up] / children[up],
        before / total, (before + chars) / total, chars / total, lines[up], link_share[up], np.log1p(chars[up] / np.maximum(blocks[up], 1)),
        marks[up] / np.maximum(words[up], 1), np.log1p(total), np.log1p(chars / np.maximum(chars[up], 1)),
        *((own >> k & 1) for k in range(BITS)), *((above >> k & 1) for k in range(BITS)),
    ]
    return np.stack([np.asarray(c, np.float32) for c in columns], axis=1)


def decode(tree: Tree, odds: np.ndarray, shift: float = 0.0) -> list[int]:
    """Text blocks of the most probable consistent choice."""
    yes = -np.logaddexp(0, -(odds + shift))
    no = (yes - odds - shift).tolist()
    yes = yes.tolist()
    n = len(tree.tag)
    mixed = [-MIXED] * n
    for k in range(n - 1, 0, -1):
        up = tree.parent[k]
        yes[up] += yes[k]
        no[up] += no[k]
        leaf = tree.tag[k] == TEXT or tree.end[k] == k + 1
        mixed[up] += max(yes[k], no[k]) if leaf else max(yes[k], no[k], mixed[k])
    taken, k = [], 0
    while k < n:
        leaf = tree.tag[k] == TEXT or tree.end[k] == k + 1
        if not leaf and mixed[k] > max(yes[k], no[k]):
            k += 1
            continue
        if yes[k] > no[k]:
            taken += [j for j in range(k, tree.end[k]) if tree.tag[j] == TEXT]
        k = max(tree.end[k], k + 1)
    return taken


# ---- training pages -------------------------------------------------------

def layout(rng: random.Random, paragraphs: list[str], words: list[str]) -> str:
    """One page with ``data-y`` marks: 1 on main text, 0 on all else."""
    style = rng.choice(("semantic", "semantic", "classes", "classes", "bare"))
    esc = html.escape
    some = lambda a, b: " ".join(rng.choices(words, k=rng.randint(a, b)))
    sentence = lambda a, b: some(a, b).capitalize() + "."
    long = lambda: rng.choice(paragraphs)

    def box(tag: str, names: str, inner: str, mark: int = 0, more: str = "") -> str:
        attributes = f' data-y="{mark}"{more}'
        named = style == "classes" or (style == "semantic" and rng.random() < 0.3)
        if names and (named or tag == "div" and style == "semantic"):
            chosen = rng.choice(names.split())
            attributes += rng.choice((f' class="{chosen}"', f' id="{chosen}"', f' class="{chosen} {rng.choice(words)[:6]}"', f' class="{chosen}-{rng.choice(["box", "wrap", "inner", "list"])}"'))
        if style != "semantic" and tag not in ("form", "ul", "p"):
            tag = rng.choice(("div", "div", "section", "td")) if style == "bare" else "div"
            tag = "div" if tag == "td" else tag
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def link(a: int = 1, b: int = 3) -> str:
        shown = esc(some(a, b))
        return f'<a href="/{shown[:8]}">{shown}</a>'

    def items(n: int, item) -> str:
        if rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{item()}</li>" for _ in range(n)) + "</ul>"
        return rng.choice((" ", " | ", " ")).join(item() for _ in range(n))

    # an article may be poor text throughout; where it stands still tells
    manner = rng.choice(("plain",) * 7 + ("repeated", "unmarked", "symbols"))

    def worded(value: str) -> str:
        if manner == "plain":
            return value
        if manner == "repeated":
            return " ".join([rng.choice(value.split())] * rng.randint(2, 60))
        return MARK.sub("", value) if manner == "unmarked" else value.replace(" ", rng.choice(("*** ", "&&& ", " | ", "!! ")))

    def paragraph(mark_open: bool) -> str:
        body = esc(worded(long()))
        if rng.random() < 0.2:
            body = body.replace(" ", f' {link()} ', 1)
        if rng.random() < 0.1:
            body = f"<b>{body}<br>"
            return f"<p>{body}" if mark_open else f"<p>{body}</b></p>"
        return f"<p>{body}" + ("" if mark_open else "</p>")

    title = esc(some(3, 12).capitalize())
    menu = lambda: box("nav", "nav menu navbar topbar navigation", items(rng.randint(3, 12), link))
    header = lambda: box("header", "header masthead branding logo", f"{rng.choice(['', link(1, 4), esc(some(1, 5))])}{menu() if rng.random() < 0.5 else ''}<p>{esc(some(2, 9))}</p>")
    advert = lambda: box(rng.choice(("div", "div", "aside")), "ad ads advert advertisement sponsored promo banner", rng.choice((esc(sentence(3, 25)), f"<p>{esc(long())}</p>", link(2, 8), f"<p>{esc(sentence(2, 10))} {link(1, 4)}</p>")))
    notice = lambda: box(rng.choice(("div", "div", "dialog")), "cookie consent notice gdpr alert newsletter popup", f"<p>{esc(sentence(6, 30))}</p><button>{esc(some(1, 2))}</button>")
    form = lambda: box("form", "form login search newsletter subscribe signup", "".join(f"<label>{esc(some(1, 4))}</label><input name=q>" for _ in range(rng.randint(1, 4))) + rng.choice(("", f"<p>{esc(sentence(3, 15))}</p>")) + f"<button>{esc(some(1, 2))}</button>")
    side = lambda: box("aside", "sidebar side widget related trending recommended", f"<h3>{esc(some(1, 4))}</h3>" + rng.choice((items(rng.randint(2, 9), lambda: link(2, 9)), f"<p>{esc(long())}</p>", "".join(f"<p>{esc(sentence(5, 30))}</p>" for _ in range(rng.randint(1, 4))))))
    related = lambda: box("section", "related more recommended teaser", f"<h2>{esc(some(1, 4))}</h2>" + items(rng.randint(2, 8), lambda: link(3, 10)))
    hidden = lambda: box(rng.choice(("div", "section", "p", "aside")), "content text modal popup", rng.choice((esc(sentence(4, 40)), f"<p>{esc(long())}</p>")), 0, rng.choice((" hidden", ' style="display:none"', ' style="color:red; display: none"')))
    share = lambda: box("div", "share social sharing follow", " ".join(link(1, 2) for _ in range(rng.randint(2, 6))))

    def comment() -> str:
        inner = f"<{rng.choice(('b', 'span', 'cite'))}>{esc(some(1, 2))}</b> " if rng.random() < 0.5 else f"<h4>{esc(some(1, 3))}</h4>"
        return rng.choice((f"<li>{inner}<p>{esc(rng.choice((sentence(4, 40), long())))}</p></li>", f'<div{rng.choice(("", " class=comment"))}>{inner}<p>{esc(sentence(4, 60))}</p></div>'))

    comments = lambda: box(rng.choice(("section", "div", "div")), "comments commentlist discussion replies responses", f"<h3>{esc(some(1, 4))}</h3>" + "".join(comment() for _ in range(rng.randint(1, 12))) + (form() if rng.random() < 0.4 else ""))
    footer = lambda: box("footer", "footer copyright legal colophon", rng.choice((f"&copy; {esc(some(1, 3))} &middot; {esc(sentence(4, 14))}", f"<p>&copy; {esc(some(1, 4))}</p>{items(rng.randint(2, 7), link)}", f"<p>{esc(sentence(5, 40))}</p>", esc(sentence(3, 20)))))

    unclosed = rng.random() < 0.3
    body = [f"<h1>{title}</h1>" if rng.random() < 0.85 else ""]
    for _ in range(rng.choice((1, 2, 3, 4, 6, 9, 14, 25, 40))):
        roll = rng.random()
        if roll < 0.06:
            body.append(f"<h2>{esc(some(1, 8))}</h2>")
        elif roll < 0.1:
            body.append("<ul>" + "".join(f"<li>{esc(sentence(2, 25))}</li>" for _ in range(rng.randint(2, 7))) + "</ul>")
        elif roll < 0.13:
            body.append(f"<blockquote><p>{esc(long())}</p></blockquote>")
        elif roll < 0.15:
            body.append("<table>" + "".join(f"<tr><td>{esc(some(1, 4))}</td><td>{esc(some(1, 6))}</td></tr>" for _ in range(rng.randint(2, 5))) + "</table>")
        elif roll < 0.25:
            body.append(f"<p>{esc(worded(sentence(1, 4)))}</p>")
        else:
            body.append(paragraph(unclosed))
        if rng.random() < 0.03:
            body.append(advert())
        if rng.random() < 0.02:
            body.append(hidden())
    if rng.random() < 0.2:
        body.insert(rng.randint(0, 1), share())
    inside_end = (share() if rng.random() < 0.1 else "") + (comments() if rng.random() < 0.15 else "") + (related() if rng.random() < 0.1 else "")
    article = box("article" if rng.random() < 0.8 else "main", "article content main post entry story", "".join(body) + inside_end, 1)
    if rng.random() < 0.3:
        article = box("main", "main content page", article + (comments() if rng.random() < 0.3 else "") + (related() if rng.random() < 0.2 else ""))
    top = [part() for part, chance in ((notice, 0.25), (header, 0.5), (menu, 0.7), (advert, 0.4), (form, 0.15), (side, 0.15)) if rng.random() < chance]
    if rng.random() < 0.4:
        rng.shuffle(top)
    bottom = [part() for part, chance in ((comments, 0.35), (related, 0.25), (side, 0.3), (advert, 0.2), (form, 0.15), (share, 0.15), (notice, 0.1), (footer, 0.85)) if rng.random() < chance]
    head = f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style><script>var t=1;</script></head>"
    page = head + "<body>" + "".join(top) + article + "".join(bottom) + "</body></html>"
    if rng.random() < 0.15:  # cut off inside or after the article
        page = page[:rng.randint(len(page) // 2, len(page))]
    return page


def labels(tree: Tree) -> np.ndarray:
    """1 for nodes whose text is all main text, 0 for none, -1 for both or no
    text; the nearest mark above a block decides."""
    marks = [0]
    for tag, up, attributes in list(zip(tree.tag, tree.parent, tree.attributes, strict=True))[1:]:
        mark = re.search(r"data-y=(\d)", attributes)
        marks.append(int(mark[1]) if mark else marks[up])
    main = np.array([m if t == TEXT else 0 for m, t in zip(marks, tree.tag, strict=True)])
    other = np.array([1 - m if t == TEXT else 0 for m, t in zip(marks, tree.tag, strict=True)])
    a, b = np.append(0, main.cumsum()), np.append(0, other.cumsum())
    end, at = np.array(tree.end), np.arange(len(tree.tag))
    has, lacks = a[end] - a[at] > 0, b[end] - b[at] > 0
    return np.where(has & ~lacks, 1, np.where(lacks & ~has, 0, -1))


def training_trees(paragraphs: list[str], words: list[str], layouts: int = LAYOUTS, seed: int = 5) -> list[Tree]:
    """Layouts filled with text blocks and words; a handful of neutral ones
    stands in where the sample has none."""
    rng = random.Random(seed)
    paragraphs = paragraphs or ["A day by the sea.", "The road was long, and nobody came.", "It rained on the hill."]
    words = words or sorted({w.strip(".,") for s in paragraphs for w in s.split()})
    return [parse(layout(rng, paragraphs, words)) for _ in range(layouts)]


def train(paragraphs: list[str], words: list[str] = (), layouts: int = LAYOUTS, seed: int = 5) -> Boosted:
    trees = training_trees(list(paragraphs), list(words), layouts, seed)
    x, y = features(trees), np.concatenate([labels(t) for t in trees])
    weight = np.concatenate([np.full(len(t.tag), 30 / len(t.tag)) for t in trees])  # pages count alike
    return Boosted().fit(x[y >= 0], y[y >= 0].astype(float), weight[y >= 0])


def main_text(trees: list[Tree], model: Boosted) -> list[str]:
    if not trees:
        return []
    odds, at, out = model.predict(features(trees)), 0, []
    for tree in trees:
        n = len(tree.tag)
        out.append("\n\n".join(tree.text[k] for k in decode(tree, odds[at:at + n])))
        at += n
    return out


def page_blocks(pages: DataFrame, column: str) -> DataFrame:
    """(block): the text blocks of whole pages that are not mostly links."""
    def blocks(batches):
        for batch in batches:
            for page in batch.column(0):
                tree = parse(page.as_py() or "")
                found = [s for s, n in zip(tree.text, tree.links, strict=True) if s and n * 2 < len(s)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["block"])

    ship_package(pages.sparkSession)
    return pages.select(F.col(f"`{column}`")).mapInArrow(blocks, "block string")


def sampled(df: DataFrame, column: str, sample: int = SAMPLE) -> tuple[list[str], list[str]]:
    """Blocks and words of a bounded sample of the different pages, chosen by
    hash; copies of a page, and blocks and words that repeat, count once."""
    keyed = df.select(F.xxhash64(F.col(f"`{column}`")).alias("key"), F.col(f"`{column}`").alias("page")).dropna()
    among = keyed.agg(F.approx_count_distinct("key")).first()[0]
    # rows far above the sample's share of hashes go before copies are dropped
    share = min(1.0, 4 * sample / max(among, 1))
    near = keyed.filter(hash_share(F.col("key"), 7) <= share).groupBy("key").agg(F.min("page").alias("page"))
    found = stage(page_blocks(bounded_sample(near, "key", among, sample), "page").distinct(), "blocks")
    words = found.select(F.explode(F.split("block", " ")).alias("w")).select(F.trim(F.col("w"), F.lit(".,;:!?")).alias("w")).filter("w <> ''").distinct()
    words = [r["w"] for r in words.orderBy(F.xxhash64("w"), "w").limit(WORDS).collect()]
    sized = found.select("block", F.length("block").alias("n")).orderBy(F.xxhash64("block"), "block").limit(BLOCKS)
    # the running sum is over at most BLOCKS rows
    fits = F.sum("n").over(Window.orderBy(F.xxhash64("block"), "block").rowsBetween(Window.unboundedPreceding, 0)) <= ROOM
    blocks = [r["block"] for r in sized.filter(F.col("n") <= ROOM // 4).withColumn("fits", fits).filter("fits").collect()]
    return sorted(blocks), sorted(words)


def fit(df: DataFrame, column: str = "html", sample: int = SAMPLE) -> Boosted:
    """Trains on layouts filled from a bounded sample of the pages."""
    return train(*sampled(df, column, sample))


def extract(df: DataFrame, model: Boosted, column: str = "html", to: str = "text") -> DataFrame:
    """Adds the main text of each page; blocks are joined by two line ends."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # some hundred kB, whatever the input

    def make():
        model = shared.value

        def run(pages):
            out = []
            for at in range(0, len(pages), AT_ONCE):
                out += main_text([parse(p or "") for p in pages[at:at + AT_ONCE]], model)
            return [out]
        return run

    return append_columns(df, [column], make, [text(to)])


def op2(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = extract(pages, fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
