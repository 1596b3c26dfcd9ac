"""Main text of web pages: boosted trees over DOM elements, decoded along the tree.

Spark ML fits gradient-boosted trees on elements of a bounded sample of pages.
A sampled page counts once as it is, labelled by its semantic tags, and
``VARIANTS`` times as its article's paragraphs laid out anew: with and without
semantic tags, among menus, sidebars, adverts, notices, forms and reader
comments whose places in the page are known, so the labels are exact.  The
fitted trees are a few kilobytes and score every page where it is read.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthscore.llm import dom
from hearthscore.llm.common import batch_of, pylists

TRAIN_PAGES = 256  # bound of the training sample
VARIANTS = 3
ROUNDS = 12
DEPTH = 5
GROUP_CHARS = 1 << 22  # characters of the pages scored at once

FILLER = "the words of a page that has no text of its own stand here, one after another.".split()
WRAPPERS = ["content", "article-body", "post", "entry-content", "story", "main-content", "text", ""]
BOILERPLATE = {
    "menu": (["nav", "div", "ul"], ["menu", "main-nav", "navbar", "site-navigation", "breadcrumbs"]),
    "header": (["header", "div"], ["site-header", "masthead", "top-banner", "header"]),
    "footer": (["footer", "div"], ["footer", "site-footer", "colophon", "copyright-notice"]),
    "sidebar": (["aside", "div", "section"], ["sidebar", "widget", "related-posts", "right-rail", "trending"]),
    "advert": (["div", "aside", "ins", "section"], ["ad", "ads", "advert", "sponsored", "promo-box"]),
    "notice": (["div", "section", "dialog"], ["cookie-notice", "consent", "gdpr-popup", "newsletter-signup"]),
    "comments": (["div", "section", "ol"], ["comments", "comment-list", "disqus", "replies", "discussion"]),
    "share": (["div", "ul"], ["share", "social-links", "tags", "post-meta"]),
    "form": (["form"], ["search-form", "login", "contact", ""]),
}


@dataclass(frozen=True)
class TreeEnsemble:
    """Fitted trees as arrays of nodes; a leaf has feature -1."""

    trees: tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], ...]
    depth: int

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = feature[at]
                goes_left = x[rows, np.maximum(f, 0)] <= threshold[at]
                at = np.where(f < 0, at, np.where(goes_left, left[at], right[at]))
            total += value[at]
        return 2 * total


def _attributes(rng: random.Random, name: str) -> str:
    return f' {rng.choice(["class", "class", "id"])}="{name}"' if name else ""


def _sentence(rng: random.Random, words: list[str], least: int, most: int) -> str:
    at = rng.randrange(len(words))
    return html.escape(" ".join((words[at:] + words)[: rng.randint(least, most)]))


def _boilerplate(rng: random.Random, kind: str, words: list[str]) -> str:
    tags, names = BOILERPLATE[kind]
    tag = rng.choice(tags)
    # Either the tag or the attributes give the kind away, most often both.
    plain_tag = tag in ("div", "ul", "ol", "section", "ins")
    name = rng.choice(names) if plain_tag or rng.random() < 0.5 else ""
    item = lambda: f'<a href="/x">{_sentence(rng, words, 1, 4)}</a>'
    if kind in ("menu", "share"):
        inner = "".join(f"<li>{item()}</li>" for _ in range(rng.randint(2, 9)))
        inner = inner if tag in ("ul", "ol") else f"<ul>{inner}</ul>"
    elif kind == "form":
        inner = f'<label>{_sentence(rng, words, 1, 3)}</label><input name="q"><button>Go</button>'
    elif kind == "comments":
        part = "li" if tag == "ol" else "div"
        inner = "".join(
            f"<{part}{_attributes(rng, rng.choice(['comment', 'reply', 'comment-body']))}><b>"
            f"{_sentence(rng, words, 1, 2)}</b><p>{_sentence(rng, words, 4, 60)}</p></{part}>"
            for _ in range(rng.randint(1, 6))
        )
    elif kind == "header":
        inner = rng.choice([f"<h1>{item()}</h1>", item(), _sentence(rng, words, 1, 6)])
    elif kind == "sidebar":
        inner = f"<h3>{_sentence(rng, words, 1, 4)}</h3>" + "".join(
            rng.choice([f"<p>{_sentence(rng, words, 3, 25)}</p>", f"<ul><li>{item()}</li></ul>"])
            for _ in range(rng.randint(1, 5))
        )
    else:
        inner = _sentence(rng, words, 2, 30)
        inner = rng.choice([inner, f"<p>{inner}</p>", f"<p>{inner}</p>{item()}"])
    return f'<{tag}{_attributes(rng, name)} data-y="0">{inner}</{tag}>'


def _article(rng: random.Random, paragraphs: list[str], words: list[str]) -> str:
    out = []
    if rng.random() < 0.8:
        head = f"<h1>{_sentence(rng, words, 2, 10)}</h1>"
        out.append(f"<header>{head}</header>" if rng.random() < 0.2 else head)
    for text in paragraphs:
        text = html.escape(text)
        kind = rng.random()
        if kind < 0.75:
            out.append(f"<p>{text}</p>")
        elif kind < 0.82:
            out.append(f"<div>{text}</div>")
        elif kind < 0.88:
            out.append(f"<h2>{_sentence(rng, words, 1, 8)}</h2><p>{text}</p>")
        elif kind < 0.92:
            out.append("<ul>" + "".join(f"<li>{_sentence(rng, words, 2, 20)}</li>" for _ in range(3)) + "</ul>")
        elif kind < 0.95:
            out.append(f"<blockquote><p>{text}</p></blockquote>")
        elif kind < 0.975:
            cells = "".join(f"<td>{_sentence(rng, words, 1, 6)}</td>" for _ in range(3))
            out.append(f"<table><tr>{cells}</tr><tr>{cells}</tr></table>")
        else:
            out.append(f"<pre>{text}</pre>")
        if rng.random() < 0.08:
            out.append(_boilerplate(rng, rng.choice(["advert", "share", "sidebar"]), words))
    return "".join(out)


def synthetic_page(rng: random.Random, paragraphs: list[str]) -> str:
    """A page around ``paragraphs`` whose boilerplate is marked ``data-y="0"``."""
    words = [w for p in paragraphs for w in p.split()] or FILLER
    chosen = paragraphs[: rng.randint(1, max(1, len(paragraphs)))] or [" ".join(FILLER)]
    inner = _article(rng, chosen, words)
    tag = rng.choice(["article", "main", "div", "div", "section"])
    name = rng.choice(WRAPPERS)
    body = f"<{tag}{_attributes(rng, name)}>{inner}</{tag}>"
    if rng.random() < 0.3:
        body = f"<div{_attributes(rng, rng.choice(['wrapper', 'container', 'page', 'row']))}>{body}</div>"
    above = [k for k in ("header", "menu", "notice", "advert", "form") if rng.random() < 0.5]
    below = [k for k in ("share", "comments", "sidebar", "advert", "form", "notice", "footer") if rng.random() < 0.5]
    rng.shuffle(above)
    parts = [_boilerplate(rng, k, words) for k in above] + [body]
    parts += [_boilerplate(rng, k, words) for k in below]
    return f"<html><head><title>x</title></head><body>{''.join(parts)}</body></html>"


def _weak_labels(page: dom.Page) -> list[int]:
    """1 for elements outside all boilerplate tags and attribute tokens."""
    labels: list[int] = []
    for e in page.elements:
        main = e.tag not in dom.NOT_MAIN_TAGS and e.tag != "header"
        main = main and not any(t in g for t in e.tokens for g in dom.OTHER_TOKENS)
        labels.append(int(main and (e.parent < 0 or labels[e.parent] == 1)))
    return labels


def _exact_labels(page: dom.Page) -> list[int]:
    labels: list[int] = []
    for e in page.elements:
        up = 1 if e.parent < 0 else labels[e.parent]
        labels.append(up if e.label is None else min(up, e.label))
    return labels


TRAIN = pa.schema([("label", pa.float64()), ("x", pa.list_(pa.float64()))])


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for seed, source in pylists(batch):
            page = dom.parse(source or "", marked=False)
            labels = _weak_labels(page)
            paragraphs = [b for b in dom.blocks(page, [bool(x) for x in labels]) if len(b) > 40]
            examples = [(page, labels)]
            rng = random.Random(seed)
            for _ in range(VARIANTS):
                made = dom.parse(synthetic_page(rng, paragraphs))
                examples.append((made, _exact_labels(made)))
            for made, truth in examples:
                x = dom.features(made).astype(float)
                rows += list(zip(map(float, truth), x.tolist()))
        yield batch_of(TRAIN, rows)


def _flatten(tree, weight: float):
    feature, threshold, left, right, value = [], [], [], [], []

    def add(node) -> int:
        at = len(feature)
        for column in (feature, threshold, left, right, value):
            column.append(0)
        if node.getClass().getSimpleName() == "LeafNode":
            feature[at], value[at] = -1, weight * node.prediction()
        else:
            split = node.split()
            feature[at], threshold[at] = split.featureIndex(), split.threshold()
            left[at], right[at] = add(node.leftChild()), add(node.rightChild())
        return at

    add(tree._java_obj.rootNode())
    return (
        np.array(feature),
        np.array(threshold, dtype=float),
        np.array(left),
        np.array(right),
        np.array(value, dtype=float),
    )


def ensemble_of(model: GBTClassificationModel, depth: int) -> TreeEnsemble:
    trees = zip(model.trees, model.treeWeights)
    return TreeEnsemble(tuple(_flatten(t, w) for t, w in trees), depth)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES):
    """Trees fitted on at most ``train_pages`` pages, those of the smallest hash.

    An empty table or null pages fall back on filler text, so a model results
    always.
    """
    seed = F.xxhash64(F.col(id_col), F.col(html_col))
    sample = pages.select(seed.alias("seed"), F.col(html_col).alias("html"))
    sample = sample.orderBy("seed", "html").limit(train_pages)
    none = pages.sparkSession.createDataFrame([(0, "")], "seed long, html string")
    sample = sample.unionByName(none).repartition(6)
    rows = sample.mapInArrow(_training_rows, "label double, x array<double>")
    rows = rows.select("label", array_to_vector("x").alias("features"))
    trainer = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=42, cacheNodeIds=False)
    return ensemble_of(trainer.fit(rows), DEPTH)


def main_texts(model: TreeEnsemble, sources: list[str | None]) -> list[str]:
    """Main text of each page, blocks joined by an empty line; empty for null or empty pages."""
    pages = [dom.parse(s or "", marked=False) for s in sources]
    if not pages:
        return []
    x = [dom.features(p) for p in pages]
    odds = np.split(model.log_odds(np.concatenate(x)), np.cumsum([len(a) for a in x])[:-1])
    return ["\n\n".join(dom.blocks(p, dom.decode(p, o))) for p, o in zip(pages, odds)]


def extract(model: TreeEnsemble, source: Column) -> Column:
    """Main text of a column of HTML.

    Null and empty pages give an empty text; any malformed input gives what can
    be read of it.  Pages are scored in groups of bounded size.
    """

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        out: list[str] = []
        group: list[str | None] = []
        chars = 0
        for s in column:
            group.append(s.as_py())
            chars += len(group[-1] or "")
            if chars >= GROUP_CHARS:
                out += main_texts(model, group)
                group, chars = [], 0
        return pa.array(out + main_texts(model, group), pa.string())

    return run(source)


def extract_pages(
    pages: DataFrame, model: TreeEnsemble, html_col: str = "html", out: str = "text"
) -> DataFrame:
    """``pages`` with the column ``out`` (replaced if there) holding each main text."""
    return pages.withColumn(out, extract(model, F.col(html_col)))
