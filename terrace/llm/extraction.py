"""The main text of HTML pages: their text blocks, classified by a decision tree."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.blocks import KINDS, Block, text_blocks
from terrace.functions import unused_name

FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "heading",
    "page_has_article", *(f"in_{k}" for k in KINDS),
]


def _length(words: int) -> int:
    """Classes of length, as it is not the exact number of words that tells main text from the rest."""
    return sum(words >= edge for edge in (1, 5, 15, 40))


def block_features(blocks: list[Block]) -> np.ndarray:
    """A row per block: its own length and link density, its neighbours', and what is around it."""
    sizes = [(0, 0.0), *((_length(b.words), b.link_density) for b in blocks), (0, 0.0)]
    marked = any(b.kind == "article" for b in blocks)
    return np.array(
        [
            [*sizes[i + 1], *sizes[i], *sizes[i + 2], b.heading, marked, *(b.kind == k for k in KINDS)]
            for i, b in enumerate(blocks)
        ],
        float,
    ).reshape(len(blocks), len(FEATURES))


@dataclass(frozen=True)
class Tree:
    """A node: rows with ``feature`` up to ``edge`` go to ``low``, others to ``high``; a leaf says ``share``."""

    share: float
    feature: int = -1
    edge: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def of(self, row: np.ndarray) -> float:
        node = self
        while node.low:
            node = node.low if row[node.feature] <= node.edge else node.high
        return node.share


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 16, least: int = 8) -> Tree:
    """Splits by Gini impurity until the rows of a node are of one label, too few, or ``depth`` deep."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return Tree(share)
    best = (2 * share * (1 - share) * len(y) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        values, ones = x[order, f], np.cumsum(y[order])
        at = np.flatnonzero(values[1:] > values[:-1])
        at = at[(at + 1 >= least) & (at + 1 <= len(y) - least)]
        if not len(at):
            continue
        n, a = at + 1.0, ones[at]
        m, b = len(y) - n, ones[-1] - a
        impurity = 2 * a * (n - a) / n + 2 * b * (m - b) / m
        i = int(impurity.argmin())
        if impurity[i] < best[0]:
            best = (float(impurity[i]), f, float(values[at[i]] + values[at[i] + 1]) / 2)
    _, f, edge = best
    if f < 0:
        return Tree(share)
    low = x[:, f] <= edge
    return Tree(share, f, edge, grow_tree(x[low], y[low], depth - 1, least), grow_tree(x[~low], y[~low], depth - 1, least))


# The labelled pages: parts that pages are made of, in several layouts. A block is labelled by its first letter, which
# is ``+`` for main text and ``-`` for the rest.


def _say(mark: str, words: int, at: int) -> str:
    return mark + " ".join("lorem ipsum dolor sit amet sed eiusmod tempor".split()[(at + i) % 8] for i in range(words))


def _links(count: int, words: int = 1, tag: str = "li") -> str:
    return "".join(f'<{tag}><a href="/{i}">{_say("-", words + i % 2, i)}</a></{tag}>' for i in range(count))


def _around(f: int) -> list[tuple[str, str]]:
    """What stands before and after the main text in each layout, ``f`` times as long as usual."""
    return [
        ("", ""),
        (
            f"<header><div>{_say('-', 3 * f, 1)}</div><nav><ul>{_links(6)}</ul></nav></header><div class='ad'>{_say('-', 9 * f, 2)}</div>",
            f"<aside><h3>{_say('-', 2, 1)}</h3><ul>{_links(4, 5)}</ul><p>{_say('-', 20 * f, 3)}</p></aside>"
            f"<section class='comments'><h2>{_say('-', 2, 0)}</h2><p>{_say('-', 24 * f, 1)}</p><p>{_say('-', 6, 1)}</p></section>"
            f"<footer>{_say('-', 7 * f, 2)} <a href='/'>{_say('-', 1, 1)}</a></footer>",
        ),
        (
            f"<div id='masthead'>{_say('-', 4 * f, 3)}</div><div class='menu'>{_links(5, 1, 'div')}{_say('-', 6 * f, 1)}</div>"
            f"<div class='cookie-notice'><p>{_say('-', 22 * f, 1)}</p><button>{_say('-', 1, 1)}</button></div>",
            f"<div class='sidebar'><p>{_say('-', 15 * f, 2)}</p></div><div class='advert'><p>{_say('-', 12 * f, 5)}</p></div>"
            f"<form><label>{_say('-', 2, 2)}</label><p>{_say('-', 11 * f, 2)}</p></form><div class='newsletter'>{_say('-', 14 * f, 1)}</div>"
            f"<div id='comments'><div class='comment'>{_say('-', 40 * f, 1)}</div></div><div class='footer'>{_say('-', 9 * f, 4)}</div>",
        ),
        (f"<ul>{_links(7)}</ul>", f"<ul>{_links(5, 2)}</ul><p>{_links(3, 1, 'span')}</p>"),
        (f"<ul>{_links(4, 4)}</ul>", f"<div>{_links(3, 3, 'span')}</div>"),
        (
            f"<div class='notice'>{_say('-', 30 * f, 1)}</div><div class='promo'>{_say('-', 45 * f, 1)}</div>"
            f"<div hidden>{_say('-', 33 * f, 1)}</div><nav>{_say('-', 10 * f, 1)}</nav>",
            f"<footer><p>{_say('-', 50 * f, 1)}</p><nav>{_links(4, 1, 'span')}</nav></footer><form>{_say('-', 25 * f, 2)}</form>",
        ),
    ]


def labelled_pages() -> list[str]:
    lengths = [(12, 60, 8), (3, 25, 90, 2, 40), (150, 4, 5, 30, 70, 18), (9,), (35, 35, 1, 300, 20, 500, 7, 220, 64), (180, 90, 400, 3), (7, 14, 28, 56), (2, 110), (45, 22, 11, 33), (6, 16, 75), (3,), (4, 2)]
    said = lambda marks: "".join(f"<p>{_say('+', n, n)}</p>" for n in marks)
    mains = ["<article><h1>{h}</h1>{p}</article>", "<main><h1>{h}</h1>{p}</main>", "<div class='post-content'><h2>{h}</h2>{p}</div>", "{p}"]
    pages = []
    for i, marks in enumerate(lengths):
        for j in range(6):
            for k, main in enumerate(mains):
                for f in (1, 4, 12):
                    before, after = _around(f)[j]
                    inside = f"<div class='share'>{_say('-', 3 * f, 1)}</div><ul class='related'>{_links(3, 6)}</ul><div class='ads'>{_say('-', 16 * f, 1)}</div>"
                    text = said(marks[:1]) + (inside if (i + j + f) % 3 == 0 and k < 3 else "") + said(marks[1:])
                    if (i + j) % 2:
                        text += f"<p>{_say('+', 14, 1)} <a href='/x'>{_say('', 3, 2)}</a> {_say('', 9, 2)}</p>"
                        text += "".join(f"<li>{_say('+', n, n)}</li>" for n in (4, 9)) + f"<p><a href='/y'>{_say('+', 5, 3)}</a></p>"
                    if j and k < 3:
                        before, after = f"{before}<div>{_say('-', 5 * f, 1)}</div>", f"<p>{_say('-', 8 * f, 1)}</p>{after}"
                    pages.append(f"<html><body>{before}{main.format(h=_say('+', 2 + i, i), p=text)}{after}</body></html>")
    return pages


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in labelled_pages():
        blocks = text_blocks(page)
        rows.append(block_features(blocks))
        labels += [b.text.startswith("+") for b in blocks]
    return np.concatenate(rows), np.array(labels, float)


@lru_cache(1)
def block_tree() -> Tree:
    return grow_tree(*labelled_table())


def main_text(page: str | None, tree: Tree) -> str:
    blocks = text_blocks(page)
    return "\n".join(b.text for b, row in zip(blocks, block_features(blocks)) if tree.of(row) >= 0.5)


def extract_main_text(df: DataFrame, html: str, tree: Tree | None = None) -> DataFrame:
    """Adds ``text``, the blocks that the tree takes for main text, a line each, and ``n_chars``, its code points.

    Whole pages are read; what is not HTML is one block. Null and empty pages, and pages without main text, have an
    empty text. Columns of the two names are replaced, others stay; repeated rows are extracted each. No shuffle, and
    a task holds a batch of pages.
    """
    copy = unused_name(df, "copy")
    kept = df.withColumn(copy, F.col(html)).drop("text", "n_chars")
    out = kept.drop(copy).schema.add("text", "string").add("n_chars", "long")
    known = tree or block_tree()
    order = [*[c for c in kept.columns if c != copy], copy]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, pages = batch.columns
            texts = [main_text(page.as_py(), known) for page in pages]
            columns = [*others, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return kept.select(*order).mapInArrow(extract, out)
