"""Main text of web pages by a minimum cut over their blocks.

Every block is a node. What its markup and a classifier say becomes the capacities of its edges
to two terminals: the cost of calling it boilerplate and that of calling it content.
Neighbours are joined by edges that cost something when their labels differ: blocks that follow
each other, the less the further apart their containers are in the tree of the document, and
blocks that follow each other in one container with others in between. The minimum cut, found as
a maximum flow, is the labelling of least total cost. Blocks on the content side are joined.

The classifier is a logistic regression on the length of a block, the share of links in it, how
it ends and whether it is a heading, a list item or other text. It is trained on blocks whose labels the markup gives
(``article`` and ``main`` against navigation, footers, advertisements and the like) in
``TRAINING_PAGES`` pages, the first by a hash of their id.

A null or empty page has an empty text. A block that costs the same either way is content, so
that a page that tells nothing of itself stays whole. Pages of equal ids are read each for itself.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crmflow.llm.page_blocks import CONTENT, FIRM, SOFT, UNKNOWN, Block, page_blocks
from crmflow.llm.text import column_bytes
from crmflow.llm.workers import giving_back

#: Pages that the classifier is trained on.
TRAINING_PAGES = 1000
#: Costs are in thousandths of a nat. What the markup says is added to the classifier's score.
MARKUP = {CONTENT: 7000, UNKNOWN: 0, SOFT: -6000, FIRM: -9000}
#: The classifier's score is at most this.
MOST_SCORE = 4000
#: Cost of a change of label between blocks that follow each other; a quarter of it at one step apart.
ADJACENT = 800
#: Cost of a change between neighbours in one container with other blocks between them.
SAME_CONTAINER = 400
#: Steps between containers are counted up to here.
_MOST_STEPS = 8

_LENGTHS = (2, 4, 10, 25, 60)
_KINDS = ("text", "heading", "item")
_SIZES = (len(_LENGTHS) + 1, 4, 2, len(_KINDS))
CODES = int(np.prod(_SIZES))


def feature_code(block: Block) -> int:
    """A number for the features of a block: words, share of links, its end and its kind."""
    words = block.text.count(" ") + 1
    length = sum(words >= bound for bound in _LENGTHS)
    links = 0 if not block.link_share else 1 if block.link_share < 0.3 else 2 if block.link_share < 0.7 else 3
    ended = block.text[-1] in ".!?;:…”»\""
    return ((length * 4 + links) * 2 + ended) * len(_KINDS) + _KINDS.index(block.kind)


def fit_scores(counts: np.ndarray, rounds: int = 25, penalty: float = 1.0) -> np.ndarray:
    """Scores per feature code from counts by (code, boilerplate or content), by Newton's method.

    Both labels weigh the same. Without examples of both, all scores are zero.
    """
    totals = counts.sum(axis=0)
    if not totals.all():
        return np.zeros(CODES, np.int64)
    places = np.array(np.unravel_index(np.arange(CODES), _SIZES))
    design = np.concatenate(
        [np.eye(size)[place] for size, place in zip(_SIZES, places)] + [np.ones((CODES, 1))], axis=1
    )
    weight = counts * (totals.sum() / 2 / totals)
    beta = np.zeros(design.shape[1])
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight[:, 1] - weight.sum(axis=1) * chance) - penalty * beta
        curve = design.T * (weight.sum(axis=1) * chance * (1 - chance)) @ design
        beta += np.linalg.solve(curve + penalty * np.eye(len(beta)), slope)
    scores = np.clip(1000 * (design @ beta), -MOST_SCORE, MOST_SCORE)
    return np.rint(scores).astype(np.int64)


def _steps(a: int, b: int, around: Sequence[int]) -> int:
    """Steps from one container to another; containers are numbered in order, outer ones first."""
    steps = 0
    while a != b and steps < _MOST_STEPS:
        if a > b:
            a = around[a]
        else:
            b = around[b]
        steps += 1
    return steps


def page_graph(
    blocks: list[Block], around: list[int], scores: Sequence[int]
) -> tuple[list[int], list[tuple[int, int, int]]]:
    """For each block what content gains over boilerplate, and edges (block, block, cost)."""
    gains = [MARKUP[b.verdict] + scores[feature_code(b)] for b in blocks]
    edges, latest = [], {}
    for i, block in enumerate(blocks):
        before = latest.get(block.container, i)
        if i:
            steps = 0 if before == i - 1 else _steps(blocks[i - 1].container, block.container, around)
            edges.append((i - 1, i, ADJACENT // (1 + 3 * steps)))
            if before < i - 1:
                edges.append((before, i, SAME_CONTAINER))
        latest[block.container] = i
    return gains, edges


def minimum_cut(gains: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels (True: content) of least cost: gains given up plus the cost of edges cut.

    A block whose gain outweighs all its edges has its label in any case, and its edges then
    add to the gains of its neighbours. What is left is a maximum flow; blocks that cannot
    reach the boilerplate side in the residual graph are content.
    """
    count = len(gains)
    gains = list(gains)
    near: list[list[tuple[int, int]]] = [[] for _ in range(count)]
    reach = [0] * count
    for a, b, cost in edges:
        near[a].append((b, cost))
        near[b].append((a, cost))
        reach[a] += cost
        reach[b] += cost
    fixed = [False] * count
    todo = [i for i in range(count) if gains[i] >= reach[i] or gains[i] < -reach[i]]
    while todo:
        i = todo.pop()
        if fixed[i]:
            continue
        fixed[i] = True
        sign = 1 if gains[i] >= 0 else -1
        for j, cost in near[i]:
            if not fixed[j]:
                gains[j] += sign * cost
                reach[j] -= cost
                if gains[j] >= reach[j] or gains[j] < -reach[j]:
                    todo.append(j)
    labels = [gain >= 0 for gain in gains]
    open_ = [i for i in range(count) if not fixed[i]]
    if open_:
        for i, label in zip(open_, _flow(open_, gains, near, fixed)):
            labels[i] = label
    return labels


def _flow(nodes: list[int], gains: list[int], near: list, fixed: list[bool]) -> list[bool]:
    """Labels of the open blocks by Dinic's maximum flow from gains above to gains below zero."""
    number = {node: at for at, node in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    links: list[list[int]] = [[] for _ in range(len(nodes) + 2)]
    heads: list[int] = []
    left: list[int] = []

    def join(a: int, b: int, there: int, back: int) -> None:
        links[a].append(len(heads))
        heads.append(b)
        left.append(there)
        links[b].append(len(heads))
        heads.append(a)
        left.append(back)

    for node, at in number.items():
        if gains[node] > 0:
            join(source, at, gains[node], 0)
        elif gains[node] < 0:
            join(at, sink, -gains[node], 0)
        for other, cost in near[node]:
            if not fixed[other] and node < other:
                join(at, number[other], cost, cost)
    while True:
        level = [-1] * len(links)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in links[a]:
                if left[e] and level[heads[e]] < 0:
                    level[heads[e]] = level[a] + 1
                    queue.append(heads[e])
        if level[sink] < 0:
            break
        following = [0] * len(links)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                most = min(left[e] for e in path)
                for e in path:
                    left[e] -= most
                    left[e ^ 1] += most
                # Go back to the start of the first edge that is full now.
                cut = next(k for k, e in enumerate(path) if not left[e])
                at = heads[path[cut] ^ 1]
                del path[cut:]
                continue
            while following[at] < len(links[at]):
                e = links[at][following[at]]
                if left[e] and level[heads[e]] == level[at] + 1:
                    break
                following[at] += 1
            if following[at] < len(links[at]):
                path.append(links[at][following[at]])
                at = heads[path[-1]]
            elif path:
                at = heads[path.pop() ^ 1]
                following[at] += 1
            else:
                break
    # Those that cannot reach the sink any more.
    reaches = [False] * len(links)
    reaches[sink] = True
    queue = deque([sink])
    while queue:
        b = queue.popleft()
        for e in links[b]:
            a = heads[e]
            if left[e ^ 1] and not reaches[a]:
                reaches[a] = True
                queue.append(a)
    return [not reaches[at] for at in range(len(nodes))]


def main_blocks(html: str, scores: Sequence[int]) -> tuple[list[str], int]:
    """The texts of the content blocks of a page, and the number of all its blocks."""
    blocks, around = page_blocks(html)
    labels = minimum_cut(*page_graph(blocks, around, scores))
    return [block.text for block, kept in zip(blocks, labels) if kept], len(blocks)


def _pages(column: pa.Array) -> Iterator[str]:
    data, offsets = column_bytes(column)
    buffer, cuts = memoryview(np.ascontiguousarray(data)), offsets.tolist()
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield str(buffer[low:high], "utf-8")


def train_scores(
    pages: DataFrame, id_column: str = "page_id", html_column: str = "html", sample: int = TRAINING_PAGES
) -> np.ndarray:
    """Scores per feature code, from blocks labelled by their markup in a bounded sample of pages."""
    ids = pages.select(pages[id_column].alias("id")).filter("id IS NOT NULL")
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(sample).distinct()
    rows = pages.select(pages[id_column].alias("id"), pages[html_column].alias("html"))
    rows = rows.join(F.broadcast(chosen), "id", "left_semi").select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * CODES, np.int64)
        for batch in batches:
            for html in _pages(batch.column(0)):
                for block in page_blocks(html)[0]:
                    if block.verdict != UNKNOWN:
                        counts[2 * feature_code(block) + (block.verdict == CONTENT)] += 1
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["cell", "n"])

    # At most two rows per feature code come back.
    found = rows.mapInArrow(giving_back(run), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(2 * CODES)
    counts[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    return fit_scores(counts.reshape(CODES, 2))


def extract_content(
    pages: DataFrame,
    scores: Sequence[int],
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """One row per page: id, url, ``text`` (content blocks, one a line), ``n_blocks`` and ``n_kept``."""
    table = [int(score) for score in scores]
    rows = pages.select(pages[id_column].alias("id"), pages[url_column].alias("url"), pages[html_column].alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found, kept = [], [], []
            for html in _pages(batch.column(2)):
                content, count = main_blocks(html, table)
                texts.append("\n".join(content))
                found.append(count)
                kept.append(len(content))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(texts, pa.string()),
                    pa.array(found, pa.int64()),
                    pa.array(kept, pa.int64()),
                ],
                ["id", "url", "text", "n_blocks", "n_kept"],
            )

    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "url")]
    found = rows.mapInArrow(giving_back(run), f"id {kinds[0]}, url {kinds[1]}, text string, n_blocks bigint, n_kept bigint")
    return found.select(F.col("id").alias(id_column), F.col("url").alias(url_column), "text", "n_blocks", "n_kept")
