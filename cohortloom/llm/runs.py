"""Periodic runs of words: suffix trees of a text and of its reversal, Lyndon roots extended both ways.

A run is a stretch of words with smallest period q that no neighbouring word extends. Every run with
two periods or more has a root that is a longest Lyndon word, in some order of the alphabet or in
the reversed one, at the root's first place. So the candidates are, for each place, the stretch up to
the next smaller suffix and that up to the next greater one: two for each word, whatever the text.
Each candidate is extended by two longest common extensions, forwards in Ukkonen's suffix tree of the
text and backwards in that of its reversal. An extension is the depth of the lowest common ancestor
of two leaves, found in constant time from the tree's Euler tour and a sparse table of its minima.

Trees in Python cost microseconds a word, so words that can be in no run are set aside first, by
conditions that every run meets: words equal to those q later for small q, and runs of places whose
8-word shingle comes again soon for the rest. What remains, of many texts together, is put into one
string with separators that occur once, which no run can cross.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import utf8

#: Words of a suffix tree, unless one stretch alone has more.
TREE = 60_000
#: Words handled at once inside a task, unless one text alone has more.
CHUNK = 200_000
#: Periods below this are set apart by comparing words, the others by shingles of this many words.
SHORT = 8
_P = np.uint64(0x9E3779B97F4A7C15)


def ukkonen(s: list[int]) -> tuple[dict[int, int], list[int], list[int], int]:
    """The suffix tree of `s`, whose last number occurs once: edges, starts and ends of the nodes' labels, width.

    edges maps node * width + first number to the child; node 0 is the root; a leaf's label ends with the string.
    """
    n, width = len(s), max(s) + 1
    edges: dict[int, int] = {}
    start, end, link = [0], [0], [0]
    node = edge = length = waiting = 0
    for i in range(n):
        c = s[i]
        waiting += 1
        last = 0  # the inner node made last, which still has no link
        while waiting:
            if not length:
                edge = i
            key = node * width + s[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if last:
                    link[last] = node
                    last = 0
            else:
                at = start[child]
                span = end[child] - at
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if s[at + length] == c:
                    length += 1
                    if last:
                        link[last] = node
                    break
                split = len(start)
                start += (at, i)
                end += (at + length, n)
                link += (0, 0)
                edges[key] = split
                edges[split * width + c] = split + 1
                start[child] = at + length
                edges[split * width + s[at + length]] = child
                if last:
                    link[last] = split
                last = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return edges, start, end, width


class Extensions:
    """Longest common extensions of places of a string in constant time, and the order of its suffixes."""

    def __init__(self, s: list[int]):
        n = len(s)
        edges, start, end, width = ukkonen(s)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        child = np.fromiter(edges.values(), np.int64, len(edges))
        order = np.argsort(keys)
        parents, kids = keys[order] // width, child[order]
        first = np.searchsorted(parents, np.arange(len(start) + 1)).tolist()
        kids = kids.tolist()
        spans = (np.array(end) - np.array(start)).tolist()
        # The Euler tour from left to right. Between two leaves it comes up to their lowest common
        # ancestor, so the least depth between them is all that is kept of it.
        leaves, depths = [], []
        todo = [(0, 0, 0)]  # node, its depth, depth to which the tour came up before it
        high = 0
        while todo:
            node, depth, up = todo.pop()
            if up >= 0:
                high = up
            a, b = first[node], first[node + 1]
            if a == b:
                leaves.append(n - depth)
                depths.append(high)
                continue
            for k in range(b - 1, a, -1):
                kid = kids[k]
                todo.append((kid, depth + spans[kid], depth))
            kid = kids[a]
            todo.append((kid, depth + spans[kid], -1))
        self.rank = np.empty(n, np.int64)
        self.rank[leaves] = np.arange(n)
        table = [np.array(depths, np.int32)]
        while 2 << (len(table) - 1) <= n:
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common start of the suffixes at i and at j, which differ, place by place."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << int(k)) + 1])
        return out


def next_below(values: list[int]) -> np.ndarray:
    """For each place the next one with a smaller value, -1 where there is none."""
    out, stack = [-1] * len(values), []
    for j, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            out[stack.pop()] = j
        stack.append(j)
    return np.array(out, np.int64)


def string_runs(s: list[int], least: int, times: int) -> np.ndarray:
    """Rows (start, length, period), in order, of the runs of `s` with length >= max(least, times * period).

    The first and the last number of `s` occur once in it; `times` is 2 at least.
    """
    n = len(s)
    ahead, back = Extensions(s), Extensions(s[::-1])
    found = []
    for rank in (ahead.rank, n - ahead.rank):
        j = next_below(rank.tolist())
        i = np.flatnonzero((j > 0) & (np.arange(n) > 0))
        j = j[i]
        period = j - i
        start = i - back(n - i, n - j)  # the words before i and before j, from right to left
        length = j + ahead(i, j) - start
        ok = length >= np.maximum(least, times * period)
        found.append(np.stack([start[ok], length[ok], period[ok]], 1))
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true values."""
    d = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def suspects(words: np.ndarray, left: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Disjoint ranges of places that hold every run of the texts, each within one text.

    words: numbers of all words in a row; left: the words from each place to the end of its text.
    """
    n = len(words)
    begins, ends = [], []
    for q in range(1, min(SHORT, n)):
        a, b = stretches((words[:-q] == words[q:]) & (left[:-q] > q))
        ok = b - a >= max(least, times * q) - q
        begins.append(a[ok])
        ends.append(b[ok] + q)
    m = n - SHORT + 1
    if m > 1:
        shingle = np.zeros(m, np.uint64)
        for k in range(SHORT):
            shingle = (shingle ^ words[k : k + m].astype(np.uint64)) * _P
            shingle ^= shingle >> np.uint64(29)
        order = np.argsort(shingle, kind="stable")
        i, j = order[:-1], order[1:]
        again = (shingle[i] == shingle[j]) & (left[i] - (j - i) >= SHORT)
        gap = np.zeros(m, np.int64)
        gap[i[again]] = (j - i)[again]
        live = gap > 0
        # A run of period q >= SHORT has (times - 1) * q - SHORT + 1 such places in a row at least, all with a gap of q at most.
        while True:
            a, b = stretches(live)
            largest = (b - a + SHORT - 1) // (times - 1)
            gone = gap[live] > np.repeat(np.where(largest >= SHORT, largest, 0), b - a)
            if not gone.any():
                break
            live[np.flatnonzero(live)[gone]] = False
        begins.append(a)
        ends.append(np.minimum(b + largest + SHORT - 1, a + left[a]))
    if not begins:
        return []
    begin, end = np.concatenate(begins), np.concatenate(ends)
    out: list[tuple[int, int]] = []
    for k in np.argsort(begin, kind="stable"):
        a, b = int(begin[k]), int(end[k])
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def text_runs(words: np.ndarray, left: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, length, period) of the runs of all texts, by start and period; starts are places in `words`."""
    found, held, total = [np.zeros((0, 3), np.int64)], [], 0
    ranges = suspects(words, left, least, times)
    for k, (a, b) in enumerate(ranges):
        held.append((a, b))
        total += b - a
        if total < TREE and k + 1 < len(ranges):
            continue
        _, small = np.unique(np.concatenate([words[a:b] for a, b in held]), return_inverse=True)
        mark = int(small.max()) + 1
        s, places, at = [mark], [-1], 0
        for a, b in held:
            s += small[at : at + b - a].tolist()
            s.append(mark := mark + 1)
            places += range(a, b)
            places.append(-1)
            at += b - a
        rows = string_runs(s, least, times)
        rows[:, 0] = np.array(places)[rows[:, 0]]
        found.append(rows)
        held, total = [], 0
    return np.concatenate(found)


def _text_chunks(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """Rows of a batch with about CHUNK words together, cut into words."""
    begin, held, total = 0, [], 0
    texts = utf8(batch.column(at))
    for i, text in enumerate(texts):
        held.append((text or b"").split())  # on bytes: ASCII white space only
        total += len(held[-1])
        if total >= CHUNK or i + 1 == len(texts):
            yield begin, i + 1, held
            begin, held, total = i + 1, [], 0


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """A row per document: doc_id, n_words, runs and collapsed.

    runs: (start, length, period) in words numbered from 0, by start, then period, of every run with a
    length of at least `least` words and `times` periods (2 or more). collapsed: the text's words joined by
    one space, without those that a run contains after its first period. A null or empty text has no words,
    no runs and an empty collapsed text; repeated rows and null ids are judged row by row; an empty table
    gives none; other columns are not read. A text is held whole by one task; of a very long one the words that may be
    in a run take about 700 bytes each while its trees stand.
    """
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, held in _text_chunks(batch, 1):
                numbers: dict[bytes, int] = {}
                sizes = np.fromiter(map(len, held), np.int64, len(held))
                words = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in held for w in ws), np.int64, int(sizes.sum()))
                stops = np.cumsum(sizes)
                left = np.repeat(stops, sizes) - np.arange(len(words))
                rows = text_runs(words, left, least, times)
                owner = np.searchsorted(stops, rows[:, 0], side="right")
                rows[:, 0] -= (stops - sizes)[owner]
                runs: list[list[dict[str, int]]] = [[] for _ in held]
                for doc, (start, length, period) in zip(owner.tolist(), rows.tolist(), strict=True):
                    runs[doc].append({"start": start, "length": length, "period": period})
                joined = []
                for ws, mine in zip(held, runs, strict=True):
                    done = 0  # words before this place are kept or dropped already
                    kept: list[bytes] = []
                    for begin, end in sorted((r["start"] + r["period"], r["start"] + r["length"]) for r in mine):
                        if begin > done:
                            kept += ws[done:begin]
                        done = max(done, end)
                    joined.append(b" ".join(kept + ws[done:] if mine else ws))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sizes), pa.array(runs, run_type), pa.array(joined, pa.binary())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    shape = f"doc_id {kind}, n_words BIGINT, runs ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>, collapsed BINARY"
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(judge, shape)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, exactly; of equal ones the first by start, then period; null without runs."""
    better = lambda r, b: b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"])
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, none, lambda b, r: F.when(better(r, b), r).otherwise(b))
