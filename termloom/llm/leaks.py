"""Problem 9: evaluation texts leaking into training text.

Method: word windows of items and documents are embedded by the CGK random
walk, under which edit distance shows as Hamming distance; bit-sampling LSH over
the embeddings, repeated until the target recall, gives candidate items per
document; each candidate is verified by exact edit distance, passage by passage.

The items are the query set: their distinct texts are indexed in blocks of
bounded size, each block is sent to the tasks, and every document is read whole,
where it lies. What is stock or rare is counted over the whole list before.
"""

from __future__ import annotations

import html
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import runtime
from termloom.llm import near_copies

#: Words of a window; an item is covered by its windows, so passages of half an item hold many.
WINDOW = 8
#: A document's window matches an item's at up to this weighted edit distance. An extra word costs 1; a missing or
#: changed one costs 1, or RARE_COST if at most RARE_SHARE of the distinct items have it (a name, a number).
EDITS, RARE_COST, RARE_SHARE = 3, 2, 0.03
#: Sampled positions of an embedding, and Hamming similarity at which TARGET_RECALL must be reached.
SAMPLED, SIMILAR, TARGET_RECALL = 4, 0.75, 0.95
#: Share of an item's words that a document must carry ("about half").
SHARE = 0.5
#: A window that this many distinct items share is a stock phrase and identifies none of them (near copies count as one).
STOCK_ITEMS = 4
#: Distinct items of one block of the index.
BLOCK_ITEMS = 20_000

#: A word that equals none.
NOWHERE = -1

_TAG = re.compile(r"</?[a-zA-Z][^<>]{0,200}>|<!--.*?-->", re.S)
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """The words of a text in lower case, without markup."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return _WORD.findall(text.lower())


def stretches(ws: list[str], size: int = WINDOW) -> list[int]:
    """The windows of a list of words as hashes, in order."""
    import xxhash

    return [xxhash.xxh64_intdigest(" ".join(ws[k : k + size])) - 2**63 for k in range(len(ws) - size + 1)]


def repetitions(target: float = TARGET_RECALL, similar: float = SIMILAR, sampled: int = SAMPLED) -> int:
    """Repetitions at which a window of this Hamming similarity is met with probability ``target``."""
    return math.ceil(math.log(1 - target) / math.log(1 - similar**sampled))


def windows(tokens: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """All windows of a token sequence, one per row."""
    if len(tokens) < size:
        return np.empty((0, size), dtype=tokens.dtype)
    return np.lib.stride_tricks.sliding_window_view(tokens, size)


class Embedding:
    """CGK random walks over token windows, and bit samples of them."""

    def __init__(self, vocabulary: int, size: int = WINDOW, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.size, self.steps = size, 3 * size
        self.walks = []
        for _ in range(repetitions()):
            bits = rng.integers(0, 2, (self.steps, vocabulary), dtype=np.int8)
            # positions late in the walk are mostly padding; sample where a walk of half steps still reads
            places = np.sort(rng.choice(2 * size, SAMPLED, replace=False))
            mix = rng.integers(1, 2**62, SAMPLED, dtype=np.int64) | 1
            self.walks.append((bits, places, mix))

    def keys(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """One array of sampled keys per repetition."""
        n = len(rows)
        base = np.arange(n) * (self.size + 1)
        padded = np.zeros((n, self.size + 1), dtype=np.int32)
        padded[:, : self.size] = rows
        flat = padded.ravel()
        for bits, places, mix in self.walks:
            at = np.zeros(n, dtype=np.int64)
            key = np.zeros(n, dtype=np.int64)
            k = 0
            for step in range(places[-1] + 1):
                seen = flat[base + at]
                if step == places[k]:
                    key += (seen.astype(np.int64) + 1) * mix[k]
                    k += 1
                at = np.minimum(at + bits[step][seen], self.size)
            yield key ^ (key >> 29)


class ItemIndex:
    """LSH tables over the windows of a block of items.

    ``common`` (words that are not rare) and ``stock`` (windows, as of
    ``stretches``) are those of the whole list; without them the block is it.
    """

    def __init__(self, items: list[tuple[int, str]], common: set[str] | None = None, stock: set[int] | None = None) -> None:
        texts = [words(t) for _, t in items]
        marks = [stretches(t) for t in texts]
        if common is None or stock is None:
            distinct = {tuple(t): set(m) for t, m in zip(texts, marks)}
            spread = Counter(w for t in distinct for w in set(t))
            common = {w for w, n in spread.items() if n > max(2, RARE_SHARE * len(distinct))}
            stock = {m for m, n in Counter(m for ms in distinct.values() for m in ms).items() if n >= STOCK_ITEMS}
        self.ids = [i for i, _ in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}), 1)}
        self.tokens = [np.asarray([self.vocabulary[w] for w in t], dtype=np.int32) for t in texts]
        self.cost = np.full(len(self.vocabulary) + 1, RARE_COST, dtype=np.int16)
        self.cost[[k for w, k in self.vocabulary.items() if w in common]] = 1
        self.embedding = Embedding(len(self.vocabulary) + 1)
        self.stock = {row.tobytes() for t, ms in zip(self.tokens, marks) for row, m in zip(windows(t), ms) if m in stock}
        owner, rows = [], []
        for k, t in enumerate(self.tokens):
            for row in windows(t):
                if row.tobytes() not in self.stock:
                    owner.append(k)
                    rows.append(row)
        self.owner = np.asarray(owner, dtype=np.int32)
        self.rows = np.asarray(rows, dtype=np.int32).reshape(-1, WINDOW)
        self.tables = []
        if rows:
            for key in self.embedding.keys(self.rows):
                order = np.argsort(key, kind="stable")
                self.tables.append((key[order], order))

    def encode(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        return np.asarray([get(w, 0) for w in words(text)], dtype=np.int32)

    def candidates(self, tokens: list[np.ndarray]) -> list[set[int]]:
        """For every document the items that share a sampled key with one of its windows."""
        found: list[set[int]] = [set() for _ in tokens]
        if not self.tables:
            return found
        parts, docs = [], []
        for k, t in enumerate(tokens):
            if len(t) < WINDOW:
                continue
            # a window within EDITS of an item's has at most EDITS words that no item has
            known = np.concatenate(([0], np.cumsum(t > 0)))
            good = np.flatnonzero(known[WINDOW:] - known[:-WINDOW] >= WINDOW - EDITS)
            if len(good):
                parts.append(windows(t)[good])
                docs.append(np.full(len(good), k))
        if not parts:
            return found
        rows, doc = np.concatenate(parts), np.concatenate(docs)
        met: list[np.ndarray] = []
        for (table, order), key in zip(self.tables, self.embedding.keys(rows)):
            lo, n = np.searchsorted(table, key, "left"), np.searchsorted(table, key, "right")
            n -= lo
            hit = np.flatnonzero(n)
            row = np.repeat(hit, n[hit])
            at = np.repeat(lo[hit] - np.cumsum(n[hit]) + n[hit], n[hit]) + np.arange(len(row))
            for low in range(0, len(row), 200_000):
                mine, theirs = rows[row[low : low + 200_000]], self.rows[order[at[low : low + 200_000]]]
                # of an item's window within EDITS the words that are not in common cost no more
                absent = ~(theirs[:, :, None] == mine[:, None, :]).any(axis=2)
                common = (self.cost[theirs] * absent).sum(axis=1) <= EDITS
                who = self.owner[order[at[low : low + 200_000][common]]].astype(np.int64)
                met.append(np.unique(doc[row[low : low + 200_000][common]] * len(self.ids) + who))
        for pair in np.unique(np.concatenate(met)).tolist() if met else ():
            found[pair // len(self.ids)].add(pair % len(self.ids))
        return found

    def share(self, k: int, doc: np.ndarray) -> float:
        """Share of item ``k``'s words that ``doc`` carries: those in windows that some passage meets within EDITS."""
        item = self.tokens[k]
        n = len(item)
        if n < WINDOW:
            return 0.0
        mine = np.unique(item)
        near = np.isin(doc, mine)
        reach = np.flatnonzero(np.convolve(near, np.ones(2 * WINDOW + 1), "same") >= WINDOW - EDITS)
        if not len(reach):
            return 0.0
        # stretches that are apart stay so: no passage crosses more than EDITS words that nothing equals
        apart = np.repeat(np.flatnonzero(np.diff(reach) > 1) + 1, EDITS + 1)
        near_by = np.insert(doc[reach], apart, NOWHERE)
        carried = np.zeros(n, dtype=bool)
        rows = windows(item)
        own = np.flatnonzero([r.tobytes() not in self.stock for r in rows])
        for low in range(0, len(near_by), 4096):  # passages overlap by the reach of a window
            text = near_by[max(0, low - 2 * WINDOW) : low + 4096]
            for start in own[nearest(rows[own], text, self.cost) <= EDITS]:
                carried[start : start + WINDOW] = True
        return float(carried.mean())

    def bounds(self, ks: list[int], present: np.ndarray) -> np.ndarray:
        """Upper bounds of ``share`` of items: words in windows whose words absent from the document cost no more than EDITS."""
        size = np.asarray([len(self.tokens[k]) for k in ks])
        words_ = np.concatenate([self.tokens[k] for k in ks])
        if len(words_) < WINDOW:
            return np.zeros(len(ks))
        item = np.repeat(np.arange(len(ks)), size)
        absent = np.concatenate(([0], np.cumsum(self.cost[words_] * ~present[words_])))
        fits = (absent[WINDOW:] - absent[:-WINDOW] <= EDITS) & (item[WINDOW - 1 :] == item[: len(item) - WINDOW + 1])
        opened = np.concatenate(([0], np.cumsum(fits)))
        at = np.arange(len(words_))
        # a word is covered if a fitting window starts at it or up to WINDOW - 1 before
        covered = opened[np.minimum(at + 1, len(fits))] > opened[np.minimum(np.maximum(at - WINDOW + 1, 0), len(fits))]
        return np.bincount(item, covered, minlength=len(ks)) / np.maximum(size, 1)

    def shares(self, tokens: np.ndarray, ks: set[int], least: float) -> Iterator[tuple[int, float]]:
        """Items among ``ks`` of which a document carries at least ``least``, and their shares."""
        if not ks:
            return
        present = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        present[tokens] = True
        order = sorted(ks)
        for k, most in zip(order, self.bounds(order, present)):
            if most >= least and (got := self.share(k, tokens)) >= least:
                yield k, got


_indexes: dict[str, ItemIndex] = {}


def _index(name: str, sent) -> ItemIndex:
    """The index of a broadcast block, built once in every Python worker and kept for its next tasks."""
    if name not in _indexes:
        _indexes.clear()
        _indexes[name] = ItemIndex(*sent.value)
    return _indexes[name]


def nearest(patterns: np.ndarray, text: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """For every pattern (a row) the least weighted edit distance to any passage of ``text`` (exact)."""
    places = np.arange(len(text) + 1, dtype=np.int16)
    row = np.zeros((len(patterns), len(text) + 1), dtype=np.int16)
    for i in range(patterns.shape[1]):
        weight = cost[patterns[:, i, None]]
        step = np.empty_like(row)
        step[:, 0] = row[:, 0] + weight[:, 0]
        step[:, 1:] = np.minimum(row[:, :-1] + weight * (text[None, :] != patterns[:, i, None]), row[:, 1:] + weight)
        row = np.minimum.accumulate(step - places, axis=1) + places
    return row.min(axis=1)


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", share: float = SHARE, block: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id, item_id, share``: every document that carries at least ``share`` of an item's words.

    Words count in passages of any order and layout, each within EDITS per
    WINDOW words; words of stock phrases (shared by STOCK_ITEMS items) and of
    shorter quotations are not enough.

    Edge cases: null or empty texts match nothing; items under WINDOW words
    match nothing; repeated documents give a row each, repeated items too, and
    items of the same words under several ids a row for each; texts of any
    length are read whole; empty tables give no rows; extra columns are ignored.
    """
    spark = documents.sparkSession
    listed = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text")).where("item_id is not null and text is not null")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        known: dict[str, int] = {}
        for batch in batches:
            texts = [words(t) for t in batch["text"]]
            yield runtime.frame(
                {
                    "item_id": batch["item_id"],
                    "mark": np.asarray([xxhash.xxh64_intdigest(" ".join(t)) - 2**63 for t in texts], dtype=np.int64),
                    "text": batch["text"],
                    "words": [sorted(set(t)) for t in texts],
                    "windows": [list(set(stretches(t))) for t in texts],
                    "sig": [near_copies.signature(t, known) for t in texts],
                }
            )

    each = runtime.durable(listed.mapInPandas(read, "item_id bigint, mark bigint, text string, words array<string>, windows array<bigint>, sig array<bigint>"))
    distinct = runtime.durable(each.dropDuplicates(["mark"]).drop("item_id"))
    own = distinct.join(near_copies.groups(distinct), "mark", "left").select(F.coalesce("root", "mark").alias("group"), "words", "windows")
    own = runtime.durable(own)
    total = own.select("group").distinct().count()
    # at most words per item / RARE_SHARE words are common: a bounded list
    spread = own.select("group", F.explode("words").alias("w")).distinct().groupBy("w").count()
    common = {r[0] for r in spread.where(F.col("count") > max(2, RARE_SHARE * total)).select("w").collect()}
    shared = own.select("group", F.explode("windows").alias("s")).distinct().groupBy("s").count()
    stock = runtime.durable(shared.where(F.col("count") >= STOCK_ITEMS).select("s"))
    parts = max(1, -(-distinct.count() // block))
    docs = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    found = []
    for part in range(parts):
        mine = distinct.where(F.pmod(F.xxhash64("mark"), F.lit(parts)) == part) if parts > 1 else distinct
        phrases = {r[0] for r in mine.select(F.explode("windows").alias("s")).distinct().join(stock, "s", "left_semi").collect()}
        sent = spark.sparkContext.broadcast(([(r[0], r[1]) for r in mine.select("mark", "text").collect()], common, phrases))

        def run(batches: Iterator[pd.DataFrame], sent=sent, name=uuid.uuid4().hex) -> Iterator[pd.DataFrame]:
            index = _index(name, sent)
            for batch in batches:
                for low in range(0, len(batch), 500):
                    some = batch.iloc[low : low + 500]
                    tokens = [index.encode(t) for t in some["text"]]
                    out = []
                    for doc, t, ks in zip(some["doc_id"], tokens, index.candidates(tokens)):
                        out.extend((doc, index.ids[k], got) for k, got in index.shares(t, ks, share))
                    yield pd.DataFrame(out, columns=["doc_id", "mark", "share"])

        found.append(docs.mapInPandas(run, "doc_id bigint, mark bigint, share double"))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result.join(each.select("item_id", "mark"), "mark").select("doc_id", "item_id", "share")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = runtime.table(spark, sf_dir, "documents")
    return leaks(documents, runtime.table(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()
