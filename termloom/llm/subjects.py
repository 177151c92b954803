"""Problem 10: subject area of each document.

Method: term weighting and truncated singular value decomposition embed the
sentences of all documents; subjects are assigned by cosine similarity to seed
centroids (from the list of subjects and a small labelled sample), which are
refined iteratively over the whole corpus. A document has the subjects of at
least a sixth of its sentences with any subject.

The decomposition is a subspace iteration: every pass sends to each task a
matrix of terms x dimensions and adds up one of the same size. Every word above
a share of the sentences is a term, so there are at most as many as the words of
a sentence divided by that share, whatever the corpus holds.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import runtime
from termloom.llm import near_copies

#: Dimensions of the space; passes of the decomposition and of the refinement.
DIMENSIONS, PASSES, REFINEMENTS = 40, 4, 3
#: A term counts if it stands in at least this share of the sentences (names do not).
LEAST_SHARE = 2e-4
#: A sentence that stands word for word in at least this share of the distinct texts (near copies count as one) is a stock line.
STOCK_SHARE, STOCK_TEXTS = 0.003, 4
#: Cosine similarity from which a sentence is about a subject, and from which it refines the centroid; least share of a
#: sentence's norm that the space must hold (sentences of no subject lie outside it).
ABOUT, SURE, LEAST_NORM = 0.4, 0.6, 0.25
#: Share of a document's sentences with any subject.
SHARE = 1 / 6
#: Labelled documents that seed the centroids, at most.
SEED_DOCUMENTS = 50_000

_TAG = re.compile(r"</?[a-zA-Z][^<>]{0,200}>|<!--.*?-->", re.S)
_END = re.compile(r"(?<=[.!?…])[\"')\]]*\s+|\n+|\s[•*·]\s")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\W_]+")


def sentences(text: str | None) -> list[tuple[list[str], list[str]]]:
    """The sentences of a text, each as its words in lower case, and its words and figures; markup and empty ones are left out."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub("\n", text)
    if "&" in text:
        text = html.unescape(text)
    # a line that is not ended goes on in the next one
    text = re.sub(r"(?<![.!?:…\n])[ \t]*\r?\n(?=[ \t]*[a-zà-ÿ])", " ", text)
    found = []
    for s in _END.split(text):
        tokens = _TOKEN.findall(s.lower()) if s else []
        words = tokens if "".join(tokens).isalpha() else _WORD.findall(s.lower()) if tokens else []
        if words:
            found.append((words, tokens))
    return found


def _signature(tokens: list[str]) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(" ".join(tokens)) - 2**63


def _count(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``word, n`` (sentences that have it), ``line, texts`` (sentences and how many texts have them), and the number of texts.

    Texts are distinct ones, and a group of near copies counts as one: what
    they share is their own content, not a stock line.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        known: dict[str, int] = {}
        for batch in batches:
            counts: dict[str, int] = {}
            lines: set[tuple[int, int]] = set()
            signed: dict[int, list[int]] = {}
            if len(known) > 1_000_000:
                known.clear()
            for text in batch["text"]:
                mark = xxhash.xxh64_intdigest(text) - 2**63
                found = sentences(text)
                for words, tokens in found:
                    for w in set(words):
                        counts[w] = counts.get(w, 0) + 1
                    lines.add((_signature(tokens), mark))
                if mark not in signed:
                    signed[mark] = near_copies.signature([w for words, _ in found for w in words], known)
            none, nothing, unsigned = [None] * len(counts), [None] * len(lines), [None] * len(signed)
            yield runtime.frame(
                {
                    "word": [*counts, *nothing, *unsigned],
                    "n": np.asarray([*counts.values(), *[0] * (len(lines) + len(signed))], dtype=np.int64),
                    "line": pd.array([*none, *[a for a, _ in lines], *unsigned], dtype="Int64"),
                    "mark": pd.array([*none, *[b for _, b in lines], *signed], dtype="Int64"),
                    "sig": [*none, *nothing, *signed.values()],
                }
            )

    both = runtime.durable(docs.select("text").mapInPandas(run, "word string, n bigint, line bigint, mark bigint, sig array<bigint>"))
    words = both.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    signed = both.where("sig is not null").select("mark", "sig")
    lines, marks = both.where("line is not null").select("line", "mark"), signed.select("mark").distinct()
    copies = near_copies.groups(signed)
    if not copies.isEmpty():
        one = F.coalesce("root", "mark").alias("mark")
        lines, marks = lines.distinct().join(copies, "mark", "left").select("line", one), marks.join(copies, "mark", "left").select(one)
    lines = lines.distinct().groupBy("line").agg(F.count(F.lit(1)).alias("texts"))
    return words, lines, marks.distinct().count()


def _encode(docs: DataFrame, vocabulary: dict[str, int], stock: set[int]) -> DataFrame:
    """``doc_id, place, ids``: the known terms of every sentence that is no stock line."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, stock))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, lines = sent.value
        for batch in batches:
            doc, place, ids = [], [], []
            for i, text in zip(batch["doc_id"], batch["text"]):
                for k, (words, tokens) in enumerate(sentences(text)):
                    got = sorted({known[w] for w in words if w in known})
                    if got and _signature(tokens) not in lines:
                        doc.append(i)
                        place.append(k)
                        ids.append(got)
            yield runtime.frame({"doc_id": doc, "place": place, "ids": ids})

    return docs.mapInPandas(run, "doc_id bigint, place int, ids array<int>")


def vectors(ids: pd.Series, weight: np.ndarray, basis: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """Projections of weighted, normalised sentences on ``basis``; ``total`` gets the matrix's transpose times them added.

    Blocks of sentences are laid out densely over the terms they have, so that
    both products are matrix products.
    """
    size = ids.str.len().to_numpy().astype(int)
    start = np.concatenate(([0], np.cumsum(size)))
    term = np.concatenate(ids.to_numpy()) if len(ids) else np.empty(0, dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    value = weight[term].astype(np.float32)
    norm = np.sqrt(np.bincount(row, value.astype(float) ** 2, minlength=len(size)))
    value /= np.maximum(norm[row], 1e-12).astype(np.float32)
    basis = basis.astype(np.float32)
    projected = np.empty((len(size), basis.shape[1]), dtype=np.float32)
    step = max(50, min(1000, 16_000_000 // max(1, len(weight))))  # a block has at most the whole vocabulary's columns
    for low in range(0, len(size), step):
        high = min(len(size), low + step)
        own = slice(start[low], start[high])
        used, at = np.unique(term[own], return_inverse=True)
        block = np.zeros((high - low, len(used)), dtype=np.float32)
        block[row[own] - low, at] = value[own]
        projected[low:high] = block @ basis[used]
        if total is not None:
            total[used] += block.T @ projected[low:high]
    return projected


def _added(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the matrices that tasks sent row by row."""
    total = np.zeros(shape)
    added = parts.groupBy("i").agg(*[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(shape[1])])
    for r in added.collect():  # terms x dimensions
        total[r[0]] = r[1:]
    return total


def decompose(encoded: DataFrame, weight: np.ndarray, dimensions: int = DIMENSIONS, passes: int = PASSES) -> np.ndarray:
    """The leading right singular vectors (terms x dimensions) of the weighted sentence matrix, by subspace iteration."""
    sc = encoded.sparkSession.sparkContext
    k = min(dimensions, len(weight))
    basis = np.linalg.qr(np.random.default_rng(11).standard_normal((len(weight), k)))[0]
    for _ in range(passes):
        sent = sc.broadcast((weight, basis))

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            w, q = sent.value
            total = np.zeros(q.shape)
            for batch in batches:
                for low in range(0, len(batch), 20_000):
                    vectors(batch["ids"].iloc[low : low + 20_000], w, q, total)
            some = np.flatnonzero(total.any(axis=1))
            yield pd.DataFrame({"i": some, "v": list(total[some])})

        basis = np.linalg.qr(_added(encoded.select("ids").mapInPandas(run, "i int, v array<double>"), basis.shape))[0]
    return basis


def _nearest(p: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best centroid and its cosine for projected sentences; -1 for those that lie mostly outside the space."""
    norm = np.linalg.norm(p, axis=1)
    cos = _unit(p) @ centroids.T
    best = cos.argmax(axis=1) if len(p) else np.empty(0, dtype=int)
    return best, np.where(norm >= LEAST_NORM, cos[np.arange(len(p)), best], -1.0)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def assign(documents: DataFrame, subjects: DataFrame, labels: DataFrame, share: float = SHARE) -> DataFrame:
    """``doc_id, subject, share``: every document and each subject that at least ``share`` of its sentences with any subject are about.

    ``documents`` has ``doc_id, text, lang``, ``subjects`` has ``subject,
    about``, ``labels`` has ``doc_id, subject``. Seeds are the sentences of
    labelled documents with one subject, by language, and the list's own words.

    Edge cases: null or empty texts, and texts without a sentence near any
    centroid, have no subject; labels that are spelled otherwise (case, outer
    blanks) count, unknown ones do not; repeated texts and near copies count once
    in the count of stock lines and get a result each; ties in similarity go to the first
    subject by name; empty tables give no rows; extra columns are ignored.
    """
    spark = documents.sparkSession
    sc = spark.sparkContext
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.when(F.lower(F.trim("lang")).startswith("fr"), 1).otherwise(0).alias("fr")).where("doc_id is not null and text is not null")
    words, lines, texts = _count(docs)
    words, lines = runtime.durable(words), runtime.durable(lines)
    least = max(STOCK_TEXTS, int(texts * STOCK_SHARE))
    # at most sentences per text / STOCK_SHARE lines, and words per sentence / LEAST_SHARE words, whatever the corpus
    stock = {r[0] for r in lines.where(F.col("texts") >= least).select("line").collect()}
    lowest = max(3, int(LEAST_SHARE * (words.agg(F.max("n")).first()[0] or 0)))
    frequent = words.where(F.col("n") >= lowest).orderBy(F.desc("n"), "word").collect()
    named = [r["subject"] for r in subjects.select("subject").where("subject is not null").distinct().orderBy("subject").collect()]
    schema = "doc_id bigint, subject string, share double"
    if not frequent or not named:
        return spark.createDataFrame([], schema)
    vocabulary = {r["word"]: k for k, r in enumerate(frequent)}
    df = np.asarray([r["n"] for r in frequent], dtype=float)
    weight = np.log(1 + df.max() / df)
    encoded = runtime.durable(_encode(docs, vocabulary, stock))
    basis = decompose(encoded, weight)

    key = {n.strip().lower(): k for k, n in enumerate(named)}
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(runtime.squash(F.col("subject"))).alias("s")).where(F.col("s").isin(list(key))).distinct()
    single = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.first("s").alias("s")).where("n = 1").orderBy(F.xxhash64("doc_id")).limit(SEED_DOCUMENTS)
    seeds = encoded.join(single.select("doc_id", "s"), "doc_id").join(docs.select("doc_id", "fr"), "doc_id").select("ids", (F.element_at(F.create_map(*[F.lit(x) for kv in key.items() for x in kv]), F.col("s")) * 2 + F.col("fr")).alias("c"))
    count = 2 * len(named)

    def sums(frame: DataFrame, centroids: np.ndarray | None) -> np.ndarray:
        sent = sc.broadcast((weight, basis, centroids))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            w, q, cs = sent.value
            total = np.zeros((count, q.shape[1] + 1))
            for batch in batches:
                for low in range(0, len(batch), 20_000):
                    some = batch.iloc[low : low + 20_000]
                    p = vectors(some["ids"], w, q)
                    if cs is None:
                        c, sure = some["c"].to_numpy(), np.ones(len(p), dtype=bool)
                    else:
                        c, cos = _nearest(p, cs)
                        sure = cos >= SURE
                    np.add.at(total, c[sure], np.column_stack([_unit(p)[sure], np.ones(int(sure.sum()))]))
            yield pd.DataFrame({"i": np.arange(count), "v": list(total)})

        return _added(frame.mapInPandas(run, "i int, v array<double>"), (count, basis.shape[1] + 1))

    seed = sums(seeds, None)
    about = {r["subject"]: r["about"] for r in subjects.select("subject", "about").collect()}
    for k, n in enumerate(named):
        ids = sorted({vocabulary[w] for w in _WORD.findall(f"{n} {about.get(n) or ''}".lower()) if w in vocabulary and df[vocabulary[w]] < 0.05 * df.max()})
        if ids:
            seed[2 * k, :-1] += _unit(vectors(pd.Series([ids]), weight, basis))[0]
    centroids = _unit(seed[:, :-1])
    for _ in range(REFINEMENTS):
        moved = sums(encoded.select("ids"), centroids)
        few = moved[:, -1] < 3
        centroids = np.where(few[:, None], centroids, _unit(moved[:, :-1]))
    sent = sc.broadcast((weight, basis, centroids))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, q, cs = sent.value
        for batch in batches:
            for low in range(0, len(batch), 20_000):
                some = batch.iloc[low : low + 20_000]
                c, cos = _nearest(vectors(some["ids"], w, q), cs)
                good = cos >= ABOUT
                out = pd.DataFrame({"doc_id": some["doc_id"].to_numpy()[good], "s": c[good] // 2})
                yield out.groupby(["doc_id", "s"], as_index=False).size().rename(columns={"size": "n"})

    counts = encoded.select("doc_id", "ids").mapInPandas(run, "doc_id bigint, s int, n bigint").groupBy("doc_id", "s").agg(F.sum("n").alias("n"))
    wide = counts.groupBy("doc_id").agg(F.sum("n").alias("all"), F.collect_list(F.struct("s", "n")).alias("each"))
    per = wide.select("doc_id", "all", F.explode("each").alias("e")).where(F.col("e.n") >= F.col("all") * share - 1e-9)
    names = F.array(*[F.lit(n) for n in named])
    return per.select("doc_id", names[F.col("e.s")].alias("subject"), (F.col("e.n") / F.col("all")).alias("share"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assign(*(runtime.table(spark, sf_dir, t) for t in ("documents", "subject_list", "subject_labels")))
    return found.select("doc_id", "subject")
