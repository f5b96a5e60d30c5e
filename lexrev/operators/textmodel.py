"""Statistical text classifiers (C8) with ``pyspark.ml``.

The reviewed application declares TF-IDF (1-3-grams, 5000 features,
min_df 2, max_df 0.95) with naive Bayes (alpha 0.1), linear SVM and a
100-tree random forest (seed 42) but never trains them.  Here they are
trained on a labelled table and applied to a corpus; fitting is distributed
by ``pyspark.ml`` (no driver-side loop over rows).

``fit_bayes`` builds the TF-IDF and naive Bayes model from joins and grouping alone, so that each of its numbers is defined (ties
in the vocabulary go by term) and has a SQL twin. It is saved as tables and applied in a review by ``method="ml"``.

Both take their vocabulary from ``vocabulary_runs``: a run of words occurs at most as often as the shorter runs in it, so runs of
k + 1 words are counted only where both runs of k words in them are frequent enough. Few runs are then counted, and exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import (IDF, CountVectorizer, CountVectorizerModel, NGram, Normalizer, RegexTokenizer, SQLTransformer,
                                StopWordsRemover)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexrev import rulepacks as RP
from lexrev.functions import text as X
from lexrev.session import broadcast_if_small, cut_lineage

ALGOS = ("naive_bayes", "svm", "random_forest")


def text_pipeline(algo: str = "naive_bayes", label_col: str = "label", text_col: str = "text",
                  vocabulary: list[str] | None = None) -> Pipeline:
    """The stages of a classifier; with a ``vocabulary`` its terms are not counted anew."""
    cfg = RP.TEXT_MODEL
    stages = [
        RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern="\\W+", minTokenLength=1),
        StopWordsRemover(inputCol="_tok", outputCol="_w"),
    ]
    grams = []
    for n in range(1, cfg["ngram_max"] + 1):
        if n == 1:
            grams.append("_w")
            continue
        stages.append(NGram(n=n, inputCol="_w", outputCol=f"_g{n}"))
        grams.append(f"_g{n}")
    stages.append(SQLTransformer(statement="SELECT *, concat(" + ", ".join(grams) + ") AS _grams FROM __THIS__"))
    stages += [
        CountVectorizerModel.from_vocabulary(vocabulary, "_grams", "_tf") if vocabulary else
        CountVectorizer(inputCol="_grams", outputCol="_tf", vocabSize=cfg["max_features"], minDF=float(cfg["min_df"]),
                        maxDF=cfg["max_df"]),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="features", p=2.0),
    ]
    if algo == "naive_bayes":
        clf = NaiveBayes(featuresCol="features", labelCol=label_col, smoothing=cfg["nb_alpha"])
    elif algo == "svm":
        clf = LinearSVC(featuresCol="features", labelCol=label_col)
    elif algo == "random_forest":
        clf = RandomForestClassifier(featuresCol="features", labelCol=label_col, numTrees=cfg["rf_trees"],
                                     seed=cfg["seed"])
    else:
        raise ValueError(f"algo must be one of {ALGOS}")
    return Pipeline(stages=stages + [clf])


def train_text_model(docs: DataFrame, labels: DataFrame, label: str = "quality", algo: str = "naive_bayes",
                     key: str = "doc_id", text_col: str = "text") -> PipelineModel:
    train = docs.select(key, text_col).join(labels.select(key, F.col(label).cast("double").alias("label")), key)
    tokens = train
    for stage in text_pipeline(algo, "label", text_col).getStages()[:2]:
        tokens = stage.transform(tokens)
    lists = cut_lineage(tokens.select("_w"), "words")
    found = vocabulary_runs(lists, lists.count())  # a row is a document
    return text_pipeline(algo, "label", text_col, [term for term, _, _ in found or []]).fit(train)


def score_text_model(model: PipelineModel, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    out = model.transform(docs)
    return out.select(key, F.col("prediction").cast("long").alias("prediction"))


WORD_REGEX = "[\\p{L}\\p{N}_]{2,}"


#: Frequent runs of words that a task may hold; of more, all runs are counted.
MAX_FREQUENT = 200_000
#: Rows of an Arrow batch that are counted at a time.
_ROWS = 1000


def word_lists(text: Column, stop_words: tuple[str, ...] = ()) -> Column:
    """The words of a text (two characters or more, lower case, without stop words)."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_REGEX), 0)
    return F.filter(words, lambda w: ~w.isin(*stop_words)) if stop_words else words


def ngram_counts(docs: DataFrame, key: str = "doc_id", text_col: str = "text", n_max: int | None = None,
                 stop_words: tuple[str, ...] = ()) -> DataFrame:
    """Runs of one to ``n_max`` words of every document with their counts: key, term, tf. A document without words has a
    row with a null term."""
    return run_counts(docs.select(key, word_lists(F.col(text_col), stop_words).alias("_w")), key, n_max)


def run_counts(d: DataFrame, key: str, n_max: int | None = None) -> DataFrame:
    """``ngram_counts`` of lists of words (``_w``)."""
    w = F.col("_w")

    def run_of(n: int):
        return lambda i: F.array_join(F.slice(w, i + 1, n), " ")

    runs = [w] + [F.transform(X.seq0(F.size(w) - (n - 1)), run_of(n)) for n in range(2, (n_max or RP.TEXT_MODEL["ngram_max"]) + 1)]
    grams = d.select(key, F.when(X.pinned(w), F.concat(*runs)).alias("_g"))
    return grams.select(key, F.explode_outer("_g").alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


class Runs:
    """Finds given terms (runs of words joined by blanks) in lists of words.

    All runs within the terms are numbered: words by their place among the words, a run of k words by the numbers of its
    first and its last k - 1 words.
    """

    def __init__(self, terms: list[str]):
        within: list[set[tuple[str, ...]]] = []
        for words in (t.split(" ") for t in terms):
            for k in range(1, len(words) + 1):
                if len(within) < k:
                    within.append(set())
                within[k - 1].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
        place = {t: i for i, t in enumerate(terms)}
        self.size = len(terms)
        self.pairs: list[np.ndarray] = []
        self.places: list[np.ndarray] = []  # of each level, the places of its runs in ``terms`` (-1: within one only)
        number: dict[tuple[str, ...], int] = {}
        for k, runs in enumerate(within or [set()], 1):
            if k == 1:
                order = sorted(runs)
                self.words = pa.array([w for (w,) in order], pa.string())
            else:
                pair = {r: number[r[:-1]] * len(number) + number[r[1:]] for r in runs}
                order = sorted(runs, key=pair.__getitem__)
                self.pairs.append(np.array([pair[r] for r in order], np.int64))
            number = {r: i for i, r in enumerate(order)}
            self.places.append(np.array([place.get(" ".join(r), -1) for r in order], np.int64))
        #: the longest runs, and their last words
        self.names = pa.array([" ".join(r) for r in order], pa.string())
        self.last = pa.array([r[-1] for r in order], pa.string())

    def levels(self, lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        """The row of every word, and for each length the number of the run that starts at it (-1: none)."""
        row, flat = _flat(lists)
        code = pc.fill_null(pc.index_in(flat, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        out, size = [code], len(self.words)
        for pairs in self.pairs:
            at, pair = _next(row, out[-1], size)
            place = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            hit = pairs[place] == pair if len(pairs) else np.zeros(len(pair), bool)
            code = np.full(len(flat), -1, np.int64)
            code[at[hit]] = place[hit]
            out.append(code)
            size = len(pairs)
        return row, out

    def vectors(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place of the term, how often it occurs in the row), by row and place."""
        row, levels = self.levels(lists)
        found = [np.where(code >= 0, places[code] if len(places) else -1, -1) for code, places in zip(levels, self.places, strict=True)]
        ids, tf = np.unique(np.concatenate([row[p >= 0] * self.size + p[p >= 0] for p in found]), return_counts=True)
        size = max(self.size, 1)
        return ids // size, ids % size, tf


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), n), lists.flatten()


def _next(row: np.ndarray, code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where two numbered runs follow at one word's distance in a row, and the pairs of their numbers."""
    at = np.flatnonzero((code[:-1] >= 0) & (code[1:] >= 0) & (row[:-1] == row[1:]))
    return at, code[at] * size + code[at + 1]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, _ROWS):
            yield b.slice(at, _ROWS)


def _longer_runs(lists: DataFrame, known: Runs | None) -> DataFrame:
    """Counts (term, df, total) of the runs that are a word longer than the longest ``known`` ones and made of two of them
    (``None``: of all words), each from some rows; a row is a document."""
    spark = lists.sparkSession
    sent = spark.sparkContext.broadcast(known)  # at most MAX_FREQUENT runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in _slices(batches):
            if known is None:
                row, flat = _flat(b.column(0))
                words = flat.dictionary_encode()
                ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            else:
                row, levels = known.levels(b.column(0))
                at, ids = _next(row, levels[-1], len(known.names))
                row = row[at]
            own, ids, total = np.unique(ids, return_inverse=True, return_counts=True)
            if not len(own):
                continue
            df = np.bincount(np.unique(row * len(own) + ids) % len(own), minlength=len(own))
            if known is None:
                terms = words.dictionary.take(pa.array(own))
            else:
                first, second = pa.array(own // len(known.names)), pa.array(own % len(known.names))
                terms = pc.binary_join_element_wise(known.names.take(first), known.last.take(second), " ")
            yield pa.RecordBatch.from_arrays([terms, pa.array(df, pa.int64()), pa.array(total, pa.int64())], names=["term", "df", "total"])

    return lists.select("_w").mapInArrow(run, "term string, df long, total long")


def vocabulary_runs(lists: DataFrame, n: int, more: DataFrame | None = None, n_max: int | None = None,
                    size: int | None = None) -> list[tuple[str, int, int]] | None:
    """The ``size`` most frequent runs of words (term, df, total; ties go by term) of at least ``min_df`` and at most the share
    ``max_df`` of ``n`` documents.

    ``lists`` holds documents' words (``_w``), a document a row, ``more`` counts (term, df, total) of all runs of further
    documents. ``None``: too many runs are equally frequent to be held at a time.
    """
    cfg = RP.TEXT_MODEL
    n_max, size = n_max or cfg["ngram_max"], size or cfg["max_features"]
    best: list[tuple[str, int, int]] = []
    known, least = None, cfg["min_df"]
    for k in range(1, n_max + 1):
        counts = _longer_runs(lists, known)
        if more is not None:
            counts = counts.unionByName(more.where(F.size(F.split("term", " ")) == k))
        counts = counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        counts = cut_lineage(counts.where(F.col("total") >= least), "runs")
        top = counts.where((F.col("df") >= cfg["min_df"]) & (F.col("df") <= cfg["max_df"] * n)).orderBy(F.desc("total"), "term").limit(size)
        best = sorted([*best, *map(tuple, top.collect())], key=lambda r: (-r[2], r[0]))[:size]
        if len(best) == size:
            least = best[-1][2]  # rarer runs, and longer ones that hold them, are not among the best
        if k < n_max:
            frequent = [r["term"] for r in counts.where(F.col("total") >= least).select("term").limit(MAX_FREQUENT + 1).collect()]
            if len(frequent) > MAX_FREQUENT:
                return None
            if not frequent:
                break
            known = Runs(frequent)
    return best


def _repeated(rows: DataFrame, key: str) -> DataFrame | None:
    """The keys of several rows, and the null one; ``None``: there are none. ``rows`` is a written table."""
    keys = cut_lineage(rows.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).select(key), "repeated")
    return None if keys.isEmpty() else keys


@dataclass(frozen=True)
class BayesModel:
    """Tables of a fitted model: ``terms`` (term, idf, deltas: label -> log probability above the label's default), at most
    ``max_features`` rows, and ``labels`` (label, prior, base: the default log probability), a row a label."""

    terms: DataFrame
    labels: list[tuple[str, float, float]]

    def save(self, path: str) -> None:
        spark = self.terms.sparkSession
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        spark.createDataFrame(self.labels, "label string, prior double, base double").coalesce(1).write.mode("overwrite").parquet(f"{path}/labels")


def load_bayes(spark: SparkSession, path: str) -> BayesModel:
    rows = spark.read.parquet(f"{path}/labels").orderBy("label").collect()  # a row a label
    return BayesModel(spark.read.parquet(f"{path}/terms"), [tuple(r) for r in rows])


def fit_bayes(docs: DataFrame, labels: DataFrame, label: str = "label", key: str = "doc_id", text_col: str = "text",
              stop_words: tuple[str, ...] = (), max_features: int | None = None) -> BayesModel:
    """TF-IDF weights (idf = ln((1 + n) / (1 + df)) + 1, rows of length one) and multinomial naive Bayes on them.

    The vocabulary is the ``max_features`` most frequent terms of at least ``min_df`` and at most the share ``max_df`` of the
    documents. Documents without a label, and keys that are null, are left out.
    """
    cfg = RP.TEXT_MODEL
    size = max_features or cfg["max_features"]
    of = cut_lineage(labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        key, F.col(label).cast("string").alias("label")), "labels")
    words = cut_lineage(docs.select(key, text_col).join(of, key).select(
        key, "label", word_lists(F.col(text_col), stop_words).alias("_w")), "words")
    n = words.select(key).distinct().count()
    repeated = _repeated(words, key)
    once, counts = words, None
    if repeated is not None:
        sent = broadcast_if_small(repeated)
        once = words.join(sent, key, "left_anti")
        counts = cut_lineage(run_counts(words.join(sent, key, "left_semi"), key).join(of, key), "ngrams")

    def totals_of(rows: DataFrame) -> DataFrame:
        return rows.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))

    found = vocabulary_runs(once, n, None if counts is None else totals_of(counts), size=size)
    if found is None:
        every = totals_of(run_counts(words, key).join(of, key))
        found = list(map(tuple, every.where((F.col("df") >= cfg["min_df"]) & (F.col("df") <= cfg["max_df"] * n))
                         .orderBy(F.desc("total"), "term").limit(size).select("term", "df", "total").collect()))
    size = len(found)
    vocabulary = cut_lineage(docs.sparkSession.createDataFrame(found, "term string, df long, total long").select(
        "term", (F.log(F.lit(1.0 + n) / (F.col("df") + 1.0)) + 1.0).alias("idf")), "vocabulary")
    sums = _class_sums(once, vocabulary)
    if counts is not None:
        weighted = counts.join(F.broadcast(vocabulary), "term").withColumn("w", F.col("tf") * F.col("idf"))  # at most max_features rows are sent
        norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
        sums = sums.unionByName(weighted.join(norms, key).select("term", "label", (F.col("w") / F.col("norm")).alias("s")))
    sums = cut_lineage(sums.groupBy("term", "label").agg(F.sum("s").alias("s")), "class-sums")
    alpha = cfg["nb_alpha"]
    per_label = {r["label"]: r["n"] for r in words.select(key, "label").distinct().groupBy("label").agg(F.count("*").alias("n")).collect()}
    totals = {r["label"]: r["s"] for r in sums.groupBy("label").agg(F.sum("s").alias("s")).collect()}  # a row a label
    found = []
    for name in sorted(per_label):
        whole = totals.get(name, 0.0) + alpha * size
        found.append((name, math.log(per_label[name] / n), math.log(alpha / whole) if whole else 0.0))
    # ln((s + alpha) / whole) - ln(alpha / whole)
    deltas = sums.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct(
        "label", F.log((F.col("s") + alpha) / F.lit(alpha))))).alias("deltas"))
    return BayesModel(cut_lineage(vocabulary.join(deltas, "term", "left"), "bayes-terms"), found)


def _class_sums(lists: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Sums (term, label, s), each from some rows, of the documents' vectors of length one; a row (label, ``_w``) is a document."""
    rows = vocabulary.collect()  # at most max_features
    terms = [r["term"] for r in rows]
    sent = lists.sparkSession.sparkContext.broadcast((Runs(terms), pa.array(terms, pa.string()), np.array([r["idf"] for r in rows])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, terms, idf = sent.value
        for b in _slices(batches):
            row, place, tf = runs.vectors(b.column(1))
            if not len(row):
                continue
            w = tf * idf[place]
            norm = np.sqrt(np.bincount(row, w * w, b.num_rows))
            label = b.column(0).dictionary_encode()
            ids = label.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] * runs.size + place
            own, at = np.unique(ids, return_inverse=True)
            yield pa.RecordBatch.from_arrays([terms.take(pa.array(own % runs.size)), label.dictionary.take(pa.array(own // runs.size)),
                                              pa.array(np.bincount(at, w / norm[row], len(own)))], names=["term", "label", "s"])

    return lists.select("label", "_w").mapInArrow(run, "term string, label string, s double")


def score_bayes(model: BayesModel, docs: DataFrame, key: str = "doc_id", text_col: str = "text",
                stop_words: tuple[str, ...] = ()) -> DataFrame:
    """The most probable label of every document (ties: the first by name) and its probability: key, label, probability.

    A document without terms of the vocabulary goes by the labels' frequencies. Repeated keys are one document.
    """
    spark, names = docs.sparkSession, [name for name, _, _ in model.labels]
    rows = model.terms.collect()  # at most max_features
    runs, idf = Runs([r["term"] for r in rows]), np.array([r["idf"] for r in rows], float)
    deltas = np.array([[(r["deltas"] or {}).get(name, 0.0) for r in rows] for name in names], float).reshape(len(names), len(rows))
    sent = spark.sparkContext.broadcast((runs, idf, deltas))
    schema = T.StructType([docs.schema[key], T.StructField("_p", T.ArrayType(T.IntegerType())), T.StructField("_n", T.ArrayType(T.IntegerType()))])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = sent.value[0]
        for b in _slices(batches):
            row, place, tf = runs.vectors(b.column(1))
            starts = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(starts, pa.array(x, pa.int32())) for x in (place, tf)]
            yield pa.RecordBatch.from_arrays([b.column(0), *lists], names=schema.fieldNames())

    found = cut_lineage(docs.select(key, word_lists(F.col(text_col), stop_words).alias("_w")).mapInArrow(vectors, schema), "vectors")
    own = [f"_d{i}" for i in range(len(names))]
    out = T.StructType([docs.schema[key], *[T.StructField(c, T.DoubleType()) for c in ("norm", "all", *own)]])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, idf, deltas = sent.value
        for b in _slices(batches):
            row, place = _flat(b.column(1))
            place = place.to_numpy(zero_copy_only=False)
            w = b.column(2).flatten().to_numpy(zero_copy_only=False) * idf[place]
            parts = [np.sqrt(np.bincount(row, w * w, b.num_rows)), np.bincount(row, w, b.num_rows)]
            parts += [np.bincount(row, w * d[place], b.num_rows) for d in deltas]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(p, pa.float64()) for p in parts]], names=out.fieldNames())

    repeated, once = _repeated(found, key), found
    if repeated is not None:
        once = found.where(F.col(key).isNotNull()).join(broadcast_if_small(repeated.where(F.col(key).isNotNull())), key, "left_anti")
    sums = once.mapInArrow(add_up, out)
    if repeated is not None:
        again = found.where(F.col(key).isNotNull()).join(broadcast_if_small(repeated.where(F.col(key).isNotNull())), key, "left_semi")
        again = again.unionByName(found.where(F.col(key).isNull()))
        merged = again.select(key, F.explode_outer(F.arrays_zip("_p", "_n")).alias("_x")).groupBy(key, F.col("_x._p").alias("_p")).agg(
            F.sum("_x._n").alias("tf"))
        weights = spark.createDataFrame([(i, float(idf[i]), *map(float, deltas[:, i])) for i in range(len(rows))], T.StructType(
            [T.StructField("_p", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in ("idf", *[f"_e{i}" for i in range(len(names))])]]))
        w = merged.join(F.broadcast(weights), "_p", "left").withColumn("w", F.coalesce(F.col("tf") * F.col("idf"), F.lit(0.0)))
        sums = sums.unionByName(w.groupBy(key).agg(
            F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum("w").alias("all"),
            *[F.sum(F.col("w") * F.coalesce(F.col(f"_e{i}"), F.lit(0.0))).alias(c) for i, c in enumerate(own)]))
    unit = F.when(F.col("norm") > 0, F.col("norm")).otherwise(F.lit(1.0))
    scores = F.array(*[F.struct((-(F.lit(prior) + (F.col("all") * F.lit(base) + F.col(f"_d{i}")) / unit)).alias("score"), F.lit(name).alias("label"))
                       for i, (name, prior, base) in enumerate(model.labels)])
    best = sums.select(key, scores.alias("_s")).select(key, "_s", F.array_min("_s").alias("_b"))
    share = F.aggregate("_s", F.lit(0.0), lambda a, s: a + F.exp(F.col("_b")["score"] - s["score"]))
    return best.select(key, F.col("_b")["label"].alias("label"), (F.lit(1.0) / share).alias("probability"))
