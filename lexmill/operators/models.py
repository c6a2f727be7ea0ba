"""The fitted two-view classifier (C1) on Spark ML."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.cleaning import split_words, text_or_token
from lexmill.operators.classify import VIEWS, argmax_label
from lexmill.operators.scale import list_lookup, list_offsets, lookup_join
from lexmill.runtime import ROW, materialize, numbered, scratch_path, shuffle_partitions

#: Numbers of a long vector that travel at once, and that the driver holds at once of each of several vectors.
PIECE, READ = 1 << 19, 1 << 16


@dataclass
class TwoViewModel:
    """One fitted classifier per class vocabulary, and the table of both vocabularies. Words never leave the table."""

    vocab: DataFrame
    classifiers: dict[str, object]
    kind: str


def view_sizes(vocab: DataFrame) -> dict[str, int]:
    """The number of words of each view's vocabulary; raises if one is empty."""
    sizes = vocab.agg(*[F.max(F.when(F.col("cls") == v, F.col("idx") + 1)).alias(v) for v in VIEWS]).first().asDict()
    for view, size in sizes.items():
        if not size:
            raise ValueError(f"the vocabulary of class {view!r} is empty")
    return sizes


def _counted(size: int):
    """The sparse counts of an array of positions, in the form in which vectors are stored; nulls do not count."""

    @F.arrow_udf("struct<type:tinyint,size:int,indices:array<int>,values:array<double>>")
    def counted(lists: pa.Array) -> pa.Array:
        flat, ends = lists.flatten(), list_offsets(lists).to_numpy()
        known = pc.is_valid(flat).to_numpy(zero_copy_only=False)
        positions = pc.fill_null(flat, 0).to_numpy()
        lengths, indices, values, begin = [np.zeros(0, "int64")], [np.zeros(0, "int32")], [np.zeros(0)], 0
        while begin < len(lists):
            # So many rows that a part holds about a million positions, or one row.
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + 1_000_000, "right")) - 1)
            part = slice(ends[begin], ends[end])
            cells = np.repeat(np.arange(end - begin), np.diff(ends[begin : end + 1])) * size + positions[part]
            cells, counts = np.unique(cells[known[part]], return_counts=True)
            rows, found = np.divmod(cells, size)
            lengths.append(np.bincount(rows, minlength=end - begin))
            indices.append(found.astype("int32"))
            values.append(counts.astype("float64"))
            begin = end
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(lengths))]), pa.int32())
        n = len(lists)
        columns = [pa.array(np.zeros(n, "int8")), pa.array(np.full(n, size, "int32")), *[pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c))) for c in (indices, values)]]
        return pa.StructArray.from_arrays(columns, ["type", "size", "indices", "values"])

    return counted


def add_vectors(reviews: DataFrame, vocab: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """A4, vector form: ``reviews``, or their columns ``keep``, with each view's sparse counts (neg_features, pos_features) of vocabulary words at their A3 positions; written.

    Within the bounds of a broadcast for each view's vocabulary, a text's words are looked up and counted where they are. Beyond them, the words look
    the vocabulary table up, and their positions are regrouped once, by row. Spark ML then sees numbers only, so
    the vocabulary may have any size that a model's weights may have. Rows stay as they are, with or without hits; rows of one Id are
    apart. The counts are written in the form in which vectors are stored, and read back as vectors.
    """
    spark, sizes = reviews.sparkSession, view_sizes(vocab)
    keep = reviews.columns if keep is None else list(keep)
    kept, path = [F.col(f"`{c}`") for c in keep], scratch_path(spark, "vectors")
    lookups = [list_lookup(vocab.where(F.col("cls") == v), "word", "idx") for v in VIEWS]
    if all(lookups):
        words = split_words(text_or_token(F.col("text")))
        made = reviews.select(*kept, *[_counted(sizes[v])(find(words)).alias(f"{v}_features") for v, find in zip(VIEWS, lookups)])
    else:
        made = _joined_vectors(reviews, vocab, sizes).select(*kept, *[f"{v}_features" for v in VIEWS])
    made.write.parquet(path)
    vectors = [T.StructField(f"{v}_features", VectorUDT()) for v in VIEWS]
    return spark.read.schema(T.StructType([*[reviews.schema[c] for c in keep], *vectors])).parquet(path)


def _joined_vectors(reviews: DataFrame, vocab: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """The rows with their vectors as stored, for a vocabulary of any size: the words are joined to it as rows."""
    spark, rows = reviews.sparkSession, materialize(numbered(reviews), "reviews")
    words = rows.select(ROW, F.explode(split_words(text_or_token(F.col("text")))).alias("word"))
    hits = lookup_join(words, vocab, ["word"]).select(ROW, "cls", F.col("idx").cast("int").alias("idx"))
    # Dealt out by row, a row's words stay together through both aggregations.
    counts = hits.repartition(shuffle_partitions(spark), ROW).groupBy(ROW, "cls", "idx").agg(F.count(F.lit(1)).cast("double").alias("cnt"))
    pair = F.struct("idx", "cnt")
    found = counts.groupBy(ROW).agg(*[F.sort_array(F.collect_list(F.when(F.col("cls") == v, pair))).alias(f"_{v}") for v in VIEWS])
    full = rows.join(found, ROW, "left")

    def stored(view: str):
        held = F.coalesce(f"_{view}", F.array().cast("array<struct<idx:int,cnt:double>>"))
        sparse = [F.lit(0).cast("tinyint").alias("type"), F.lit(sizes[view]).cast("int").alias("size")]
        return F.struct(*sparse, held["idx"].alias("indices"), held["cnt"].alias("values")).alias(f"{view}_features")

    return full.select(*[F.col(f"`{c}`") for c in reviews.columns], *[stored(v) for v in VIEWS])


def fit_two_views(
    train: DataFrame, vocab: DataFrame, kind: str = "logistic", hidden: tuple[int, ...] = (16,), max_iter: int = 20, seed: int = 1
) -> TwoViewModel:
    """One classifier per view, each trained on all training rows with their true labels.

    The weights, one set per word, are numbers on the driver, as Spark ML has it; those of a perceptron are in files of its temporary folder. A pass over the
    rows returns one gradient per task, as long as the weights, so the rows are read in as many tasks as the session has cores, however many files hold them. The training summary is dropped: it holds
    the session, which no task can carry once the session has counted rows at a write.
    """
    spark, sizes = train.sparkSession, view_sizes(vocab)
    labelled = train.where(F.col("Category").isNotNull()).select("text", F.when(F.col("Category") == 0, 0.0).otherwise(1.0).alias("label"))
    data = add_vectors(labelled, vocab, ["label"]).coalesce(spark.sparkContext.defaultParallelism)
    fitted = {}
    for view, size in sizes.items():
        columns = dict(featuresCol=f"{view}_features", rawPredictionCol=f"{view}_raw", probabilityCol=f"{view}_prob", predictionCol=f"{view}_pred")
        if kind == "logistic":
            fitted[view] = LogisticRegression(maxIter=max_iter, regParam=0.01, family="multinomial", **columns).fit(data)
            fitted[view]._java_obj.setSummary(spark._jvm.scala.Option.empty())
        elif kind == "perceptron":
            layers = [size, *hidden, 2]
            weights = _trained(data.select(F.col(f"{view}_features").alias("features"), "label"), layers, max_iter, seed)
            fitted[view] = Perceptron(spark, weights, layers, seed, columns)
        else:
            raise ValueError(f"unknown kind {kind!r}")
    return TwoViewModel(vocab, fitted, kind)


class Stored:
    """A long vector in a file of the driver's temporary folder, which goes with this object."""

    def __init__(self, dtype: str = "float64"):
        self.file, self.dtype, self.scale = tempfile.TemporaryFile(prefix="lexmill-"), np.dtype(dtype), 1.0

    @classmethod
    def of(cls, pieces: Iterator[np.ndarray], dtype: str = "float64") -> Stored:
        out = cls(dtype)
        for piece in pieces:
            out.file.write(piece.astype(out.dtype).tobytes())
        return out

    def put(self, slot: int, piece: bytes) -> None:
        self.file.seek(slot * PIECE * self.dtype.itemsize)
        self.file.write(piece)

    def pieces(self, most: int) -> Iterator[np.ndarray]:
        at = 0
        while True:
            self.file.seek(at)
            data = self.file.read(most * self.dtype.itemsize)
            if not data:
                return
            at += len(data)
            yield np.frombuffer(data, self.dtype) * self.scale


def _gram(vectors: list[Stored]) -> np.ndarray:
    """The products of all pairs of vectors."""
    total = np.zeros((len(vectors), len(vectors)))
    for pieces in zip(*[v.pieces(READ) for v in vectors], strict=True):
        held = np.stack(pieces, dtype="float64")
        total += held @ held.T
    return total


def _combined(factors: Sequence[float], vectors: list[Stored], dtype: str = "float64") -> Stored:
    """The sum of the vectors, each times its factor."""
    return Stored.of((sum(f * p for f, p in zip(factors, pieces, strict=True)) for pieces in zip(*[v.pieces(READ) for v in vectors], strict=True)), dtype)


def _whole(shared: list) -> np.ndarray:
    """In a task: the vector that was shared in pieces. A piece is read from its file again by the next task, or it would be held twice."""
    out, at = np.empty(sum(n for _, n in shared)), 0
    for held, n in shared:
        out[at : at + n] = held.value
        vars(held).pop("_value", None)
        at += n
    return out


def _shared(spark, pieces: Iterator[np.ndarray]) -> list:
    return [(spark.sparkContext.broadcast(p), len(p)) for p in pieces]


def _layers_of(weights: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The matrix (inputs by outputs) and the offsets of each layer, as views of the weights in the order in which Spark ML holds them."""
    out, at = [], 0
    for n_in, n_out in zip(layers, layers[1:]):
        matrix = weights[at : at + n_in * n_out].reshape(n_in, n_out)
        at += n_in * n_out + n_out
        out.append((matrix, weights[at - n_out : at]))
    return out


def _parts(vectors: pa.StructArray, most: int = 200_000) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, lengths, positions, counts) of runs of sparse vectors that hold about ``most`` numbers, or one vector."""
    indices, values = vectors.field("indices"), vectors.field("values")
    offsets = indices.offsets.to_numpy()
    # The lists may begin behind the start of their buffer.
    idx, val = indices.values.to_numpy(), values.values.to_numpy(zero_copy_only=False)
    shift = values.offsets.to_numpy()[0] - offsets[0]
    begin = 0
    while begin < len(vectors):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1)
        lo, hi = offsets[begin], offsets[end]
        yield slice(begin, end), np.diff(offsets[begin : end + 1]), idx[lo:hi], val[lo + shift : hi + shift]
        begin = end


def _forward(net: list, lengths: np.ndarray, idx: np.ndarray, val: np.ndarray) -> list[np.ndarray]:
    """What each layer gives: sigmoids, and the scores at last. The first layer sees only the words that a text has."""
    matrix, offset = net[0]
    z = np.zeros((len(lengths), matrix.shape[1]))
    held = lengths > 0
    if held.any():
        z[held] = np.add.reduceat(val[:, None] * matrix[idx], (np.cumsum(lengths) - lengths)[held])
    outs = [z + offset]
    for matrix, offset in net[1:]:
        outs[-1] = 0.5 * (1 + np.tanh(0.5 * outs[-1]))
        # Row by row in a fixed order: a text scores the same in any batch.
        outs.append(np.einsum("nh,ho->no", outs[-1], matrix) + offset)
    return outs


def _gradients(shared: list, layers: list[int], piece: int):
    """For ``mapInArrow``: the sums of the loss and of its gradient over the rows of a task, in pieces, and first the loss and the rows (slot -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _whole(shared)
        net = _layers_of(weights, layers)
        total, loss, n = np.zeros(len(weights)), 0.0, 0
        grads = _layers_of(total, layers)
        for batch in batches:
            labels = batch.column(1).to_numpy().astype(int)
            for rows, lengths, idx, val in _parts(batch.column(0)):
                outs, at = _forward(net, lengths, idx, val), np.arange(len(lengths))
                scores = outs[-1] - outs[-1].max(axis=1, keepdims=True)
                shares = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
                loss += float(-(scores[at, labels[rows]] - np.log(np.exp(scores).sum(axis=1))).sum())
                n += len(at)
                delta = shares
                delta[at, labels[rows]] -= 1
                for (matrix, _), (g, g0), below in zip(net[:0:-1], grads[:0:-1], outs[-2::-1]):
                    g += below.T @ delta
                    g0 += delta.sum(axis=0)
                    delta = (delta @ matrix.T) * below * (1 - below)
                grads[0][1][:] += delta.sum(axis=0)
                if len(idx):
                    order = np.argsort(idx, kind="stable")
                    words = idx[order]
                    starts = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
                    owner = np.repeat(at, lengths)[order]
                    grads[0][0][words[starts]] += np.add.reduceat(val[order, None] * delta[owner], starts)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([np.array([loss, n]).tobytes()], pa.binary())], ["slot", "part"])
            for k, at in enumerate(range(0, len(total), piece)):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total[at : at + piece].tobytes()], pa.binary())], ["slot", "part"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sum of the pieces of one slot."""
    total = sum(np.frombuffer(p.as_py()) for p in table.column("part"))
    return pa.table({"slot": table.column("slot")[:1].cast(pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})


def _direction(gram: np.ndarray) -> np.ndarray:
    """The factors of the L-BFGS direction: of the moves, of the turns of the gradient (``gram`` has both, oldest first), and of the gradient, which is last."""
    m = len(gram) // 2
    factors, held = np.eye(2 * m + 1)[-1], np.zeros(m)
    for i in reversed(range(m)):
        held[i] = gram[i] @ factors / gram[i, m + i]
        factors[m + i] -= held[i]
    if m:
        factors *= gram[m - 1, 2 * m - 1] / gram[2 * m - 1, 2 * m - 1]
    for i in range(m):
        factors[i] += held[i] - gram[m + i] @ factors / gram[i, m + i]
    return factors


def _start(layers: list[int], seed: int) -> Iterator[np.ndarray]:
    rng = np.random.default_rng(seed)
    for n_in, n_out in zip(layers, layers[1:]):
        n = n_in * n_out + n_out
        for at in range(0, n, PIECE):
            yield (rng.random(min(PIECE, n - at)) * 4.8 - 2.4) / np.sqrt(n_in)


def _trained(data: DataFrame, layers: list[int], max_iter: int, seed: int, memory: int = 5, tol: float = 1e-6) -> Stored:
    """The weights of a perceptron for (features, label): L-BFGS on the mean cross entropy, as Spark ML's own trainer, which holds all rows with a number per word.

    A step is one pass over the sparse rows. Each task adds its rows up, its pieces are added by piece over the cluster. The weights, the gradient and ``memory``
    earlier steps, in half precision of that, are in files; the driver holds a piece of each. A direction is a sum of these vectors, whose factors follow from their products.
    """
    spark = data.sparkSession

    def value(weights: Stored) -> tuple[float, Stored]:
        shared, gradient, loss, n = _shared(spark, weights.pieces(PIECE)), Stored(), 0.0, 0
        try:
            parts = data.mapInArrow(_gradients(shared, layers, PIECE), "slot int, part binary")
            for r in parts.groupBy("slot").applyInArrow(_added, "slot int, part binary").toLocalIterator():
                if r.slot < 0:
                    loss, n = np.frombuffer(r.part)
                else:
                    gradient.put(r.slot, r.part)
        finally:
            for held, _ in shared:
                held.destroy()
        if not n:
            raise ValueError("there is no labelled row to learn from")
        gradient.scale = 1 / n
        return loss / n, gradient

    weights, pairs = Stored.of(_start(layers, seed)), []
    loss, gradient = value(weights)
    for _ in range(max_iter):
        basis = [*[s for s, _ in pairs], *[y for _, y in pairs], gradient]
        gram = _gram(basis)
        factors = _direction(gram)
        slope, step = float(gram[-1] @ factors), 1.0 if pairs else 1 / max(tol, float(np.sqrt(gram[-1, -1])))
        if not slope > 0:
            break
        for _ in range(10):
            new = _combined([1.0, *(-step * factors)], [weights, *basis])
            new_loss, new_gradient = value(new)
            if new_loss <= loss - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        moved, turned = _combined(-step * factors, basis, "float32"), _combined([1.0, -1.0], [new_gradient, gradient], "float32")
        if _gram([moved, turned])[0, 1] > 1e-12:
            pairs = [*pairs[1 - memory :], (moved, turned)]
        gained, weights, loss, gradient = loss - new_loss, new, new_loss, new_gradient
        if gained <= tol * max(abs(loss), abs(loss + gained), tol) or np.sqrt(_gram([gradient])[0, 0]) <= tol:
            break
    return weights


class Perceptron:
    """Trained weights, in a file of the driver. Anything else asked of it makes a Spark ML model of them, which holds them in memory."""

    def __init__(self, spark, weights: Stored, layers: list[int], seed: int, columns: dict[str, str]):
        self.trained, self.layers_of, self._made = weights, layers, (spark, layers, seed, columns)

    @cached_property
    def spark_model(self):
        spark, layers, seed, columns = self._made
        return _as_classifier(spark, np.concatenate([*self.trained.pieces(PIECE)]), layers, seed, columns)

    def __getattr__(self, name: str):
        return getattr(self.spark_model, name)


def _as_classifier(spark, weights: np.ndarray, layers: list[int], seed: int, columns: dict[str, str]):
    """The weights as a Spark ML model, which can be saved: what no step from them gives."""
    one = spark.createDataFrame([(Vectors.sparse(layers[0], [], []), 0.0)], T.StructType([T.StructField(columns["featuresCol"], VectorUDT()), T.StructField("label", T.DoubleType())]))
    made = MultilayerPerceptronClassifier(maxIter=0, layers=layers, seed=seed, blockSize=1, initialWeights=Vectors.dense(weights), **columns).fit(one)
    # Else the model would carry them twice, once as text.
    made.clear(made.initialWeights)
    made._java_obj.clear(made._java_obj.initialWeights())
    made._java_obj.setSummary(spark._jvm.scala.Option.empty())
    return made


def _perceptron_scores(classifier, view: str, df: DataFrame) -> DataFrame:
    """What the model's ``transform`` gives as raw scores and probabilities, at a cost by the words of a text instead of those of the vocabulary."""
    if isinstance(classifier, Perceptron):
        layers, pieces = classifier.layers_of, classifier.trained.pieces(PIECE)
    else:
        layers, pieces = list(classifier.getLayers()), iter([classifier.weights.toArray()])
    shared = _shared(df.sparkSession, pieces)

    @F.arrow_udf("array<double>")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = _layers_of(_whole(shared), layers)
        for vectors in batches:
            scores = [_forward(net, *part[1:])[-1] for part in _parts(vectors)]
            flat = np.concatenate(scores).ravel() if scores else np.zeros(0)
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 2), pa.int32()), pa.array(flat))

    scored = df.withColumn(f"{view}_raw", raw(f"{view}_features"))
    a, b = F.get(f"{view}_raw", 0), F.get(f"{view}_raw", 1)
    return scored.withColumn(f"{view}_prob", F.array(1 / (1 + F.exp(b - a)), 1 / (1 + F.exp(a - b))))


def model_scores(model: TwoViewModel, reviews: DataFrame, on: str = "score") -> DataFrame:
    """C3 and C4 with fitted models: the views' mean scores and the label."""
    df = add_vectors(reviews, model.vocab)
    column = "raw" if on == "score" else "prob"
    for view, classifier in model.classifiers.items():
        if model.kind == "perceptron":
            df = _perceptron_scores(classifier, view, df)
        else:
            df = classifier.transform(df).withColumn(f"{view}_{column}", vector_to_array(F.col(f"{view}_{column}")))
    pair = [F.col(f"{v}_{column}") for v in VIEWS]
    scores = F.zip_with(*pair, lambda a, b: (a + b) / 2)
    out = df.withColumn("scores", scores).withColumn("pred", argmax_label(F.col("scores")))
    return out.select(*reviews.columns, "scores", "pred")
