"""A convolutional text classifier over hashed word embeddings, and thresholds by language.

A word's embedding is the sum of the embeddings of its letter runs and of itself, found by hash.
Filters of one, two and three words slide over the whole text, the maximum of each over all places
is kept, and a logistic layer scores the maxima. Its maxima pass gradients to a few words per text
only. A bounded sample of labelled rows gives the network that training begins with. Then every labelled row
that does not calibrate trains it: the rows are dealt into parts, each part goes on from there in
a task that reads its rows block by block, and the parts' moves are averaged in Spark. All calibration
rows are scored for the curve and the thresholds, whose sums Spark adds up. Scoring is a map over all
texts: a filter's response is a sum of per-word values, so a block of texts costs one product over
its distinct words and one lookup per word and filter.

Labels, language, source and id never enter a score. The language only picks the threshold of the
decision to reject.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import U64, WORD_1, Words, blocks, hash_strings, mix, powers, stored, string_parts

# Bounds of the sample that training begins with: expected rows and bytes of each label.
SAMPLE_POSITIVE, SAMPLE_NEGATIVE, SAMPLE_BYTES = 1500, 2500, 16 << 20
BUCKET_BITS, WIDTH, FILTERS = 18, 8, 8
RUNS = (3, 4, 5, 6)             # bytes of a letter run
SPANS = (1, 2, 3)               # words under a filter
PAD = SPANS[-1]
STEPS, BATCH, RATE, DECAY, KEEP, LEFT_OUT = 800, 32, 0.08, 1e-4, 0.7, 0.5
LEAST_SEEN = 4                  # texts that hold a letter run
CALIBRATION = 4                 # one of so many labelled rows only calibrates
PART_RATE = 0.04                # a part trains at this rate
CELL, CELLS = 16, 2048          # cells of a logit's unit, and cells on either side of zero, that calibration begins with
CHUNK = 256                     # buckets whose moves travel in one row
THRESHOLD, LEAST, MOST, LEAST_POSITIVE = 0.3, 0.1, 0.9, 20
EDGE_MARKS = ".,;:!?%*&$#|\"'()[]{}<>-_"


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> U64(64 - BUCKET_BITS)).astype(np.int32)


def word_runs(vocabulary: pa.Array):
    """(buckets, runs of each word) for each length of run, and for whole words."""
    plain = pc.utf8_trim(vocabulary.cast(pa.large_string()), characters=EDGE_MARKS)
    data, bounds = string_parts(pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) if isinstance(x, str) else x for x in ("<", plain, ">", ""))))
    lengths = np.diff(bounds)
    ends = np.repeat(bounds[1:], lengths)
    total, done = np.zeros(len(data), U64), 0
    steps = powers(WORD_1, RUNS[-1])
    for n in RUNS:
        while done < n:
            total[:max(len(data) - done, 0)] += (data[done:].astype(U64) + U64(1)) * steps[done]
            done += 1
        inside = np.arange(len(data)) + n <= ends
        yield bucket(total[inside] + U64(n)), np.maximum(lengths - n + 1, 0)
    yield bucket(hash_strings(plain)), np.ones(len(lengths), np.int64)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows, some of them empty."""
    out = np.zeros((len(counts), values.shape[1]), values.dtype)
    some = counts > 0
    if some.any():
        starts = np.cumsum(counts) - counts
        out[some] = np.add.reduceat(values, starts[some], axis=0)
    return out


def embedded(vocabulary: pa.Array, table: np.ndarray) -> np.ndarray:
    """Embeddings of the words, and a last row of zeros that pads the texts."""
    out = np.zeros((len(vocabulary) + 1, WIDTH), np.float32)
    for ids, counts in word_runs(vocabulary):
        out[:-1] += sums(table[ids], counts)
    return out


def padded(codes: np.ndarray, sizes: np.ndarray, empty: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes with padding after each text; the first and last + 1 place of each text.

    An empty text has one place, on its padding; no filter at a place reaches into the next text.
    """
    stream = np.full(len(codes) + PAD * (len(sizes) + 1), empty, np.int64)
    stream[np.arange(len(codes)) + PAD * np.repeat(np.arange(len(sizes)), sizes)] = codes
    starts = np.cumsum(sizes + PAD) - sizes - PAD
    return stream, starts, starts + np.maximum(sizes, 1)


@dataclass
class Network:
    table: np.ndarray
    filters: list[np.ndarray]        # per span: (span, WIDTH, FILTERS)
    shifts: list[np.ndarray]
    weights: np.ndarray
    bias: float = 0.0
    scale: float = 1.0               # calibration
    offset: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def responses(self, vectors: np.ndarray, stream: np.ndarray) -> list[np.ndarray]:
        """Filter responses at every place but the padding at the very end."""
        n = len(stream) - SPANS[-1] + 1
        out = []
        for span, weight, shift in zip(SPANS, self.filters, self.shifts):
            z = np.broadcast_to(shift, (n, FILTERS)).astype(np.float32)
            for j in range(span):
                z += (vectors @ weight[j])[stream[j:j + n]]
            out.append(z)
        return out

    def logits(self, words: Words) -> np.ndarray:
        stream, starts, ends = padded(words.codes, np.diff(words.bounds), len(words.vocabulary))
        vectors = embedded(words.vocabulary, self.table)
        turns = np.stack([starts, ends], 1).ravel()
        best = [np.maximum(np.maximum.reduceat(z, turns, axis=0)[::2], 0) for z in self.responses(vectors, stream)]
        return np.concatenate(best, axis=1) @ self.weights + self.bias

    def scores(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits.astype(np.float64) + self.offset, -50, 50)))


@dataclass
class Constant:
    """The share of positive labels, where one class has no rows to learn from."""

    share: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def logits(self, words: Words) -> np.ndarray:
        return np.zeros(len(words))

    def scores(self, logits: np.ndarray) -> np.ndarray:
        return np.full(len(logits), self.share)


@lru_cache(1)
def first_values() -> np.ndarray:
    """What a bucket begins with that a part of the rows is the first to know; the same in every part."""
    return np.random.default_rng(1).normal(0, 0.02, (1 << BUCKET_BITS, WIDTH)).astype(np.float32)


class Trainer:
    """Adagrad on balanced batches; only words at a maximum get gradients. ``before`` is a trainer to go on from."""

    def __init__(self, texts: pa.Array, labels: np.ndarray, seed: int = 0, before: Trainer | None = None):
        self.rng = before.rng if before else np.random.default_rng(seed)
        self.words, self.labels = Words(texts), labels
        ids, owner = [], []
        for found, counts in word_runs(self.words.vocabulary):
            ids.append(found)
            owner.append(np.repeat(np.arange(len(counts)), counts))
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        self.runs = np.concatenate(ids)[order]
        self.run_counts = np.bincount(owner, minlength=len(self.words.vocabulary))
        self.run_starts = np.cumsum(self.run_counts) - self.run_counts
        # Runs of a few texts tell single texts apart and nothing else; they stay at zero, as unseen ones do.
        met = np.unique(self.words.owners() * len(self.words.vocabulary) + self.words.codes) % max(len(self.words.vocabulary), 1)
        in_texts = np.bincount(met, minlength=len(self.words.vocabulary))
        self.in_texts = np.bincount(self.runs, np.repeat(in_texts, self.run_counts), 1 << BUCKET_BITS).astype(np.float32)
        if before:
            self.in_texts += before.in_texts
        self.learned = self.in_texts >= LEAST_SEEN
        if before:
            self.net, self.squares, self.moved, self.steps = before.net, before.squares, before.moved, before.steps
            new = self.learned & (before.in_texts < LEAST_SEEN)
            self.net.table[new] = first_values()[new]
            return
        seen = np.flatnonzero(self.learned)
        table = np.zeros((1 << BUCKET_BITS, WIDTH), np.float32)
        table[seen] = self.rng.normal(0, 0.02, (len(seen), WIDTH))
        self.net = Network(table, [self.rng.normal(0, 0.4, (s, WIDTH, FILTERS)).astype(np.float32) for s in SPANS],
                           [np.zeros(FILTERS, np.float32) for _ in SPANS], np.full(FILTERS * len(SPANS), 0.4, np.float32), -1.0)
        self.squares = {"table": np.full(table.shape[0], 1e-3, np.float32)}
        self.moved, self.steps = np.zeros(table.shape[0], np.int32), 0     # steps that moved each bucket, and all steps

    def runs_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.run_counts[words]
        first = np.repeat(self.run_starts[words] - (np.cumsum(counts) - counts), counts)
        return self.runs[first + np.arange(int(counts.sum()))], counts

    def move(self, name: str, values: np.ndarray, gradient: np.ndarray, rate: float) -> None:
        square = self.squares.setdefault(name, np.full(values.shape, 1e-3, np.float32))
        square += gradient * gradient
        values -= rate * gradient / np.sqrt(square)

    def step(self, rows: np.ndarray, rate: float) -> None:
        net, bounds = self.net, self.words.bounds
        parts = [self.words.codes[bounds[r]:bounds[r + 1]] for r in rows]
        local, codes = np.unique(np.concatenate(parts), return_inverse=True)
        ids, counts = self.runs_of(local)
        vectors = np.vstack([sums(net.table[ids], counts), np.zeros((1, WIDTH), np.float32)])
        # Some words are left out of each step, so that every telling word is learned and not only the plainest.
        out = np.append(self.rng.random(len(local)) < LEFT_OUT, False)
        vectors[out] = 0
        stream, starts, ends = padded(codes, np.array([len(p) for p in parts]), len(local))
        places, best = [], []
        for z in net.responses(vectors, stream):
            at = np.array([a + z[a:b].argmax(0) for a, b in zip(starts, ends)])
            places.append(at)
            best.append(np.take_along_axis(z, at, 0))
        kept = (self.rng.random(FILTERS * len(SPANS)) < KEEP) / KEEP
        hidden = np.maximum(np.concatenate(best, 1), 0) * kept.astype(np.float32)
        p = 1 / (1 + np.exp(-np.clip(hidden @ net.weights + net.bias, -30, 30)))
        error = ((p - self.labels[rows]) / BATCH).astype(np.float32)
        down = error[:, None] * net.weights * (hidden > 0) * kept.astype(np.float32)
        self.move("weights", net.weights, hidden.T @ error + DECAY * net.weights, rate)
        np.maximum(net.weights, 0, out=net.weights)      # a maximum is evidence for, its absence is not evidence against
        net.bias -= rate * float(error.sum())
        to_words = np.zeros_like(vectors)
        for k, (span, at) in enumerate(zip(SPANS, places)):
            part = down[:, k * FILTERS:(k + 1) * FILTERS]
            gradient = np.zeros_like(net.filters[k])
            for j in range(span):
                under = stream[at + j]                       # rows x FILTERS
                gradient[j] = np.einsum("rfd,rf->df", vectors[under], part)
                np.add.at(to_words, under, part[:, :, None] * net.filters[k][j].T[None])
            self.move(f"filters{k}", net.filters[k], gradient + DECAY * net.filters[k], rate)
            self.move(f"shifts{k}", net.shifts[k], part.sum(0), rate)
        to_words[out] = 0
        moved = np.flatnonzero(np.abs(to_words[:-1]).sum(1))
        if len(moved):
            ids, counts = self.runs_of(local[moved])
            gradient = np.repeat(to_words[moved], counts, axis=0)
            gradient, ids = gradient[self.learned[ids]], ids[self.learned[ids]]
            known, at = np.unique(ids, return_inverse=True)
            total = np.stack([np.bincount(at, gradient[:, d], len(known)) for d in range(WIDTH)], 1).astype(np.float32)
            self.squares["table"][known] += (total * total).mean(1)
            net.table[known] -= rate * total / np.sqrt(self.squares["table"][known])[:, None]
            self.moved[known] += 1
        self.steps += 1

    def train(self, rows: np.ndarray) -> Network:
        positive, negative = rows[self.labels[rows] == 1], rows[self.labels[rows] == 0]
        for step in range(STEPS):
            rate = RATE * (1 - step / STEPS) + RATE / 50
            self.step(np.concatenate([self.rng.choice(positive, BATCH // 2), self.rng.choice(negative, BATCH // 2)]), rate)
        return self.net

    def once(self) -> None:
        """Every row at least once; those of the rarer label are taken again until the others are through."""
        sides = [self.rng.permutation(np.flatnonzero(self.labels == y)) for y in (1, 0)]
        half = BATCH // 2
        for at in range(0, max(map(len, sides)), half):
            self.step(np.concatenate([np.resize(x, max(len(x), at + half))[at:at + half] if len(x) else x for x in sides]), PART_RATE)

    def state(self) -> bytes:
        return pickle.dumps({"net": vars(self.net), "squares": self.squares, "in_texts": self.in_texts})


def best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The threshold with the best F1 within LEAST and MOST; the middle of equally good ones."""
    grid = np.linspace(LEAST, MOST, 81)
    hit = scores[None] >= grid[:, None]
    right = (hit * (labels * weights)).sum(1)
    f1 = 2 * right / np.maximum((hit * weights).sum(1) + (labels * weights).sum(), 1e-12)
    return float(np.median(grid[f1 >= f1.max() - 1e-9]))


def labelled(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict]:
    """Rows (doc_id, text, lang, y, held, part) of all labelled documents, and (rows, bytes) of each (y, held).

    Only labels of ``documents`` count. An id that repeats there is one row, with the text of the smallest
    hash; ids labelled twice take the larger label; null ids and labels are left out. ``held`` rows only
    calibrate; a ``part`` is one task's rows, in one file and in order of ids.
    """
    known = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").alias("y"))
    sized = documents.select("doc_id", F.xxhash64("text").alias("key"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    own = sized.join(known, "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min(F.struct("key", "bytes")).alias("r"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(CALIBRATION)) == CALIBRATION - 1
    own = stored(own.select("doc_id", "y", held.alias("held"), "r.*"), "labelled")
    sums = {(r.y, r.held): (r.n, r.bytes) for r in own.groupBy("y", "held").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()}
    texts = documents.select("doc_id", "text", "lang", F.xxhash64("text").alias("own_key")).where("doc_id is not null")
    # Joined by the id alone (an equality would become a key), so that the texts travel once for the join and for the single row of each id.
    rows = texts.join(own.drop("bytes").hint("merge"), "doc_id").where("(own_key ^ key) = 0")
    rows = rows.select("doc_id", "text", "lang", "y", "held").dropDuplicates(["doc_id"]).sortWithinPartitions("doc_id")
    return stored(rows.withColumn("part", F.spark_partition_id()), "labelled-texts"), sums


def begun(batches):
    """The state of a trainer after the rows of one task, all of the sample; without rows of both labels, of an untrained one."""
    rows = pa.Table.from_batches(batches, pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("y", pa.int32())]))
    rows = rows.sort_by("doc_id").combine_chunks()
    y = rows.column("y").to_numpy().astype(np.int64)
    trainer = Trainer(rows.column("text").combine_chunks() if len(y) else pa.array([""]), y)
    if 0 < y.sum() < len(y):
        trainer.train(np.arange(len(y)))
    yield pa.RecordBatch.from_arrays([pa.array([trainer.state()], pa.binary())], names=["state"])


def begin(rows: DataFrame, sums: dict) -> bytes:
    """The state of a trainer after a sample of ``rows``: whole texts, chosen by a hash of their id.

    About SAMPLE_POSITIVE and SAMPLE_NEGATIVE rows and SAMPLE_BYTES of either label come at most, so that one
    task may hold them.
    """
    share = [min(1.0, most / sums[y, False][0], SAMPLE_BYTES / max(sums[y, False][1], 1)) for y, most in ((0, SAMPLE_NEGATIVE), (1, SAMPLE_POSITIVE))]
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30))
    chosen = rows.where(~F.col("held") & (draw < F.when(F.col("y") == 1, share[1] * (1 << 30)).otherwise(share[0] * (1 << 30))))
    chosen = chosen.select(F.col("doc_id").cast("long"), "text", F.col("y").cast("int"))
    found = chosen.repartition(1).mapInArrow(begun, "state binary").first()
    return found.state if found else next(begun([])).column(0)[0].as_py()


def trainer_from(state: bytes, seed: int) -> Trainer:
    """A trainer without rows of its own, which goes on from a state."""
    fields = pickle.loads(state)
    out = Trainer(pa.array([""]), np.zeros(1, np.int64), seed)
    out.net, out.squares, out.in_texts = Network(**fields["net"]), fields["squares"], fields["in_texts"]
    return out


def dense(net: Network) -> list[np.ndarray]:
    return [*net.filters, *net.shifts, net.weights, np.array([net.bias], np.float32)]


def moves(trainer: Trainer, start: Network, part: int) -> pa.RecordBatch:
    """By chunk of buckets, and for all else as chunk -1, how far a part went from the start and in how many steps."""
    delta = (trainer.net.table - start.table).reshape(-1, CHUNK * WIDTH)
    steps = trainer.moved.reshape(-1, CHUNK)
    some = np.flatnonzero(steps.any(1))
    other = np.concatenate([(x - y).ravel() for x, y in zip(dense(trainer.net), dense(start))]).astype(np.float32)
    return pa.RecordBatch.from_arrays(
        [pa.array([-1, *some.tolist()], pa.int32()), pa.array([part] * (len(some) + 1), pa.int32()),
         pa.array([np.int32([trainer.steps]).tobytes(), *(steps[k].tobytes() for k in some)], pa.binary()),
         pa.array([other.tobytes(), *(delta[k].tobytes() for k in some)], pa.binary())],
        names=["chunk", "part", "steps", "delta"])


def continued(batches, state):
    """The moves of each part of the rows, which all begin with the same state; a part's rows follow each other."""
    start, trainer, now = Network(**pickle.loads(state.value)["net"]), None, None
    for batch in batches:
        parts = batch.column("part").to_numpy()
        turns = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
        for a, b in zip(turns[:-1], turns[1:]):
            if a == b:
                continue
            if now != parts[a]:
                if trainer:
                    yield moves(trainer, start, now)
                now = int(parts[a])
                trainer = trainer_from(state.value, now + 1)
            for block in blocks([batch.slice(a, b - a)]):
                trainer = Trainer(block.column("text"), block.column("y").to_numpy().astype(np.int64), before=trainer)
                trainer.once()
    if trainer:
        yield moves(trainer, start, now)


def averaged(moved: pa.Table) -> pa.Table:
    """The mean move of one chunk over all parts, weighted by the steps that made it."""
    moved = moved.sort_by("part")
    total, many = 0.0, 0
    for steps, delta in zip(moved.column("steps").to_pylist(), moved.column("delta").to_pylist()):
        steps = np.frombuffer(steps, np.int32).astype(np.float64)
        total = total + steps[:, None] * np.frombuffer(delta, np.float32).reshape(len(steps), -1)
        many = many + steps
    mean = (total / np.maximum(many, 1)[:, None]).astype(np.float32)
    return pa.table({"chunk": moved.column("chunk").slice(0, 1), "delta": pa.array([mean.tobytes()], pa.binary())})


def train(rows: DataFrame, state: bytes) -> Network:
    """The network of a state, moved by all ``rows``: the mean of what their parts learn from there."""
    shared = rows.sparkSession.sparkContext.broadcast(state)
    moved = rows.select("part", "text", "y").mapInArrow(partial(continued, state=shared), "chunk int, part int, steps binary, delta binary")
    net = Network(**pickle.loads(state)["net"])
    for chunk, delta in moved.groupBy("chunk").applyInArrow(averaged, "chunk int, delta binary").collect():
        delta = np.frombuffer(delta, np.float32)
        if chunk >= 0:
            net.table[chunk * CHUNK:(chunk + 1) * CHUNK] += delta.reshape(CHUNK, WIDTH)
            continue
        for values in (*net.filters, *net.shifts, net.weights):
            values += delta[:values.size].reshape(values.shape)
            delta = delta[values.size:]
        net.bias += float(delta[0])
        np.maximum(net.weights, 0, out=net.weights)
    return net


def with_logits(batches, model):
    for batch in blocks(batches):
        logits = model.value.logits(Words(batch.column("text"))).astype(np.float64)
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("y"), pa.array(logits, pa.float64())], names=["lang", "y", "logit"])


def curve(rows: DataFrame, scale, offset) -> DataFrame:
    """``rows`` with a column p, the logistic curve of their logits."""
    z = F.col("logit") * F.lit(float(scale)) + F.lit(float(offset))
    return rows.withColumn("p", 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-50.0)), F.lit(50.0)))))


def newton(sums, a: float, b: float, steps: int) -> tuple[float, float]:
    """Damped Newton steps from (a, b) with a weak pull to (1, 0); ``sums`` gives the gradient and the curvature of a pair."""
    pull = 1e-2 * np.eye(2)
    for _ in range(steps):
        s = sums(a, b)
        move = np.clip(np.linalg.solve(np.array([[s[2], s[3]], [s[3], s[4]]]) + pull, np.array(s[:2]) + pull @ [a - 1, b]), -1, 1)
        a, b = a - float(move[0]), b - float(move[1])
        if np.abs(move).max() < 1e-7:
            break
    return a, b


def calibrate(rows: DataFrame) -> tuple[float, float]:
    """Scale and offset of a logistic curve, by damped Newton steps over all (logit, y) with a weak pull to (1, 0).

    The steps begin where those over means of neighbouring logits end, of which there are ``2 * CELLS`` at most, so that
    few jobs are left for all rows. The sums are decimals, so they do not depend on the order of the rows.
    """
    total = lambda c: F.sum(c.cast("decimal(28,12)"))
    cell = F.floor(F.least(F.greatest(F.col("logit") * CELL, F.lit(float(-CELLS))), F.lit(float(CELLS - 1))))
    cells = rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), total(F.col("logit")).alias("x"))
    n, y, x = np.array([[float(v) for v in r] for r in cells.orderBy("cell").select("n", "y", "x").collect()]).reshape(-1, 3).T
    x = x / n

    def of_cells(a: float, b: float) -> list[float]:
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        w = n * p * (1 - p)
        return [float(v.sum()) for v in ((n * p - y) * x, n * p - y, w * x * x, w * x, w)]

    def of_rows(a: float, b: float) -> list[float]:
        x, p = F.col("logit"), F.col("p")
        terms = ((p - F.col("y")) * x, p - F.col("y"), p * (1 - p) * x * x, p * (1 - p) * x, p * (1 - p))
        return [float(v or 0) for v in curve(rows, a, b).agg(*(total(t) for t in terms)).first()]

    a, b = newton(of_rows, *newton(of_cells, 1.0, 0.0, 200), 50)
    return max(a, 1e-3), b


def thresholds(rows: DataFrame) -> dict[str, float]:
    """The best threshold of each language with enough positive rows (lang, y, p), from counts between those to choose from."""
    grid = np.linspace(LEAST, MOST, 81)
    cell = F.size(F.filter(F.array(*(F.lit(float(g)) for g in grid)), lambda g: g <= F.col("p")))
    counts = rows.where("lang is not null and lang <> ''").groupBy("lang", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positive"))
    cells = F.collect_list(F.struct("cell", "n", "positive")).alias("cells")
    found = counts.groupBy("lang").agg(cells, F.sum("positive").alias("positive")).where(F.col("positive") >= LEAST_POSITIVE).collect()
    out = {}
    for lang, own, _ in found:
        at, n, positive = np.array(sorted(own), np.float64).T
        out[lang] = best_threshold(np.append(-1.0, grid)[at.astype(int)], positive / n, n)
    return out


def fit(documents: DataFrame, labels: DataFrame) -> Network | Constant:
    """A network trained on labelled rows, its scores calibrated on rows that it has not seen.

    All labelled rows take part, either in training or in calibration. The driver sees the network and
    sums alone. Without training rows of both labels the score is the share of positive ones.
    """
    rows, sums = labelled(documents, labels)
    if (0, False) not in sums or (1, False) not in sums:
        many = {y: sum(n for (label, _), (n, _) in sums.items() if label == y) for y in (0, 1)}
        return Constant(many[1] / max(many[0] + many[1], 1))
    net = train(rows.where("not held"), begin(rows, sums))
    model = rows.sparkSession.sparkContext.broadcast(net)
    checked = rows.where("held").select("lang", "y", "text").mapInArrow(partial(with_logits, model=model), f"lang string, y {rows.schema['y'].dataType.simpleString()}, logit double")
    checked = stored(checked, "logits")
    net.scale, net.offset = calibrate(checked)
    net.thresholds = thresholds(curve(checked, net.scale, net.offset))
    return net


def scored(batches, model, kept: list[str]):
    net = model.value
    for batch in blocks(batches):
        scores = net.scores(net.logits(Words(batch.column("text"))))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores, pa.float64())], names=[*kept, "score"])


def score(documents: DataFrame, net: Network | Constant, keep_text: bool = False) -> DataFrame:
    """``documents`` with a score between 0 and 1 for every whole text, with or without the text.

    Null and empty texts have no word and get the score of nothing but padding. A column ``score`` of
    the input is replaced; other columns pass as they are.
    """
    documents = documents.drop("score")
    model = documents.sparkSession.sparkContext.broadcast(net)
    fields = [f for f in documents.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])
    return documents.mapInArrow(partial(scored, model=model, kept=[f.name for f in fields]), schema)


def threshold(net: Network | Constant, lang: str = "lang"):
    """The threshold of a row's language; languages with few labelled rows share the usual one."""
    out = F.lit(THRESHOLD)
    for name, value in sorted(net.thresholds.items()):
        out = F.when(F.col(lang) == name, F.lit(value)).otherwise(out)
    return out
